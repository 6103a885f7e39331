"""Long tables to wide ones, whatever columns the data turn out to have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values of the pivoted column that one aggregate takes.
CHUNK = 500


def found(table: DataFrame, by: str) -> list[str]:
    """The values that name columns, in order: as many as the result is wide."""
    return sorted(r[0] for r in table.where(F.col(by).isNotNull()).select(by).distinct().collect())


def widen(table: DataFrame, keys: list[str], by: str, columns: list[str], values: list[str] | None = None, bare: bool = False, chunk: int = CHUNK) -> DataFrame:
    """A row for each of ``keys``, a column ``<value>_<column>`` (``bare``: ``<value>``) for
    each value of ``by`` and each of the number columns; 0 where there is nothing.

    ``values`` are found in the table if not given. So that no aggregate has more than
    ``chunk`` values' columns, wider tables are pivoted in parts, each from its own rows,
    and joined on the keys.
    """
    values = found(table, by) if values is None else values
    parts = [values[a : a + chunk] for a in range(0, len(values), chunk)] or [[]]
    out = table.select(*keys).distinct() if len(parts) > 1 or not values else None
    for part in parts if values else []:
        own = table if len(parts) == 1 else table.where(F.col(by).isin(part))
        made = own.groupBy(*keys).pivot(by, part).agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns])
        if len(columns) == 1 and not bare:
            made = made.withColumnsRenamed({v: f"{v}_{columns[0]}" for v in part})
        out = made if out is None else out.join(made, keys, "left")
    return out.na.fill(0)
