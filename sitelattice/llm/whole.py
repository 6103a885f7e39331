"""Whole-number vectors, shared by the operators that compute on them exactly.

Components become integers by a scale and a floor. Arrays of them are 64-bit as long as
no squared distance can leave that range (components within ``SMALL``), and Python's own
integers otherwise, slower and as exact. What Spark sums is a decimal; what is returned
as a long and does not fit is the largest long.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: With components within this, 64 squared differences, and more, sum up within 2^63.
SMALL = 1 << 27
#: Vectors of more components than this are computed in Python's integers.
LONGEST = 64
LARGEST = (1 << 63) - 1


def takes_part(vector: Column) -> Column:
    """Not null, and neither null nor non-finite components."""
    return vector.isNotNull() & F.forall(vector, lambda v: F.coalesce(F.abs(v.cast("double")) < F.lit(float("inf")), F.lit(False)))


def floored(vector: Column, scale: int) -> Column:
    """floor(scale * component) as longs."""
    return F.transform(vector, lambda v: F.floor(v.cast("double") * F.lit(float(scale))))


def exact(values: np.ndarray) -> np.ndarray:
    """Rows of integers in the type in which their squared distances are exact."""
    small = values.shape[1] <= LONGEST and (not values.size or (values.max() <= SMALL and values.min() >= -SMALL))
    return values.astype(np.int64 if small else object)


def matrix(column: pd.Series, length: int) -> np.ndarray:
    """A column of equally long lists as rows."""
    flat = np.concatenate(column.to_numpy()) if len(column) else np.zeros(0, np.int64)
    return exact(flat.reshape(len(column), length))


def same_kind(values: np.ndarray, fixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as Python's integers if one is."""
    return (values.astype(object), fixed.astype(object)) if object in (values.dtype, fixed.dtype) else (values, fixed)


def squared(difference: np.ndarray) -> np.ndarray:
    """Row by row, the sum of squares."""
    return (difference * difference).sum(axis=1) if difference.dtype == object else np.einsum("ij,ij->i", difference, difference)


def as_longs(values: np.ndarray) -> np.ndarray:
    return np.minimum(values, LARGEST).astype(np.int64)


class Sums:
    """Per group of a partition: the count of its rows, their componentwise sum and the
    sum of their distances, as Python's integers."""

    def __init__(self, groups: int, length: int):
        self.count = np.zeros(groups, object)
        self.total = np.zeros((groups, length), object)
        self.distance = np.zeros(groups, object)

    def add(self, values: np.ndarray, group: np.ndarray, distance: np.ndarray) -> None:
        for g in np.unique(group):
            rows = group == g
            self.count[g] += int(rows.sum())
            self.total[g] += values[rows].sum(axis=0)
            self.distance[g] += sum(as_longs(distance[rows]).tolist())

    def rows(self, **keys: int) -> pd.DataFrame:
        """One row per group and place that has rows; place -1 holds the distances."""
        out = [
            (*keys.values(), g, place, Decimal(int(value)), int(self.count[g]))
            for g in np.flatnonzero(self.count)
            for place, value in enumerate([self.distance[g], *self.total[g]], -1)
        ]
        return pd.DataFrame(out, columns=[*keys, "grp", "place", "total", "n"])


#: What ``Sums.rows`` gives, after its keys.
SUMS = "grp int, place int, total decimal(38,0), n long"


def merged(parts: DataFrame, *keys: str) -> dict[tuple, tuple[int, int]]:
    """The partitions' sums added up: (keys, group, place) -> (total, count). As many rows
    as there are groups and places come to the driver, whatever the input."""
    by = [*keys, "grp", "place"]
    rows = parts.groupBy(*by).agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    return {tuple(r[k] for k in by): (int(r["total"]), r["n"]) for r in rows}
