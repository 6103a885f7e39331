"""Expression values: reshaping, profiles and joins with features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(wide: DataFrame, lines: list[str], gene: str = "gene_id") -> DataFrame:
    return wide.unpivot([gene], lines, "line", "expression")


def to_wide(long: DataFrame, lines: list[str]) -> DataFrame:
    return long.groupBy("gene_id").pivot("line", lines).agg(F.first("expression"))


def without_reference(long: DataFrame, reference: str) -> DataFrame:
    return long.where(F.col("line") != reference)


def difference(long: DataFrame, reference: str) -> DataFrame:
    """Expression of each line less the reference line's in the same gene."""
    base = long.where(F.col("line") == reference).select("gene_id", F.col("expression").alias("r"))
    return long.where(F.col("line") != reference).join(base, "gene_id").select("gene_id", "line", (F.col("expression") - F.col("r")).alias("expression_difference"))


def profile(long: DataFrame) -> DataFrame:
    e = F.col("expression")
    return long.agg(
        F.count(e).alias("n"), F.min(e).alias("least"), F.max(e).alias("most"), F.avg(e).alias("mean"), F.stddev_pop(e).alias("std_population"), F.stddev_samp(e).alias("std_sample"),
        F.try_divide(F.count_if(e == 0), F.count(e)).alias("zero_share"),
    )


def reference_is_zero(wide: DataFrame, reference: str, tolerance: float = 1e-6) -> DataFrame:
    return wide.agg(F.coalesce(F.max(F.abs(F.col(reference))) <= tolerance, F.lit(True)).alias("reference_is_zero"))


def attach(features: DataFrame, long: DataFrame, how: str = "inner") -> DataFrame:
    return features.join(long.select("gene_id", "line", "expression"), ["gene_id", "line"], how)
