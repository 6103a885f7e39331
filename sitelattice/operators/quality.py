"""Quality checks of consolidated clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelattice.functions import seq

SAMPLE = 50
SHOWN = 5
KEY = "consolidated_motif_id"


def cluster_profile(sites: DataFrame, order: str = "src_ord") -> DataFrame:
    """One row a cluster: sites, unique sequences, diversity, patterns merged, length
    range, variance of base composition over its first sequences, samples, consensus.

    The first rows are a window rank that Spark limits before the shuffle.
    """
    whole = sites.groupBy(KEY).agg(
        F.count("*").alias("n_sites"),
        F.countDistinct("sequence").alias("n_unique"),
        F.countDistinct("original_streme_consensus").alias("n_patterns"),
        F.min(F.length("sequence")).alias("min_length"),
        F.max(F.length("sequence")).alias("max_length"),
        F.min("motif_consensus").alias("motif_consensus"),
    )
    first = sites.select(KEY, order, "sequence").withColumn("k", F.row_number().over(Window.partitionBy(KEY).orderBy(order))).where(F.col("k") <= SAMPLE)
    shares = first.groupBy(KEY).agg(
        *[F.var_pop(seq.base_fraction(F.col("sequence"), b)).alias(f"v_{b}") for b in "ATGC"],
        F.array_sort(F.collect_list(F.when(F.col("k") <= SHOWN, F.struct("k", "sequence")))).alias("shown"),
    )
    variance = F.col("v_A") + F.col("v_T") + F.col("v_G") + F.col("v_C")
    return whole.join(shares, KEY).select(
        KEY, "n_sites", "n_unique", (F.col("n_unique") / F.col("n_sites")).alias("diversity"), "n_patterns", "min_length", "max_length",
        variance.alias("composition_variance"), F.array_join(F.transform("shown", lambda x: x["sequence"]), ",").alias("samples"), "motif_consensus",
    )


def flags() -> dict[str, Column]:
    return {
        "high_diversity": (F.col("diversity") > F.lit(0.8)) & (F.col("n_sites") > 20),
        "many_patterns": F.col("n_patterns") > 3,
        "mixed_composition": F.col("composition_variance") > F.lit(0.3),
        "mixed_length": F.col("max_length") - F.col("min_length") > 5,
    }


def cluster_flags(profile: DataFrame) -> DataFrame:
    """Flags as 0 or 1, the issues' names, and what to do about flagged clusters."""
    f = flags()
    issues = F.array_join(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in f.items()]), lambda x: x.isNotNull()), ",")
    any_ = F.greatest(*[c.cast("int") for c in f.values()])
    advice = F.when(any_ == 0, "none").when(F.col("composition_variance") > F.lit(0.4), "split").when(F.col("n_patterns") > 5, "raise threshold").otherwise("review")
    return profile.select(KEY, "n_sites", *[c.cast("int").alias(n) for n, c in f.items()], issues.alias("issues"), any_.alias("suspicious"), advice.alias("recommendation"))


def worst_clusters(flagged: DataFrame, n: int = 10) -> DataFrame:
    return flagged.where("suspicious = 1").orderBy(F.desc("n_sites"), KEY).limit(n).select(KEY, "n_sites", "issues", "recommendation")


def size_histogram(profile: DataFrame) -> DataFrame:
    n = F.col("n_sites")
    return profile.agg(
        F.count_if(n == 1).alias("single"), F.count_if((n >= 2) & (n <= 10)).alias("small"), F.count_if((n >= 11) & (n <= 100)).alias("medium"), F.count_if(n > 100).alias("large")
    )


def verdict(profile: DataFrame) -> DataFrame:
    """Share of flagged clusters and the verdict; nulls for an empty table."""
    bad = F.greatest(*[c.cast("int") for c in flags().values()])
    return profile.agg(
        F.count("*").alias("n_clusters"), F.coalesce(F.sum(bad), F.lit(0)).alias("n_flagged"), F.avg("n_patterns").alias("mean_patterns"), F.max("n_patterns").alias("max_patterns")
    ).select(
        "n_clusters", "n_flagged", "mean_patterns", "max_patterns",
        F.try_divide("n_flagged", "n_clusters").alias("flagged_share"),
        F.when(F.col("n_clusters") == 0, F.lit(None)).when(F.col("n_flagged") < F.col("n_clusters") * F.lit(0.05), "good").when(F.col("n_flagged") < F.col("n_clusters") * F.lit(0.15), "moderate").otherwise("fail").alias("verdict"),
    )
