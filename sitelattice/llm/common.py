"""Helpers shared by the training-data operators: table access, durable
intermediate tables and distributed connected components."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelattice.plans.tables import drop_path, drop_written, new_path, persist_table, shared_dir, written  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A named table. Python workers also look for this package where the driver
    found it, whatever folder the driver was started in."""
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [environment.get("PYTHONPATH", ""), root]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, size: str = "8m") -> None:
    """Arrow batches of whole texts for this session: bounded by bytes, since a text's
    length is not."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def fresh(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


#: Keys that hold more than one row in ``HEAVY`` are at most this many.
HEAVY = 50_000


def join_unique(left: DataFrame, right: DataFrame, key: str, counted: DataFrame | None = None, least: int = 1000) -> DataFrame:
    """``left`` joined to ``right`` on ``key``, which is unique in ``right``; keys with very
    many rows are no single task's work.

    Keys that hold over one row in ``HEAVY`` (and over ``least``) number at most ``HEAVY``,
    so their rows of ``right`` are broadcast, whatever the input. ``counted`` (key, n) may
    be given; both sides are read twice and should be tables.
    """
    spark = left.sparkSession
    counted = left.groupBy(key).agg(F.count("*").alias("n")) if counted is None else counted
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = persist_table(counted.where(F.col("n") > max(least, total // HEAVY)).select(key), "heavy")
    if not heavy.take(1):
        return left.join(right, key)
    few = persist_table(right.join(F.broadcast(heavy), key, "left_semi"), "heavy-rows")
    hot = left.join(F.broadcast(few), key)
    return left.join(F.broadcast(heavy), key, "left_anti").join(right, key).unionByName(hot)


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node in ``edges``; component is the smallest
    node reachable.

    Alternates two star steps (each node's larger neighbours go to its smallest
    neighbour, then each node's smaller ones do) until nothing changes; the
    number of rounds is logarithmic in the size of a component. Every round is a
    written table. The minimum of a node's neighbours is a partial aggregate, and
    the join that hands it out is a plain sort-merge join that adaptive execution
    may split, so a node with very many neighbours is not one task's work.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    path = new_path(spark, "cc")
    pairs = persist_table(pairs, "cc", path)
    seen = None
    while True:
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct()
        )
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        new_at = new_path(spark, "cc")
        small = persist_table(small, "cc", new_at)
        state = small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        drop_path(spark, path)
        path, pairs = new_at, small
        if (state["n"], state["h"]) == seen:
            break
        seen = (state["n"], state["h"])
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
