"""A catalog of motifs that stands between runs: each run's motifs are matched against the
leaders stored so far, and only those that no leader claims become leaders themselves.

On disk a folder each for leaders (number, text) and members, with a part a run. A run's
members are written last and make it count: what a broken run left behind is not read,
and is written over when the run is repeated. A run that counts is not taken again. Runs
added in order give the clusters that one sweep over all of them gives, since a leader
never changes and every motif looks at the leaders before it in the same order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelattice.plans import tables

from . import cluster
from .encode import number_rows

LEADER = "run string, number int, text string"


def _part(path: str, kind: str, run: str) -> str:
    return f"{path.rstrip('/')}/{kind}/run={run}"


def _there(spark: SparkSession, path: str) -> bool:
    return tables.stamp(spark, f"{path}/_SUCCESS") is not None


def runs(spark: SparkSession, path: str) -> list[str]:
    """The runs that count: as many as were added."""
    at = f"{path.rstrip('/')}/members"
    if tables.stamp(spark, at) is None:
        return []
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
    names = [s.getPath().getName() for s in found if s.isDirectory()]
    return sorted(n.removeprefix("run=") for n in names if n.startswith("run=") and _there(spark, f"{at}/{n}"))


def leaders(spark: SparkSession, path: str) -> DataFrame:
    """(run, number, text) of the runs that count."""
    parts = [_part(path, "leaders", r) for r in runs(spark, path)]
    return spark.read.schema(LEADER).option("basePath", f"{path.rstrip('/')}/leaders").parquet(*parts) if parts else spark.createDataFrame([], LEADER)


def members(spark: SparkSession, path: str) -> DataFrame:
    """All motifs of the runs that count, with their run and ``cluster_no``."""
    parts = [_part(path, "members", r) for r in runs(spark, path)]
    if not parts:
        raise FileNotFoundError(f"no run was added to {path}")
    return spark.read.option("basePath", f"{path.rstrip('/')}/members").parquet(*parts)


def append(motifs: DataFrame, path: str, run: str, threshold: float = cluster.THRESHOLD, text: str = "consensus", order: str = "ord") -> bool:
    """Add a run's motifs, in their order; False, and nothing is done, if it counts already."""
    spark = motifs.sparkSession
    if run in runs(spark, path):
        return False
    known = tables.persist_table(leaders(spark, path), "leaders")
    last = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    new = tables.persist_table(number_rows(motifs, order).withColumn("_at", (F.col("n") + F.lit(last + 1)).cast("int")).drop("n"), "run")
    both = known.select(F.col("number").alias("ord"), F.col("text").alias("s")).unionByName(new.select(F.col("_at").alias("ord"), F.col(text).alias("s")))
    key = F.coalesce(F.when((F.length("s") >= 3) & F.lit(threshold <= 1), F.concat(F.lit("="), F.col("s"))), F.col("ord").cast("string"))
    placed = cluster.leaders_by_class(both, key, True, lambda heads: cluster.similar_pairs(heads, threshold, "s", since=last + 1))
    placed = tables.persist_table(placed.where(F.col("ord") > last).select("ord", "leader", "cluster_no", "s"), "placed")
    led = placed.where("ord = leader").select(F.col("cluster_no").alias("number"), F.col("s").alias("text"))
    led.write.mode("overwrite").parquet(_part(path, "leaders", run))
    found = new.join(placed.select(F.col("ord").alias("_at"), "cluster_no"), "_at").drop("_at")
    found.write.mode("overwrite").parquet(_part(path, "members", run))
    return True
