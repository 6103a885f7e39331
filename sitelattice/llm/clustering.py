"""Operator 12 - centroid clustering by plain Lloyd rounds in whole numbers.

Vectors become integers once and are written; every round broadcasts the ``k``
centroids, each task takes the integer squared differences to one centroid after the
other in numpy, and the lowest index of the least distance wins. A task hands on one
sum per cluster and component, not rows, and these meet in a group-by on cluster and
component, so a cluster that holds most rows is no one's work. The driver sees ``k``
times the length of a vector numbers a round, whatever the input. Everything is exact,
so neither the order of rows nor their partitions matter.

The first centroids are the vectors whose ids have the ``k`` least digests.

Nulls: vectors that are null, of another length, or hold null or non-finite components
are left out. Rows without an id are clustered but never a first centroid. Repeated rows
each count and each give a row; of rows alike in id the lesser vector comes first. With
fewer vectors than ``k`` there are as many centroids as vectors with ids. A table without such vectors
gives an empty result. Distances and sums beyond a long count as the largest long. Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, whole

K = 8
ROUNDS = 10
SCALE = 1024
LENGTH = 64
SEED = "3"


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest centroid, the lowest index of equals, and its squared distance."""
    values, centroids = whole.same_kind(values, centroids)
    distances = np.stack([whole.squared(values - c) for c in centroids])
    at = distances.argmin(axis=0)
    return at, distances[at, np.arange(len(values))]


def _first(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    found = rows.where("id is not null").select(digest.alias("digest"), "q").orderBy("digest", "q").limit(k).collect()
    return np.array([r["q"] for r in found], dtype=object)


def _gathered(rows: DataFrame, centroids: np.ndarray) -> dict[tuple, tuple[int, int]]:
    """What the rows nearest to each centroid sum up to."""
    shared = rows.sparkSession.sparkContext.broadcast(whole.exact(centroids))

    def run(batches):
        fixed = shared.value
        sums = whole.Sums(*fixed.shape)
        for b in batches:
            x = whole.matrix(b["q"], fixed.shape[1])
            sums.add(x, *nearest(x, fixed))
        yield sums.rows()

    out = whole.merged(rows.select("q").mapInPandas(run, whole.SUMS))
    shared.destroy()
    return out


def lloyd(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, length: int = LENGTH, seed: str = SEED, id_col: str = "vec_id", vector_col: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """(id, cluster, distance) of every vector that takes part, and (cluster, n, centroid,
    cluster_inertia, inertia) of the at most ``k`` clusters, empty ones included."""
    spark = vectors.sparkSession
    common.bounded_batches(spark)
    x = F.col(vector_col)
    fine = (F.size(x) == length) & whole.takes_part(x)
    rows = common.persist_table(vectors.where(fine).select(F.col(id_col).alias("id"), whole.floored(x, scale).alias("q")), "vectors")
    centroids = _first(rows, k, seed)
    kind = rows.schema["id"].dataType.simpleString()
    out, shape = f"id {kind}, cluster int, distance long", "cluster int, n long, centroid array<long>, cluster_inertia long, inertia long"
    if not len(centroids):
        return spark.createDataFrame([], out), spark.createDataFrame([], shape)
    for _ in range(rounds):
        sums = _gathered(rows, centroids)
        centroids = np.array([[total // n if n else c[p] for p, (total, n) in enumerate(sums.get((g, p), (0, 0)) for p in range(length))] for g, c in enumerate(centroids)], dtype=object)
    last = _gathered(rows, centroids)
    inertia = [last.get((g, -1), (0, 0)) for g in range(len(centroids))]
    whole_inertia = min(whole.LARGEST, sum(total for total, _ in inertia))
    clusters = [(g, n, c.tolist(), min(whole.LARGEST, total), whole_inertia) for g, (c, (total, n)) in enumerate(zip(centroids, inertia, strict=True))]
    shared = spark.sparkContext.broadcast(whole.exact(centroids))

    def run(batches):
        for b in batches:
            at, distance = nearest(whole.matrix(b["q"], length), shared.value)
            yield pd.DataFrame({"id": b["id"], "cluster": at.astype(np.int32), "distance": whole.as_longs(distance)})

    assigned = rows.withColumn("id", F.col("id").cast("string")).mapInPandas(run, out.replace(kind, "string", 1))  # pandas would round ids beside nulls
    return assigned.withColumn("id", F.col("id").cast(kind)), spark.createDataFrame(clusters, shape)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, clusters = lloyd(common.table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256")
    few = F.broadcast(clusters.select("cluster", "cluster_inertia", "inertia", digest))  # K rows at most
    return assigned.join(few, "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    d = f"list_sum(list_transform(range(1, {LENGTH} + 1), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))"
    near = f"select v.vec_id, v.row, min(struct_pack(d := {d}, cluster := c.cluster)) as best from v, {{at}} c group by v.vec_id, v.row"
    parts = [
        f"""v as materialized (select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as q from embeddings
            where embedding is not null and len(embedding) = {LENGTH} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"""c0 as materialized (select cast(row_number() over (order by sha256('{SEED}:' || vec_id), q) - 1 as integer) as cluster, q from v where vec_id is not null
            order by sha256('{SEED}:' || vec_id), q limit {K})""",
    ]
    for r in range(ROUNDS):
        parts.append(f"a{r} as materialized ({near.format(at=f'c{r}')})")
        parts.append(
            f"""c{r + 1} as materialized (select o.cluster, coalesce(n.q, o.q) as q from c{r} o left join
              (select cluster, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as q from
                (select a.best.cluster as cluster, t.i as i, sum(v.q[t.i]) as s, count(*) as n from a{r} a join v on v.row = a.row, range(1, {LENGTH + 1}) t(i) group by all)
               group by cluster) n on n.cluster = o.cluster)"""
        )
    parts.append(f"last as materialized ({near.format(at=f'c{ROUNDS}')})")
    return "with " + ",\n".join(parts) + f"""
select l.vec_id, l.best.cluster as cluster, cast(l.best.d as bigint) as distance,
  cast(sum(l.best.d) over (partition by l.best.cluster) as bigint) as cluster_inertia, cast(sum(l.best.d) over () as bigint) as inertia,
  sha256(array_to_string(c.q, ',')) as centroid_sha256
from last l join c{ROUNDS} c on c.cluster = l.best.cluster"""


OP12_SQL = _sql()
