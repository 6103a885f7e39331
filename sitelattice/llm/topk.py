"""Operator 6 - exact top-k inner products by no-random-access aggregation.

Every component of the vectors is a list of candidates sorted by it. The lists are
read on step by step, to the same depth each, from the large end for a query whose own
component is positive and from the small end for a negative one. Of a candidate only
the entries already read count; what a list has not shown of it lies between the list's
last value and the value read last, so its score lies between two bounds. Whoever's
upper bound is below the k-th best lower bound is out. A query stops on its own, as soon
as few candidates are left; only their scores are then resolved. Queries that are never
left with few read their lists to the end, where the bounds are the scores.

Candidates are read where they lie, in blocks of ``CELLS`` numbers a task; a query
carries its k best from block to block, so later blocks begin with a bar. Queries are
broadcast in blocks of ``QUERY_BYTES`` at most, one alive at a time, each a pass over the
candidates; a pass writes each task's k best a query, which meet in a rank whose limit
Spark applies before the shuffle. Of equal vectors in a block only the k + 1 smallest
ids are looked at. The work is that of all rows against the stated queries, which grows
with both; memory does not.

Nulls: vectors that are null or hold null or non-finite components take no part, nor
do rows without an id. Rows alike in id and vector count once; a query's own are all
rows of its id. Only vectors of the same length are compared. Ties go to the smaller
id, also among equal vectors. Scores beyond a long count as the largest or smallest
one. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

K = 5
SCALE = 256
QUERY_BYTES = 32 << 20
CELLS = 1 << 19
DEPTHS = (0.25, 0.5, 0.7, 0.8, 0.875, 0.93, 0.97)
FEW = 1 / 64
_CHUNK = 256
_SLICE = 1 << 16
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_EDGE = 2.0**63 * (1 - 2.0**-50)
CELL = "query_id long, qkey long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, q): whole-number vectors of the rows that take part."""
    x = F.col(vector_col)
    fine = x.isNotNull() & F.col(id_col).isNotNull() & F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return (
        vectors.where(fine)
        .select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale)))).alias("q"))
        .dropDuplicates(["id", "q"])
    )


class Lists:
    """The sorted lists of a block of candidates, read from both ends in step."""

    def __init__(self, x: np.ndarray):
        self.n, d = x.shape
        self.order = np.argsort(x, axis=0, kind="stable")
        self.values = np.take_along_axis(x, self.order, axis=0).astype(float)
        self.depth, self.column = 0, np.arange(d)[None, :]
        #: What has been read, from the large and from the small ends.
        self.seen = [np.zeros(x.shape, bool) for _ in range(2)]
        self.known = [np.zeros(x.shape) for _ in range(2)]

    def read_to(self, depth: int) -> None:
        for end, part in enumerate((slice(self.n - depth, self.n - self.depth), slice(self.depth, depth))):
            rows = self.order[part]
            self.known[end][rows, self.column] = self.values[part]
            self.seen[end][rows, self.column] = True
        self.depth = depth

    def bounds(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per end: the best and the worst value that each entry can have."""
        last, far = (self.values[self.n - self.depth], self.values[self.depth - 1]), (self.values[0], self.values[-1])
        best, worst = ([np.where(s, k, v) for s, k, v in zip(self.seen, self.known, limit, strict=True)] for limit in (last, far))
        return best, worst


class Search:
    """The k best candidates of each query among the blocks added so far."""

    def __init__(self, queries: np.ndarray, own: np.ndarray, k: int = K):
        self.q, self.own, self.k = queries.astype(np.int64), own, k
        f = queries.astype(float)
        self.size, self.up, self.down = np.abs(f), np.maximum(f, 0), np.minimum(f, 0)
        m = len(queries)
        self.score, self.id, self.found = np.full((m, k), _LEAST), np.full((m, k), _MOST), np.zeros(m, np.int64)
        self.read, self.entries = np.zeros(m, np.int64), 0  # entries of the lists: read by each query, and all

    def add(self, x: np.ndarray, ids: np.ndarray) -> None:
        x, ids = _few_of_equal(x, ids, self.k + 1)
        n, d = x.shape
        if not n or not len(self.q):
            return
        lists, open_ = Lists(x), np.arange(len(self.q))
        margin = (d + 4) * 2.0**-52 * (self.size @ np.abs(x.astype(float)).max(axis=0, initial=0))  # of rounding, in large numbers
        few = max(4 * self.k, int(FEW * n))
        self.entries += n * d
        for depth in sorted({max(1, int(f * n)) for f in DEPTHS} | {n}):
            lists.read_to(depth)
            best, worst = lists.bounds()
            rest = []
            for a in range(0, len(open_), _CHUNK):
                at = open_[a : a + _CHUNK]
                upper = self.up[at] @ best[0].T + self.down[at] @ best[1].T
                lower = self.up[at] @ worst[0].T + self.down[at] @ worst[1].T
                mine = self.own[at][:, None] == ids[None, :]
                lower[mine] = -np.inf
                last = self.score[at, -1].astype(float)
                bar = np.where(self.found[at] >= self.k, last - np.abs(last) * 2.0**-52, -np.inf)
                if n > self.k:
                    bar = np.maximum(bar, np.partition(lower, n - self.k, axis=1)[:, n - self.k] - margin[at])
                # Scores beyond a long are one score: no bar lies among them.
                bar = np.where(bar <= -_EDGE, -np.inf, np.minimum(bar, _EDGE))
                alive = (upper + margin[at][:, None] >= bar[:, None]) & ~mine
                done = (alive.sum(axis=1) <= few) | (depth == n)
                self.read[at[done]] += depth * d
                i, j = np.nonzero(alive & done[:, None])
                self._take(at[i], j, x, ids)
                rest.append(at[~done])
            open_ = np.concatenate(rest)
            if not len(open_):
                break

    def _take(self, rows: np.ndarray, j: np.ndarray, x: np.ndarray, ids: np.ndarray) -> None:
        """Resolve the scores of the pairs and keep each query's k best."""
        if not len(rows):
            return
        scores = np.concatenate([_scores(self.q[rows[a : a + _SLICE]], x[j[a : a + _SLICE]]) for a in range(0, len(rows), _SLICE)])
        touched = np.unique(rows)
        had = np.arange(self.k)[None, :] < self.found[touched][:, None]
        row = np.concatenate((rows, np.repeat(touched, self.found[touched])))
        score = np.concatenate((scores, self.score[touched][had]))
        id_ = np.concatenate((ids[j], self.id[touched][had]))
        order = np.lexsort((id_, ~score, row))
        row, score, id_ = row[order], score[order], id_[order]
        first = np.concatenate(([True], row[1:] != row[:-1]))
        rank = np.arange(len(row)) - np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
        kept = rank < self.k
        self.score[row[kept], rank[kept]], self.id[row[kept], rank[kept]] = score[kept], id_[kept]
        np.maximum.at(self.found, row[kept], rank[kept] + 1)

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, candidate id, score)."""
        i, r = np.nonzero(np.arange(self.k)[None, :] < self.found[:, None])
        return i, self.id[i, r], self.score[i, r]


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products row by row; those that a long may not hold, in numbers of any size."""
    out = np.einsum("ij,ij->i", q, x)
    reach = np.abs(q.astype(float)).max(axis=1, initial=0) * np.abs(x.astype(float)).max(axis=1, initial=0) * max(1, q.shape[1])
    for i in np.flatnonzero(reach >= 2.0**62):
        out[i] = max(_LEAST, min(_MOST, sum(a * b for a, b in zip(q[i].tolist(), x[i].tolist(), strict=True))))
    return out


def _few_of_equal(x: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows with equal vectors, those of the ``most`` smallest ids."""
    if not x.shape[1] or not len(x):
        kept = np.argsort(ids, kind="stable")[:most]
        return x[kept], ids[kept]
    same = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel(), return_inverse=True)[1]
    order = np.lexsort((ids, same))
    group = same[order]
    first = np.concatenate(([True], group[1:] != group[:-1]))
    place = np.arange(len(group)) - np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
    kept = order[place < most]
    return x[kept], ids[kept]


def _matrices(column) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Per vector length: (length, places of the rows, their values)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.int64()))
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
    return [(int(d), (at := np.flatnonzero(sizes == d)), flat[(ends[at] - d)[:, None] + np.arange(d)[None, :]].astype(np.int64)) for d in np.unique(sizes)]


def _pass(candidates: DataFrame, block: pa.Table, first_key: int, k: int) -> tuple[DataFrame, object]:
    """One block of queries over all candidates: each task's k best a query."""
    ids = block.column("id").to_numpy()
    shared = candidates.sparkSession.sparkContext.broadcast([(d, ids[at], first_key + at, q) for d, at, q in _matrices(block.column("q"))])

    def run(batches):
        searches = {d: (Search(q, own, k), own, keys) for d, own, keys, q in shared.value}
        held: dict[int, list] = {d: [] for d in searches}

        def add(d: int) -> None:
            if held[d]:
                searches[d][0].add(np.concatenate([x for x, _ in held[d]]), np.concatenate([i for _, i in held[d]]))
                held[d] = []

        for b in batches:
            theirs = b.column("id").to_numpy()
            for d, at, x in _matrices(b.column("q")):
                step = max(64, CELLS // max(1, d))
                for a in range(0, len(at) if d in held else 0, step):
                    held[d].append((x[a : a + step], theirs[at[a : a + step]]))
                    if sum(len(i) for _, i in held[d]) >= step:
                        add(d)
        for d, (search, own, keys) in searches.items():
            add(d)
            i, found, score = search.results()
            for a in range(0, len(i), _SLICE):
                part = slice(a, a + _SLICE)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (own[i[part]], keys[i[part]], found[part], score[part])], ["query_id", "qkey", "vec_id", "score"])

    return candidates.mapInArrow(run, CELL), shared


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that the condition ``is_query``,
    a column over ``id``, names."""
    spark = vectors.sparkSession
    common.bounded_batches(spark)
    rows = common.persist_table(quantised(vectors, scale, id_col, vector_col), "vectors")
    queries = rows.where(is_query)
    total = queries.agg(F.sum(F.size("q").cast("long") * 8 + 64)).first()[0] or 0
    blocks = -(-total // query_bytes)
    path, key = common.new_path(spark, "topk-cells"), 0
    spark.createDataFrame([], CELL).write.parquet(path)
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("id", "q"), F.lit(blocks)) == b).toArrow()
        found, shared = _pass(rows, block, key, k)
        found.write.mode("append").parquet(path)
        shared.destroy()
        key += block.num_rows
    order = Window.partitionBy("query_id", "qkey").orderBy(F.desc("score"), "vec_id")
    cells = spark.read.schema(CELL).parquet(path)
    return cells.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(common.table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


OP6_SQL = """
with v as (select distinct vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
           from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (select a.vec_id as query_id, b.vec_id as vec_id,
            list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) as score
          from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 50 = 0),
ranked as (select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from pairs)
select query_id, cast(rank as integer) as rank, vec_id, cast(score as bigint) as score from ranked where rank <= 5
"""
