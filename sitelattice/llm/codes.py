"""Operator 11 - vector code compression: product codes by whole-number Lloyd rounds.

Vectors become integers and are cut into ``parts`` equal pieces; each piece position has
a codebook of at most ``entries`` entries. Every round builds one kd-tree per codebook on
the driver and broadcasts them (parts times entries pieces, whatever the input). A task
searches a batch of pieces at a time: the rows at a node go to the nearer child box
first and then to the other if its box is no farther than the best so far. Boxes that
are exactly as far are visited too, so of equal entries the lower index survives.
A task hands on integer sums per entry and place, which meet in a group-by.

Nulls: vectors that are null or hold null or non-finite components are left out, as are
those of another length than most (the shorter on a tie) or of one that ``parts`` does
not divide. Rows without an id are coded but start no codebook. Repeated rows each count
and give a row; an id starts one entry, that of its least vector. With fewer ids than
``entries`` the codebooks have as many entries as there are ids. A table without such
vectors gives an empty result. Errors beyond a long count as the largest long. Null
labels count as one label. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, whole

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LEAF = 2


class Tree:
    """A kd-tree over the entries of one codebook, for batches of pieces."""

    def __init__(self, entries: np.ndarray):
        self.entries = whole.exact(entries)
        self.root = self._node(np.arange(len(entries)))

    def _node(self, ids: np.ndarray) -> tuple:
        own = self.entries[ids]
        low, high = own.min(axis=0), own.max(axis=0)
        wide = int((high - low).argmax())
        if len(ids) <= LEAF or high[wide] == low[wide]:
            return low, high, ids, ()
        order = ids[np.argsort(own[:, wide], kind="stable")]
        half = len(order) // 2
        return low, high, None, (self._node(order[:half]), self._node(order[half:]))

    def nearest(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each piece's nearest entry, the lowest index of equals; its squared distance;
        and how many distances were taken."""
        pieces, entries = whole.same_kind(pieces, self.entries)
        n = len(pieces)
        best = np.full(n, np.iinfo(np.int64).max) if pieces.dtype != object else np.full(n, float("inf"), object)
        at, taken = np.full(n, len(entries)), 0

        def gap(node: tuple, rows: np.ndarray) -> np.ndarray:
            x = pieces[rows]
            return whole.squared(np.maximum(node[0] - x, 0) + np.maximum(x - node[1], 0))

        def visit(node: tuple, rows: np.ndarray) -> None:
            nonlocal taken
            if not len(rows):
                return
            _, _, ids, children = node
            if ids is not None:
                x = pieces[rows]
                taken += len(rows) * len(ids)
                for e in ids:
                    d = whole.squared(x - entries[e])
                    better = (d < best[rows]) | ((d == best[rows]) & (e < at[rows]))
                    best[rows[better]], at[rows[better]] = d[better], e
                return
            near = [gap(c, rows) for c in children]
            left = np.asarray(near[0] <= near[1], bool)
            for side, own in ((0, left), (1, ~left)):
                visit(children[side], rows[own])
                reached = np.asarray(near[1 - side][own] <= best[rows[own]], bool)
                visit(children[1 - side], rows[own][reached])

        visit(self.root, np.arange(n))
        return at, best, taken


def pieces(values: np.ndarray, part: int, parts: int) -> np.ndarray:
    size = values.shape[1] // parts
    return values[:, part * size : (part + 1) * size]


def _usual_length(sizes: DataFrame, parts: int) -> int:
    found = sizes.where((F.col("size") > 0) & (F.col("size") % parts == 0)).groupBy("size").count().orderBy(F.desc("count"), "size").first()
    return found["size"] if found else 0


def _gathered(rows: DataFrame, books: list[np.ndarray], length: int) -> dict[tuple, tuple[int, int]]:
    shared = rows.sparkSession.sparkContext.broadcast([Tree(b) for b in books])
    n, parts = len(books[0]), len(books)

    def run(batches):
        sums = [whole.Sums(n, length // parts) for _ in range(parts)]
        for b in batches:
            x = whole.matrix(b["q"], length)
            for p, tree in enumerate(shared.value):
                own = pieces(x, p, parts)
                at, distance, _ = tree.nearest(own)
                sums[p].add(own, at, distance)
        for p in range(parts):
            yield sums[p].rows(part=p)

    out = whole.merged(rows.select("q").mapInPandas(run, f"part int, {whole.SUMS}"), "part")
    shared.destroy()
    return out


def product_codes(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", keep: tuple[str, ...] = (),
) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, *keep, code, error) of every vector that takes part, and the codebooks: an
    array of entries for each part position."""
    spark = vectors.sparkSession
    common.bounded_batches(spark)
    x = F.col(vector_col)
    fine = vectors.where(whole.takes_part(x))
    length = _usual_length(fine.select(F.size(x).alias("size")), parts)
    kept = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    rows = common.persist_table(fine.where(F.size(x) == length).where(F.lit(length > 0)).select(F.col(id_col).alias("id"), *kept, whole.floored(x, scale).alias("q")), "vectors")
    least = rows.where("id is not null").groupBy("id").agg(F.min("q").alias("q")).orderBy("id").limit(entries)
    first = np.array([r["q"] for r in least.collect()], dtype=object)
    out = rows.drop("q").withColumns({"code": F.lit(None).cast("array<int>"), "error": F.lit(None).cast("long")})
    names = ["id", *keep, "code", "error"]
    if not len(first):
        return out.where("false").toDF(*names), []
    books = [pieces(first, p, parts) for p in range(parts)]
    for _ in range(rounds):
        sums, size = _gathered(rows, books, length), length // parts
        books = [
            np.array([[total // n if n else e[c] for c, (total, n) in enumerate(sums.get((p, g, c), (0, 0)) for c in range(size))] for g, e in enumerate(book)], dtype=object)
            for p, book in enumerate(books)
        ]
    shared = spark.sparkContext.broadcast([Tree(b) for b in books])

    def run(batches):
        for b in batches:
            x = whole.matrix(b.column("q").to_pandas(), length)
            found = [tree.nearest(pieces(x, p, parts)) for p, tree in enumerate(shared.value)]
            code = np.stack([at for at, _, _ in found], axis=1).astype(np.int32)
            error = whole.as_longs(sum(d.astype(object) for _, d, _ in found))
            made = [pa.array(list(code), pa.list_(pa.int32())), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *made], [*b.schema.names[:-1], "code", "error"])

    return rows.mapInArrow(run, out.schema).toDF(*names), books


def label_errors(coded: DataFrame, label: str) -> DataFrame:
    """``coded``, a table, with ``label_error``: the errors of equal labels summed, nulls
    together. Summed before they are dealt out, and a label of very many rows is not one
    task's work."""
    key = common.fresh("key", coded)
    rows = coded.withColumn(key, _key(F.col(label)))
    sums = common.persist_table(rows.groupBy(key).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"), F.count("*").alias("n")), "label-errors")
    joined = common.join_unique(rows, sums.select(key, F.least("total", F.lit(whole.LARGEST).cast("decimal(38,0)")).cast("long").alias("label_error")), key, sums.select(key, "n"))
    return joined.drop(key)


def _key(label: Column) -> Column:
    return F.when(label.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), label.cast("string")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = product_codes(common.table(spark, sf_dir, "embeddings"), keep=("label",))
    with_label = label_errors(common.persist_table(coded, "codes"), "label")
    text = ",".join(str(v) for book in books for entry in book for v in entry)
    code = F.lower(F.array_join(F.transform("code", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    return with_label.select(
        F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def _sql() -> str:
    floor = f"list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint))"
    near = """select v.row, v.part, min(struct_pack(d := list_sum(list_transform(range(1, len(v.q) + 1), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i]))), entry := c.entry)) as best
              from v join {at} c on c.part = v.part group by v.row, v.part"""
    cte = [
        "fine as (select * from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        f"usual as (select len(embedding) as d from fine where len(embedding) > 0 and len(embedding) % {PARTS} = 0 group by 1 order by count(*) desc, 1 limit 1)",
        f"w as materialized (select row_number() over () as row, vec_id, label, {floor} as q, d // {PARTS} as size from fine join usual on len(embedding) = d)",
        f"v as materialized (select w.row, p.part, w.q[p.part * size + 1 : (p.part + 1) * size] as q from w, range({PARTS}) p(part))",
        f"f as (select vec_id, min(struct_pack(q := q, row := row)).row as row from w where vec_id is not null group by 1 order by 1 limit {ENTRIES})",
        "c0 as materialized (select v.part, e.entry, v.q from (select row, row_number() over (order by vec_id) - 1 as entry from f) e join v on v.row = e.row)",
    ]
    for r in range(ROUNDS):
        cte.append(f"a{r} as materialized ({near.format(at=f'c{r}')})")
        cte.append(
            f"""c{r + 1} as materialized (select o.part, o.entry, coalesce(n.q, o.q) as q from c{r} o left join
              (select part, entry, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as q from
                (select v.part as part, a.best.entry as entry, t.i as i, sum(v.q[t.i]) as s, count(*) as n
                 from a{r} a join v on v.row = a.row and v.part = a.part, (select unnest(range(1, size + 1)) as i from (select distinct size from w)) t group by all)
               group by part, entry) n on n.part = o.part and n.entry = o.entry)"""
        )
    cte.append(f"last as materialized ({near.format(at=f'c{ROUNDS}')})")
    cte.append("coded as (select row, string_agg(printf('%02x', cast(best.entry as bigint)), '' order by part) as code, sum(best.d) as error from last group by 1)")
    cte.append(f"digest as (select sha256(string_agg(array_to_string(q, ','), ',' order by part, entry)) as h from c{ROUNDS})")
    return "with " + ",\n".join(cte) + """
select w.vec_id, coded.code, cast(coded.error as bigint) as error, cast(sum(coded.error) over (partition by w.label) as bigint) as label_error, digest.h as codebooks_sha256
from w join coded on coded.row = w.row, digest"""


OP11_SQL = _sql()
