"""Operator 2 - SimHash near-duplicates by pivot distance tables.

A document's fingerprint has a bit set where over half of its word shingles'
XXH64 values have it. Two fingerprints link at ``radius`` or fewer differing bits;
the result is the connected components of that relation.

Finding the links, each distinct fingerprint counting once however many documents
have it:

* Hamming distances to ``PIVOTS`` reference fingerprints are tabled. By the triangle
  inequality two fingerprints within the radius differ by no more than it in any
  coordinate, so a larger maximum difference discards a pair before it is verified.
* The pairs to look at come from an exact pigeonhole: of ``blocks`` blocks of bits,
  ``radius`` differing bits leave at least ``blocks - radius`` untouched, so linked
  fingerprints agree in at least one choice of that many blocks. A fingerprint is
  dealt to its C(blocks, radius) keys of about 64 * (1 - radius / blocks) bits.
* Within a key, components grow from one member at a time; a member that has joined
  is never compared again, and only the edges of a spanning tree are emitted (at most
  n - 1 for n members, never all pairs). Members' distances to the growing member are
  the last, exact coordinate. A key with over ``large`` members is dealt further by
  the first pivots' distances in cells of radius + 1, each member to its cell and the
  one below: linked members share a cell, so nothing is lost.

Components of the edges come from ``common.connected_components``. Only
fingerprints and ids are shuffled, never texts. Large components and fingerprints of
very many rows get their names by a broadcast of bounded size (``common.join_unique``).

Nulls: a null text has no words (fingerprint zero, which links like any other). A
null doc_id is kept and is never a component's id; a component of null ids only has a
null id. Repeated rows and repeated ids each give a row. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SHINGLE = 4
RADIUS = 4
BLOCKS = 7
SEED = 42
PIVOTS = 16
LARGE = 4096


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text: words between ASCII white space,
    A-Z in lower case, shingles of ``size`` words with repeats."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # both touch ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - size + 1
    if n < 2:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: n - 1])).tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 15):  # bounded memory for very long texts
        ones += np.unpackbits(h[i : i + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(row, fp): each row of ``docs`` as a struct, and its fingerprint as a signed
    64-bit number."""
    common.bounded_batches(docs.sparkSession)
    rows = docs.select(F.struct(*docs.columns).alias("row"))

    def run(batches):
        for b in batches:
            row = b.column("row")
            fp = np.array([fingerprint(t.as_py(), size) for t in row.field(text_col)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([row, pa.array(fp.view(np.int64))], ["row", "fp"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("fp", T.LongType())]))


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: fixed, so that tables of different runs agree."""
    return np.array([xxhash.xxh64_intdigest(f"pivot {i}".encode(), SEED) for i in range(n)], dtype=np.uint64)


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """Distances of each fingerprint to each pivot, one row a fingerprint."""
    return np.bitwise_count(fp[:, None] ^ pivots()[None, :]).astype(np.int8)


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """Masks of every choice of ``blocks - radius`` blocks."""
    cut = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << cut[i + 1]) - 1) ^ ((1 << cut[i]) - 1) for i in range(blocks)]
    return [sum(c) for c in combinations(parts, blocks - radius)]


def spanning_edges(fp: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Index pairs that span the components of the distinct fingerprints ``fp``."""
    table = pivot_table(fp)
    open_ = np.arange(len(fp))
    edges: list[tuple[int, int]] = []
    while len(open_) > 1:
        stack, open_ = [int(open_[0])], open_[1:]
        while stack and len(open_):
            x = stack.pop()
            near = np.abs(table[open_] - table[x]).max(axis=1) <= radius
            near[near] = np.bitwise_count(fp[open_[near]] ^ fp[x]) <= radius
            if near.any():
                found = open_[near].tolist()
                edges += [(x, y) for y in found]
                stack += found
                open_ = open_[~near]
    return edges


def _pairs_of_two(keys: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked neighbours among rows sorted by key whose key has two rows."""
    same = keys[1:] == keys[:-1]
    alone = np.concatenate((~same, [True])) & np.concatenate(([True], ~same))
    two = same & ~np.concatenate(([False], same[:-1])) & ~np.concatenate((same[1:], [False]))
    a, b = fp[:-1][two], fp[1:][two]
    near = np.abs(pivot_table(a) - pivot_table(b)).max(axis=1, initial=0) <= radius
    near[near] = np.bitwise_count(a[near] ^ b[near]) <= radius
    rest = ~alone
    rest[:-1][two] = False
    rest[1:][two] = False
    return np.stack((a[near], b[near])), rest


def _link(batches, radius: int, columns: list[str]):
    """Rows sorted by key: edges of each key's spanning trees. A key may run over
    several batches."""
    held: list[tuple[np.ndarray, np.ndarray]] = []  # rows of the last, unfinished key

    def emit(keys, fp):
        pairs, rest = _pairs_of_two(keys, fp, radius)
        found = [pairs]
        keys, fp = keys[rest], fp[rest]
        cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True]))) if len(keys) else [0]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            part = fp[i:j]
            if edges := spanning_edges(part, radius):
                at = np.array(edges).T
                found.append(np.stack((part[at[0]], part[at[1]])))
        out = np.concatenate(found, axis=1).astype(np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1])], ["a", "b"])

    for batch in batches:
        keys = np.zeros(batch.num_rows, np.uint64)
        for c in columns:  # one number a key; a clash only puts more fingerprints side by side
            k = batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            keys = (keys ^ k) * np.uint64(0x9E3779B97F4A7C15)
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        held.append((keys, fp))
        if not len(keys):
            continue
        last = keys[-1]
        if keys[0] == last and (len(held) == 1 or held[0][0][-1] == last):
            continue
        keys, fp = (np.concatenate(x) for x in zip(*held, strict=True))
        n = int(np.flatnonzero(keys != last)[-1]) + 1
        yield emit(keys[:n], fp[:n])
        held = [(keys[n:], fp[n:])]
    if held:
        yield emit(*(np.concatenate(x) for x in zip(*held, strict=True)))


def links(fps: DataFrame, blocks: int = BLOCKS, radius: int = RADIUS, large: int = LARGE) -> DataFrame:
    """(a, b): linked fingerprints that connect what is connected; ``fps`` holds
    distinct ``fp``."""
    masks = block_masks(blocks, radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = fps.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(signed)])).alias("e")
    ).select(F.xxhash64("e.t", "e.k").alias("key"), "fp")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Keys that one task should not hold: at most 1 / large of the keyed rows, and mostly none.
    crowded = common.persist_table(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > large).select("key", F.lit(True).alias("crowded")), "crowded")
    if not crowded.take(1):
        return keyed.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(lambda b: _link(b, radius, ["key"]), "a long, b long")
    dealt = keyed.join(crowded, "key", "left")
    cells = []
    for p in pivots(3):
        d = F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(p.astype(np.int64))))).cast("long")
        cells.append(F.floor(d / F.lit(radius + 1)))
    corner = [F.transform(F.array(F.lit(0), F.lit(1)), lambda s, c=c: c - s) for c in cells]
    spots = F.flatten(F.transform(corner[0], lambda x: F.flatten(F.transform(corner[1], lambda y: F.transform(corner[2], lambda z: x * 4096 + y * 64 + z)))))
    dealt = dealt.select("key", "fp", F.explode(F.when(F.col("crowded"), spots).otherwise(F.array(F.lit(0).cast("long")))).alias("cell"))
    return (
        dealt.repartition(parts, "key", "cell").sortWithinPartitions("key", "cell")
        .mapInArrow(lambda b: _link(b, radius, ["key", "cell"]), "a long, b long")
    )


def components(rows: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> tuple[DataFrame, DataFrame]:
    """(fp, component, component_id) of the distinct fingerprints in ``rows`` (doc_id,
    fp): the component as its least fingerprint, and the least id of its documents; and
    (fp, n), the rows of each fingerprint."""
    classes = common.persist_table(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "classes")
    edges = common.persist_table(links(classes.select("fp"), blocks, radius), "links")
    found = common.connected_components(edges, "a", "b").select(F.col("node").alias("fp"), "component")
    linked = common.persist_table(classes.join(found, "fp"), "linked")
    sizes = common.persist_table(linked.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n")), "components")
    named = common.join_unique(linked.select("fp", "component"), sizes.select("component", "component_id"), "component", sizes.select("component", "n"))
    alone = classes.join(linked.select("fp"), "fp", "left_anti").select("fp", F.col("fp").alias("component"), F.col("least").alias("component_id"))
    return named.select("fp", "component", "component_id").unionAll(alone), classes.select("fp", "n")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(doc_id, fp, component_id) per row."""
    rows = fingerprints(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), size=size)
    rows = common.persist_table(rows.select("row.doc_id", "fp"), "fingerprints")
    found, counted = components(rows, radius, blocks)
    return common.join_unique(rows, common.persist_table(found.select("fp", "component_id"), "named"), "fp", counted)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``docs`` with one row of each component: that of the least id, and of rows with
    that id any one."""
    rows = fingerprints(docs, text_col, size).withColumn("at", F.monotonically_increasing_id())
    rows = common.persist_table(rows, "fingerprints")  # from here on a row's number is fixed
    short = rows.select(F.col("row")[id_col].cast("long").alias("doc_id"), "fp", "at")
    found, counted = components(short, radius, blocks)
    of = common.join_unique(short, common.persist_table(found.select("fp", "component"), "named"), "fp", counted)
    first = of.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "at")).alias("first")).select("first.at")
    return rows.join(first, "at", "left_semi").select("row.*")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
