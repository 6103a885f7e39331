"""Operator 4 - benchmark decontamination.

Benchmark items become windows of ``size`` consecutive normalised words (an item
of fewer words is one window). The windows' hashes are broadcast; documents are
scanned, all windows of a batch at a time, and hash hits are verified word by word
before they count.

What is broadcast is a block of the benchmark: at most ``block_windows`` windows and
``block_bytes`` of text, long items being cut into overlapping parts. A window
costs 16 bytes (hash, part, place) in flat arrays beside the text; there are no
dictionaries of words or windows. A benchmark of one block is one scan of the documents.
Of a larger one, one block is alive at a time: the rows are numbered in a written table,
each block is a pass over it that writes the hits only, and the hits are joined back by
row number. Nothing is left out either way.

Nulls: a null text (of a document or an item) has no words. A null item_id hits
words but cannot be listed. Repeated item_ids are listed once; repeated documents
each give a row. A document without words is clean. Empty tables give no rows, or no
hits. Other columns are not read unless they are named in ``keep``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SIZE = 13
BLOCK_WINDOWS = 1 << 22
BLOCK_BYTES = 32 << 20
PART = 4096
CHUNK_WORDS = 1 << 17
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 bytes: all that is not ASCII belongs to words
_BASE = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[bytes]:
    """Normalised words: A-Z in lower case; digits, letters and all beyond ASCII."""
    return _WORD.findall((text or "").encode().lower())


def rolling(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` ids."""
    h = np.zeros(max(0, len(ids) - size + 1), np.uint64)
    for j in range(size):
        h = h * np.uint64(_BASE) + ids[j : j + len(h)]
    return h


def hashed(found: list[bytes]) -> np.ndarray:
    """One number a word, never 0."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)) | np.uint64(1)


class Windows:
    """The windows of one benchmark block, in flat arrays sorted by hash."""

    #: Verified windows whose items are remembered.
    most = 1 << 14

    def __init__(self, items: list[tuple[int | None, str | None]], size: int = SIZE):
        self.size, self.ids, self.texts = size, [], []
        parts = []
        for item, text in items:
            h = hashed(words(text))
            if len(h):
                n = min(size, len(h))
                rolled = rolling(h, n)
                parts.append((np.full(len(rolled), n, np.uint8), rolled, np.full(len(rolled), len(self.ids), np.uint32), np.arange(len(rolled), dtype=np.uint32)))
                self.ids.append(item)
                self.texts.append(text)
        #: Per number of words: hashes in order, and the part and the place of each.
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        if parts:
            sizes, hashes, owner, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            for n in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == n)
                at = at[np.argsort(hashes[at], kind="stable")]
                self.tables[n] = (hashes[at], owner[at], place[at])
        self.verified: dict[tuple[bytes, ...], frozenset] = {}
        self.words: dict[int, list[bytes]] = {}

    def _words(self, part: int) -> list[bytes]:
        if part not in self.words:
            if len(self.words) >= 64:
                self.words.clear()
            self.words[part] = words(self.texts[part])
        return self.words[part]

    def items_of(self, window: tuple[bytes, ...], table, low: int, high: int) -> frozenset:
        """Items that hold the window, among the entries of its hash; empty if it only
        has the hash."""
        if (found := self.verified.get(window)) is None:
            if len(self.verified) >= self.most:
                self.verified.clear()
            n, (_, owner, place) = len(window), table
            own = ((int(owner[k]), int(place[k])) for k in range(low, high))
            found = self.verified[window] = frozenset(p for p, at in own if tuple(self._words(p)[at : at + n]) == window)
        return found

    def scan(self, documents: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set]]:
        """Per document: merged spans of hit words and the items hit."""
        found: list[tuple[list, set]] = [([], set()) for _ in documents]
        lengths = np.array([len(d) for d in documents], np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths)))
        h = hashed([w for d in documents for w in d])
        hits: dict[int, list[tuple[int, int]]] = {}
        for n, table in self.tables.items():
            rolled = rolling(h, n)
            if not len(rolled):
                continue
            i = np.minimum(np.searchsorted(table[0], rolled), len(table[0]) - 1)
            near = np.flatnonzero(table[0][i] == rolled)
            k = np.searchsorted(starts, near, side="right") - 1
            inside = near + n <= starts[k + 1]
            near, k = near[inside], k[inside]
            high = np.searchsorted(table[0], rolled[near], side="right")
            for p, d, low, end in zip((near - starts[k]).tolist(), k.tolist(), i[near].tolist(), high.tolist(), strict=True):
                if owners := self.items_of(tuple(documents[d][p : p + n]), table, low, end):
                    hits.setdefault(d, []).append((p, p + n))
                    found[d][1].update(self.ids[o] for o in owners)
        for d, spans in hits.items():
            found[d][0].extend(merge(spans))
        return found


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, in order."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def item_parts(item, text: str | None, size: int, most: int = PART):
    """The item's text, or overlapping parts of it with at most ``most`` windows each;
    together they have its windows and no others."""
    raw = (text or "").encode()
    marks = [m.span() for m in _WORD.finditer(raw.lower())] if len(raw) > most else []
    if len(marks) < size + most:
        yield item, text
        return
    for first in range(0, len(marks) - size + 1, most):
        last = min(len(marks), first + size - 1 + most)
        yield item, raw[marks[first][0] : marks[last - 1][1]].decode()


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "item_id", text_col: str = "text", size: int = SIZE, block_windows: int = BLOCK_WINDOWS):
    """Lists of items (or parts of items) within the bounds, one at a time. The rows are
    streamed to the driver a partition at a time; partitions are cut to the bound first."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long") + 64), F.lit(0))).first()[0]
    if total > block_bytes:
        rows = rows.repartition(-(-total // block_bytes) * 2)  # round robin: equal rows do not meet
    block, held, windows = [], 0, 0
    for r in rows.toLocalIterator():
        for item, text in item_parts(r["item"], r["text"], size, min(block_windows, PART)):
            size_, most = len((text or "").encode()), len(text or "") // 2 + 1  # a window a word, a word two characters at least
            if block and (held + size_ > block_bytes or windows + most > block_windows):
                yield block
                block, held, windows = [], 0, 0
            block.append((item, text))
            held, windows = held + size_, windows + most
    if block:
        yield block


FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
    T.StructField("hit_items", T.ArrayType(T.LongType())),
]
_ARROW = {"n_words": pa.int64(), "hit_spans": pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), "hit_items": pa.list_(pa.int64())}


def _chunks(batch, text_at: int):
    """(first row, word lists) of parts of a batch of bounded size."""
    held, n, first = [], 0, 0
    for i, t in enumerate(batch.column(text_at)):
        held.append(words(t.as_py()))
        n += len(held[-1])
        if n >= CHUNK_WORDS:
            yield first, held
            held, n, first = [], 0, i + 1
    if held:
        yield first, held


def _pass(rows: DataFrame, shared, hits_only: bool) -> DataFrame:
    """``rows`` (last column ``_text``) without the text, with FOUND; with ``hits_only``
    only rows that are hit."""

    def run(batches):
        windows = shared.value
        for b in batches:
            n = b.num_columns - 1
            for at, documents in _chunks(b, n):
                part = b.slice(at, len(documents))
                found = windows.scan(documents)
                counts = pa.array([len(d) for d in documents], pa.int64())
                if hits_only:
                    hit = [i for i, f in enumerate(found) if f[0]]
                    part, found, counts = part.take(pa.array(hit, pa.int64())), [found[i] for i in hit], counts.take(pa.array(hit, pa.int64()))
                spans = pa.array([[{"start": s, "stop": e} for s, e in f[0]] for f in found], _ARROW["hit_spans"])
                items = pa.array([sorted(x for x in f[1] if x is not None) for f in found], _ARROW["hit_items"])
                yield pa.RecordBatch.from_arrays([*part.columns[:n], counts, spans, items], [*b.schema.names[:n], *_ARROW])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *FOUND]))


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text", size: int = SIZE, block_bytes: int = BLOCK_BYTES, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``keep`` of ``docs``, with n_words, hit_spans (of words, merged, half-open)
    and hit_items of every row."""
    spark = docs.sparkSession
    common.bounded_batches(spark)
    carried = list(dict.fromkeys(keep))
    reserved = {f.name for f in FOUND} | {"_text", "_row"}
    hidden = {c: f"_kept_{c}" if c in reserved else c for c in carried}  # columns may bear our names
    rows = docs.select(*[F.col(c).alias(hidden[c]) for c in carried], F.col(text_col).alias("_text"))
    blocks = benchmark_blocks(benchmark, block_bytes, size=size, block_windows=block_windows)
    block, following = next(blocks, []), next(blocks, None)
    share = lambda items: spark.sparkContext.broadcast(Windows(items, size))
    if following is None:
        return _pass(rows, share(block), False)
    rows = common.persist_table(rows.select(*rows.columns[:-1], F.monotonically_increasing_id().alias("_row"), "_text"), "decontaminate-rows")
    path = common.new_path(spark, "decontaminate-hits")
    while block is not None:
        shared = share(block)
        _pass(rows.select("_row", "_text"), shared, True).drop("n_words").write.mode("append").parquet(path)
        shared.destroy()
        block, following = following, next(blocks, None)
    hits = spark.read.parquet(path)
    found = hits.groupBy("_row").agg(F.flatten(F.collect_list("hit_spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_items")))).alias("items"))

    def merged(batches):  # a row's spans of all blocks
        for b in batches:
            spans = [[{"start": s, "stop": e} for s, e in merge([(x["start"], x["stop"]) for x in row])] for row in b.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(spans, _ARROW["hit_spans"]), b.column("items")], ["_row", "spans", "items"])

    found = found.mapInArrow(merged, T.StructType([T.StructField("_row", T.LongType()), T.StructField("spans", FOUND[1].dataType), T.StructField("items", FOUND[2].dataType)]))
    none = share([])
    empty = [F.array().cast(f.dataType) for f in FOUND[1:]]
    counted = _pass(rows, none, False).drop("hit_spans", "hit_items").join(found, "_row", "left")
    return counted.select(
        *[F.col(hidden[c]) for c in carried], "n_words", F.coalesce("spans", empty[0]).alias("hit_spans"), F.coalesce("items", empty[1]).alias("hit_items")
    )


def n_hit():
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])


def is_contaminated():
    """Any hit, and a twentieth of the words at least."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` without its contaminated rows, columns unchanged."""
    found = scan(docs, benchmark, docs.columns, text_col, size)
    reserved = {f.name for f in FOUND} | {"_text", "_row"}
    return found.where(~is_contaminated()).select(*[F.col(f"_kept_{c}" if c in reserved else c).alias(c) for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` with the hit words, and what stands between hit words of a span, cut
    out of the text."""
    found = scan(docs, benchmark, docs.columns, text_col, size)
    reserved = {f.name for f in FOUND} | {"_text", "_row"}
    named = {c: f"_kept_{c}" if c in reserved else c for c in docs.columns}
    at = named[text_col]

    def run(batches):
        for b in batches:
            i, texts = b.schema.get_field_index(at), []
            for text, spans in zip(b.column(at).to_pylist(), b.column("hit_spans").to_pylist(), strict=True):
                if spans:
                    raw = text.encode()
                    marks = [m.span() for m in _WORD.finditer(raw.lower())]
                    kept, end = [], 0
                    for s in spans:
                        kept.append(raw[end : marks[s["start"]][0]])
                        end = marks[s["stop"] - 1][1]
                    text = b"".join([*kept, raw[end:]]).decode()
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if k == i else b.column(k) for k in range(len(named))]
            yield pa.RecordBatch.from_arrays(columns, list(named.values()))

    schema = T.StructType([T.StructField(named[f.name], f.dataType) for f in docs.schema.fields])
    return found.mapInArrow(run, schema).toDF(*docs.columns)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"), ["doc_id"])
    listed = F.array_sort(F.transform("hit_items", lambda x: x.cast("string")))
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"), is_contaminated().alias("contaminated"),
    )


OP4_SQL = """
with d as (select row_number() over () as r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
b as (select item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
bw as (select distinct item_id, least(13, len(w)) as n,
         array_to_string(w[p:p + least(13, len(w)) - 1], ' ') as win
       from (select item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) as p from b where len(w) > 0) t),
sizes as (select distinct n from bw),
dw as (select r, n, p, array_to_string(w[p:p + n - 1], ' ') as win
       from (select r, n, w, unnest(range(1, len(w) - n + 2)) as p from d, sizes) t),
hit as (select dw.r, dw.p, dw.n, bw.item_id from dw join bw on dw.n = bw.n and dw.win = bw.win),
words as (select r, count(distinct q) as n_hit from (select r, unnest(range(p, p + n)) as q from hit) t group by r),
items as (select r, count(distinct item_id) as n_items,
            string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hit group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join words using (r) left join items using (r)
"""
