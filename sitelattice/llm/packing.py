"""Operator 7 - best-fit packing by linear grouping.

Piece lengths are whole numbers up to the capacity, so a histogram of lengths
(at most ``capacity`` rows whatever the input) decides the packing:

1. large lengths are split into groups of equal cardinality and rounded up to the
   longest of their group (linear grouping);
2. the few-size problem is solved over bin configurations: a linear programme by
   column generation, priced by a knapsack, rounded down;
3. actual lengths take the configurations' places, in runs of equal bins, the last
   place of a bin by best fit;
4. what rounding left over, and the small lengths, go best-fit into the room left.

Bins of equal content are one run with a multiplicity, so driver memory depends on
the capacity and the number of groups, not on the number of documents. The plan is
a list of placements (length, ranks, sequences); each piece finds its own by its
length and its rank among the pieces of that length. Ranks are counted in
buckets and offset by the bucket totals, so neither a length nor a row that repeats is
one task's work.

Nulls: a null text is empty, that is its end token alone. A null doc_id stays
null. Repeated rows are packed each. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, encoding

CAPACITY = 1024
END = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full pieces, but for the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every document: ids, then the end token, cut."""

    def run(batches):
        encoder = encoding.encoder(tokenizer)
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                ids = np.append(encoder.ids(text), np.uint32(end)).astype("<u4", copy=False)
                for k, (s, n) in enumerate(cut(len(ids), capacity)):
                    row.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[s : s + n].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    common.bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


# ---- the plan, from the histogram alone ----


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Whole numbers of bins per configuration (counts per size) that cover no more
    than ``demand``: the cutting-stock relaxation by column generation, rounded down."""
    k, w = len(sizes), np.array(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    d = np.array(demand, dtype=float)
    for _ in range(60 * k + 200):
        x = np.linalg.solve(basis, d)
        price = np.linalg.solve(basis.T, np.ones(k))
        best = np.zeros(capacity + 1)
        took = np.full(capacity + 1, -1)
        for j in np.argsort(-price / w):  # unbounded knapsack, one size at a time
            s = sizes[j]
            if price[j] <= 0:
                continue
            for c in range(s, capacity + 1, s):  # a block of s capacities depends on the one below only
                hi = min(c + s, capacity + 1)
                better = best[c - s : hi - s] + price[j] > best[c:hi] + 1e-12
                best[c:hi][better] = best[c - s : hi - s][better] + price[j]
                took[c:hi][better] = j
        if best[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(k), capacity
        while room > 0:
            if took[room] >= 0:
                column[took[room]] += 1
                room -= sizes[took[room]]
            else:
                room -= 1
        step = np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = column
    x = np.linalg.solve(basis, d)
    return [([int(v) for v in basis[:, j]], int(np.floor(x[j] + 1e-9))) for j in range(k) if x[j] >= 1 - 1e-9]


@dataclass
class Run:
    """``n`` bins of equal content: ids base, base + 1, ..."""

    base: int
    n: int
    used: int


class Plan:
    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY, groups: int = 192, small: int | None = None):
        self.capacity = capacity
        self.left = dict(sorted(histogram.items(), reverse=True))  # length -> not yet placed
        self.taken = dict.fromkeys(self.left, 0)  # length -> ranks given out
        self.placements: list[tuple[int, int, int, int, int, int]] = []  # length, rank, pieces, base, per bin, offset
        self.bins = 0
        self.room: dict[int, list[Run]] = {}  # room left -> runs
        self.rooms: list[int] = []
        small = capacity // 8 if small is None else small
        self._grouped([n for n in self.left if n > small], groups)
        self._best_fit()

    def _place(self, length: int, n: int, base: int, per_bin: int, offset: int) -> None:
        self.placements.append((length, self.taken[length], n, base, per_bin, offset))
        self.taken[length] += n
        self.left[length] -= n

    def _free(self, run: Run) -> None:
        room = self.capacity - run.used
        if room > 0 and run.n > 0:
            if room not in self.room:
                self.room[room] = []
                insort(self.rooms, room)
            self.room[room].append(run)

    def _grouped(self, large: list[int], groups: int) -> None:
        total = sum(self.left[n] for n in large)
        if not total:
            return
        each, members, sizes, demand, seen = -(-total // groups), [], [], [], 0
        for n in large:  # a length is not split between groups, so a group holds about ``each``
            if not members or seen // each != (seen + self.left[n] - 1) // each and seen % each == 0 or demand[-1] >= each:
                members.append([])
                sizes.append(n)
                demand.append(0)
            members[-1].append(n)
            demand[-1] += self.left[n]
            seen += self.left[n]
        for config, count in configurations(sizes, demand, self.capacity):
            runs = [Run(self.bins, count, 0)]
            self.bins += count
            places = [g for g, times in enumerate(config) for _ in range(times)]
            for k, g in enumerate(places):
                # The last place takes the longest piece that fits: one of its group always does.
                runs = [r for run in runs for r in self._fill(run, members[g] if k + 1 < len(places) else self._fitting(run))]
            for r in runs:
                self._free(r)

    def _fill(self, run: Run, lengths: list[int]) -> list[Run]:
        """One place of each bin of ``run`` for the group's longest unplaced lengths."""
        out, base, n = [], run.base, run.n
        for length in lengths:
            t = min(n, self.left[length])
            if t:
                self._place(length, t, base, 1, run.used)
                out.append(Run(base, t, run.used + length))
                base, n = base + t, n - t
            if not n:
                break
        if n:  # the group has run out
            out.append(Run(base, n, run.used))
        return out

    def _fitting(self, run: Run) -> list[int]:
        return [n for n in self.left if n <= self.capacity - run.used]

    def _best_fit(self) -> None:
        for length in self.left:
            while self.left[length]:
                i = bisect_left(self.rooms, length)
                if i == len(self.rooms):
                    per = self.capacity // length
                    n = max(1, self.left[length] // per)
                    run = Run(self.bins, n, 0)
                    self.bins += n
                else:
                    room = self.rooms[i]
                    run = self.room[room].pop()
                    if not self.room[room]:
                        del self.room[room], self.rooms[i]
                per = min((self.capacity - run.used) // length, self.left[length])
                n = min(run.n, self.left[length] // per)
                self._place(length, n * per, run.base, per, run.used)
                self._free(Run(run.base, n, run.used + per * length))
                self._free(Run(run.base + n, run.n - n, run.used))


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = 192) -> DataFrame:
    """``pieces`` (at least the columns of PIECES) with ``sequence_id`` and ``offset``.

    The pieces are written out with a bucket each, drawn from their place in the input
    beside their content, so rows that repeat are dealt out as well."""
    spark = pieces.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    place = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(buckets))
    pieces = common.persist_table(pieces.select(*names, place.cast("int").alias("bucket")), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = Plan(histogram, capacity, groups)
    # At most capacity lengths, each with the runs it was placed in: no function of the number of rows.
    places = sorted(plan.placements)
    keys = np.array([p[0] << 44 | p[1] for p in places], dtype=np.int64)
    base, per, offset = (np.array([p[i] for p in places], dtype=np.int64) for i in (3, 4, 5))
    shared = spark.sparkContext.broadcast((keys, base, per, offset))

    totals = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(inside) - 1).join(totals, ["length", "bucket"]).select(*names, (F.col("first") + F.col("rank")).alias("rank"))

    def place(batches):
        keys, base, per, offset = shared.value
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            i = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            k = rank - (keys[i] & ((1 << 44) - 1)) if len(i) else rank
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(base[i] + k // per[i], pa.int64()), pa.array(offset[i] + k % per[i] * length, pa.int64())],
                [*names, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return pack(tokenized_pieces(docs, tokenizer, capacity, end, id_col, text_col), capacity)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(common.table(spark, sf_dir, "documents"), encoding.default_path())
