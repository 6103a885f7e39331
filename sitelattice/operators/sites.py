"""Overlap merging, ranking and summaries of motif hits."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import cluster as clustering
from . import consensus as consensuses
from sitelattice.functions import seq
from sitelattice.plans.tables import persist_table

GROUP = ["gene_id", "line", "strand", "consolidated_motif_id"]
#: Closed intervals that the overlap merge holds in one list.
CHUNK = 64
#: Least and most letters of a motif's hits; the least is 0 if any of them lacks whole values.
EXTENT = ["least_size", "most_size"]
COLUMNS = [
    "consolidated_motif_id", "original_motif_id", "motif_consensus", "original_streme_consensus", "line", "gene_id", "start_pos", "end_pos",
    "strand", "score", "sequence", "relative_position", "total_motifs_in_gene", "relative_position_fraction", "cluster_size", "merged_count", "length",
]


def assign_clusters(sites: DataFrame, threshold: float = clustering.THRESHOLD) -> DataFrame:
    """Sites with their consolidated motif, and the sizes its hits have (``EXTENT``)."""
    return _placed(sites, motif_clusters(sites, threshold))


def _placed(sites: DataFrame, found: DataFrame) -> DataFrame:
    """Motifs are looked up by id, so no pattern is cut out of a hit's. The motif table is
    small beside the sites; whether it is broadcast is left to its size. What else it tells
    of a motif is joined to the merged sites, which are fewer."""
    return sites.join(found.select(F.explode("ids").alias("original_motif_id"), "consolidated_motif_id", *EXTENT), "original_motif_id")


def motif_clusters(sites: DataFrame, threshold: float = clustering.THRESHOLD) -> DataFrame:
    """The motif table with its clusters; It is written out
    (it is read several times, and deriving it scans all sites)."""
    size = F.when(_whole(), F.col("end_pos") - F.col("start_pos") + 1).otherwise(0)
    motifs = persist_table(consensuses.with_order(consensuses.pattern_consensus(sites, size=size, ids="original_motif_id")), "motifs")
    own = Window.partitionBy("leader")  # a row a motif
    clusters = clustering.cluster(motifs, threshold).withColumns({c: f(c).over(own) for c, f in zip(EXTENT, (F.min, F.max), strict=True)})
    return persist_table(clusters, "clusters")


def _whole() -> Column:
    """The rules of the merge that save work need whole values."""
    return F.coalesce((F.col("end_pos") >= F.col("start_pos")) & F.col("score").isNotNull() & ~F.isnan("score") & F.col("sequence").isNotNull(), F.lit(False))


def _starts(sites: DataFrame, threshold: float, keep: str, order: str) -> DataFrame:
    """(group, start_pos, head, reach, top, best, n, whole): hits of one start summed up, where
    the sizes of all their motif's hits tell that they join each other; other hits as they are.

    The first of them opens an interval or joins one, which then holds its whole length. A
    later one either lies within, or shares with it at least that length, so ``least_size`` of
    the at most ``most_size`` letters of the shorter.
    """
    rest = [c for c in sites.columns if c not in (*GROUP, *EXTENT, "start_pos", "end_pos", "score", "sequence", order)]
    first = -F.length("sequence") if keep == "longest" else -F.col("score")
    hit = [order, "end_pos", "score", "sequence"]
    head, best = F.struct(*hit, F.struct(*rest).alias("rest")), F.struct(first.alias("first"), "start_pos", *hit)
    if threshold > 1 or not set(EXTENT) <= set(sites.columns):
        return sites.select(*GROUP, "start_pos", head.alias("head"), F.col("end_pos").alias("reach"), F.col("score").alias("top"), best.alias("best"), F.lit(1).alias("n"), _whole().alias("whole"))
    least, most = (F.col(c) for c in EXTENT)
    alike = F.coalesce((least > 0) & (least / most >= F.lit(float(threshold))), F.lit(False))
    marked = sites.withColumn("_alone", F.when(~alike, F.monotonically_increasing_id()))
    # Led by a number, so that the sort before the aggregate seldom compares texts.
    marked = marked.withColumn("_place", F.xxhash64(*GROUP, "start_pos", "_alone"))
    return marked.groupBy("_place", *GROUP, "start_pos", "_alone").agg(
        F.min(head).alias("head"), F.max("end_pos").alias("reach"), F.max("score").alias("top"), F.min(best).alias("best"), F.count("*").cast("int").alias("n"), F.min(_whole()).alias("whole")
    ).drop("_place", "_alone")


def _runs(sites: DataFrame, threshold: float, keep: str, order: str) -> DataFrame:
    """(group, _island, _run, head, reach, top, best, n): each hit that is sure to join what
    is open, whatever that is, summed up with the hit it follows."""
    starts = _starts(sites, threshold, keep, order)
    by = ["start_pos", *[f"head.{c}" for c in (order, "end_pos", "score", "sequence")]]
    w = Window.partitionBy(*GROUP).orderBy(*by)
    upto, start, end = w.rowsBetween(Window.unboundedPreceding, 0), F.col("start_pos"), F.col("head.end_pos")
    before = F.max("reach").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (start > before) if threshold > 0 else before.isNull(), 1).otherwise(0)
    # From the first hit without whole values on, all of its group are folded.
    own = F.try_divide(F.greatest(F.lit(0), F.least(before, end) - start + 1), end - start + 1)
    joins = F.when(before.isNull() | (F.min("whole").over(upto) == F.lit(False)) | F.lit(threshold > 1), 0).otherwise((own >= F.lit(float(threshold))).cast("int"))
    cut = starts.withColumns({"_opens": opens, "_alone": 1 - joins}).withColumns({"_island": F.sum("_opens").over(upto), "_run": F.sum("_alone").over(upto)})
    return cut.groupBy(*GROUP, "_island", "_run").agg(
        F.min(F.struct(*by, "head.rest")).alias("head"), F.max("reach").alias("reach"), F.max("top").alias("top"), F.min("best").alias("best"), F.sum("n").cast("int").alias("n")
    )


def merge_overlaps(sites: DataFrame, threshold: float = 0.5, keep: str = "longest", order: str = "src_ord") -> DataFrame:
    """Fold overlapping hits of a motif in a gene, line and strand, in order of start.

    A hit joins the last interval if their overlap is at least ``threshold`` of the
    shorter of the two. A merged interval spans both, has the higher score and the sum of
    counts; it keeps its first hit's other fields, and of the sequences the longer
    (``keep="longest"``, the first of equals) or the better-scored (``"best_score"``).

    A hit that starts beyond every earlier end cannot overlap (for thresholds over 0), so
    a window with a running maximum cuts each group into islands first. That maximum is also
    where the open interval ends, so a hit that shares ``threshold`` of its own length with
    it joins, whichever interval is open. Hits of one start are summed up before that where
    the sizes of their motif's hits allow it (``EXTENT``). Such hits are summed up with the hit they follow
    by an aggregate; only the others, whose joining hangs on where the interval began, are
    folded, an island's as one array, on the window's partitioning. The fold holds the open
    interval, the last ``CHUNK`` closed ones, and lists of ``CHUNK`` before, so a step costs
    the same however many there are; an island's must fit in a task's memory
    (``merge_overlaps_streamed`` is for those that do not).
    """
    runs = _runs(sites, threshold, keep, order)
    rest = [c for c in sites.columns if c not in (*GROUP, *EXTENT, "start_pos", "end_pos", "score", "sequence", order)]
    hit = F.struct("head.start_pos", f"head.{order}", "head.end_pos", "reach", F.col("top").alias("score"), "best.sequence", "head.rest", "n")

    def fold(acc: Column, h: Column) -> Column:
        last = acc["last"]
        size = lambda x: x["end_pos"] - x["start_pos"] + 1
        overlap = F.greatest(F.lit(0), F.least(last["end_pos"], h["end_pos"]) - F.greatest(last["start_pos"], h["start_pos"]) + 1)
        shorter = F.least(size(last), size(h))
        share = F.when(shorter > 0, overlap / shorter).otherwise(F.lit(0.0))
        start, end = F.least(last["start_pos"], h["start_pos"]), F.greatest(last["end_pos"], h["reach"])
        better = F.length(h["sequence"]) > F.length(last["sequence"]) if keep == "longest" else h["score"] > last["score"]
        joined = F.struct(
            start.alias("start_pos"), last[order].alias(order), end.alias("end_pos"), F.greatest(last["score"], h["score"]).alias("score"),
            F.when(better, h["sequence"]).otherwise(last["sequence"]).alias("sequence"), last["rest"].alias("rest"),
            (last["merged_count"] + h["n"]).alias("merged_count"), (end - start + 1).alias("length"),
        )
        full = F.size(acc["few"]) >= CHUNK
        closed = F.struct(
            _opened(h, order).alias("last"), F.when(full, F.array(last)).otherwise(F.array_append(acc["few"], last)).alias("few"),
            F.when(full, F.array_append(acc["many"], acc["few"])).otherwise(acc["many"]).alias("many"),
        )
        return F.when(share >= F.lit(float(threshold)), F.struct(joined.alias("last"), acc["few"], acc["many"])).otherwise(closed)

    head = _opened(F.element_at("hits", 1), order)
    none = F.filter(F.array(head), lambda x: F.lit(False))  # an empty list of intervals
    zero = F.struct(head.alias("last"), none.alias("few"), F.filter(F.array(none), lambda x: F.lit(False)).alias("many"))
    several = F.aggregate(F.slice("hits", 2, F.size("hits")), zero, fold, lambda a: F.concat(F.flatten(a["many"]), a["few"], F.array(a["last"])))
    folded = (
        runs.groupBy(*GROUP, "_island").agg(F.array_sort(F.collect_list(hit)).alias("hits"))
        .select(*GROUP, F.when(F.size("hits") == 1, F.array(head)).otherwise(several).alias("merged"))
        .select(*GROUP, F.inline("merged"))
    )
    return folded.select(*GROUP, "start_pos", "end_pos", "score", "sequence", order, *[F.col("rest")[c].alias(c) for c in rest], "merged_count", "length")


def merge_overlaps_streamed(sites: DataFrame, threshold: float = 0.5, keep: str = "longest", order: str = "src_ord") -> DataFrame:
    """``merge_overlaps`` for hits that touch by the million: the same rows, in memory that
    does not grow with an island.

    Hits are dealt by group and sorted in their partition (which spills), and a task reads
    them in batches with one open interval, which it carries over the ends of batches.
    What follows by gene and line is shuffled once more, which the arrays are not.
    """
    sites = sites.drop(*EXTENT)
    sorted_ = sites.repartition(*GROUP).sortWithinPartitions(*GROUP, "start_pos", order, "end_pos", "score", "sequence")
    changed = ["start_pos", "end_pos", "score", "sequence", "merged_count", "length"]
    longest = keep == "longest"

    def joins(last: list, start, end) -> bool:
        if None in (last[0], last[1], start, end):
            return False
        shorter = min(last[1] - last[0], end - start) + 1
        overlap = max(0, min(last[1], end) - max(last[0], start) + 1)
        return (overlap / shorter if shorter > 0 else 0.0) >= threshold

    def join(last: list, start, end, score, text) -> None:
        if longest:
            better = text is not None and last[3] is not None and len(text) > len(last[3])
        else:
            better = score is not None and last[2] is not None and score > last[2]
        last[0], last[1] = min(last[0], start), max(last[1], end)
        last[2] = score if last[2] is None else last[2] if score is None else max(last[2], score)
        last[3] = text if better else last[3]
        last[4] += 1
        last[5] = last[1] - last[0] + 1

    def done(rows: pa.Table, firsts: list[int], intervals: list[list]) -> pa.RecordBatch:
        kept = rows.take(pa.array(firsts, pa.int64()))
        for name, values in zip(changed, zip(*intervals, strict=True), strict=True):
            if name in rows.column_names:
                kept = kept.set_column(kept.column_names.index(name), name, pa.array(values, rows.schema.field(name).type))
            else:
                kept = kept.append_column(name, pa.array(values, pa.int32()))
        return kept.combine_chunks().to_batches()[0]

    def run(batches):
        open_row, last, group = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            skip = 0 if open_row is None else 1
            if skip:
                rows = pa.concat_tables([open_row, rows])
            firsts, intervals = ([0], [last]) if skip else ([], [])
            keys = zip(*[batch.column(c).to_pylist() for c in GROUP], strict=True)
            hits = zip(keys, *[batch.column(c).to_pylist() for c in changed[:4]], strict=True)
            for i, (key, start, end, score, text) in enumerate(hits, skip):
                if key == group and joins(last, start, end):
                    join(last, start, end, score, text)
                else:
                    last, group = [start, end, score, text, 1, None if text is None else len(text)], key
                    firsts.append(i)
                    intervals.append(last)
            open_row = rows.slice(firsts[-1], 1).take(pa.array([0]))  # a copy, so that its batch can go
            if len(firsts) > 1:
                yield done(rows, firsts[:-1], intervals[:-1])
        if open_row is not None:
            yield done(open_row, [0], [last])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted_.schema.fields) + ", merged_count int, length int"
    rest = [c for c in sites.columns if c not in (*GROUP, "start_pos", "end_pos", "score", "sequence", order)]
    return sorted_.mapInArrow(run, shape).select(*GROUP, "start_pos", "end_pos", "score", "sequence", order, *rest, "merged_count", "length")


def _opened(h: Column, order: str) -> Column:
    length = F.when(h["n"] == 1, F.length(h["sequence"])).otherwise(h["reach"] - h["start_pos"] + 1)
    return F.struct(
        h["start_pos"].alias("start_pos"), h[order].alias(order), h["reach"].alias("end_pos"), h["score"].alias("score"), h["sequence"].alias("sequence"),
        h["rest"].alias("rest"), h["n"].alias("merged_count"), length.alias("length"),
    )


def rank_in_gene(sites: DataFrame, order: str = "src_ord") -> DataFrame:
    """Rank of each hit in its gene and line by start, the group's size, and their ratio."""
    w = Window.partitionBy("gene_id", "line")
    by = w.orderBy("start_pos", "original_motif_id", "strand", "end_pos", order)
    return (
        sites.withColumn("relative_position", F.row_number().over(by))
        .withColumn("total_motifs_in_gene", F.count("*").over(w).cast("int"))
        .withColumn("relative_position_fraction", F.col("relative_position") / F.col("total_motifs_in_gene"))
    )


def consolidate(sites: DataFrame, threshold: float = clustering.THRESHOLD, merge: bool = True, overlap: float = 0.5, streamed: bool = False) -> DataFrame:
    """Raw hits to the consolidated site table (17 columns, and ``src_ord``).

    The hits are dealt by gene and line once; the merge and the rank both reuse that.
    ``streamed`` merges in constant memory, for one more shuffle of what is left.
    """
    found = motif_clusters(sites, threshold)
    placed = _placed(sites, found)
    placed = placed if merge and streamed else placed.repartition("gene_id", "line")
    if merge:
        placed = (merge_overlaps_streamed if streamed else merge_overlaps)(placed, overlap)
    else:
        placed = placed.withColumn("merged_count", F.lit(None).cast("int")).withColumn("length", F.length("sequence"))
    about = found.select(F.col("pattern").alias("original_streme_consensus"), "motif_consensus", F.col("cluster_size").cast("int").alias("cluster_size"))
    ranked = rank_in_gene(placed).withColumn("original_streme_consensus", seq.strip_prefix(F.col("original_motif_id")))
    return ranked.join(about, "original_streme_consensus").select(*COLUMNS, "src_ord")


def global_summary(sites: DataFrame) -> DataFrame:
    return sites.agg(
        F.count("*").alias("n_sites"), F.countDistinct("consolidated_motif_id").alias("n_motifs"), F.countDistinct("line").alias("n_lines"), F.countDistinct("gene_id").alias("n_genes")
    )


def line_summary(sites: DataFrame) -> DataFrame:
    return sites.groupBy("line").agg(
        F.countDistinct("gene_id").alias("n_genes"), F.countDistinct("consolidated_motif_id").alias("n_motifs"), F.count("sequence").alias("n_sites")
    )


def top_motifs(sites: DataFrame, n: int = 20) -> DataFrame:
    """The motifs with most sites, and each one's first consensus."""
    return (
        sites.groupBy("consolidated_motif_id").agg(F.count("*").alias("n_sites"), F.min("motif_consensus").alias("motif_consensus"))
        .orderBy(F.desc("n_sites"), "consolidated_motif_id").limit(n)
    )


def supported(sites: DataFrame, least: int = 10, key: str = "consolidated_motif_id") -> DataFrame:
    """Motifs with at least ``least`` sites."""
    return sites.groupBy(key).agg(F.count("*").alias("n_sites"), F.min("src_ord").alias("first_ord")).where(F.col("n_sites") >= least)
