"""True consensus of the sequences found for each pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelattice.functions import seq
from sitelattice.plans.tables import persist_table

#: Calls in the order they are tried, each over the shares it adds up.
CALLS = (("A", "a"), ("T", "t"), ("G", "g"), ("C", "c"), ("W", "a+t"), ("S", "g+c"), ("R", "a+g"), ("Y", "c+t"))
CUTOFF = 0.8


def _call(counts: dict[str, Column]) -> Column:
    total = counts["a"] + counts["t"] + counts["g"] + counts["c"]
    out = F.when(total == 0, "N")
    for letter, bases in CALLS:
        parts = [counts[b] / total for b in bases.split("+")]  # doubles, added in this order
        out = out.when((parts[0] if len(parts) == 1 else parts[0] + parts[1]) >= F.lit(CUTOFF), letter)
    return out.otherwise("N")


def pattern_consensus(sites: DataFrame, pattern: str = "pattern", sequence: str = "sequence", order: str = "src_ord", size: Column | None = None, ids: str | None = None) -> DataFrame:
    """(pattern, true_consensus, n_sites, first_ord) per pattern; with ``size``, its least and
    most values too (least_size, most_size). With ``ids``, patterns are what follows the hyphen
    of these ids, each of which is looked at once and not once a site, and come with their ``ids``.

    Sequences of the modal length (the shortest of several) are called place by place.
    Equal sequences are counted before they are taken apart, so the exploded rows follow
    the distinct sequences, not the sites, and no sequence list is held in memory. That
    count is read three times and written once, so the sites are scanned once.
    """
    key = "pattern" if ids is None else "id"
    named = sites.select(F.col(ids or pattern).alias(key), F.col(sequence).alias("sequence"), F.lit(1).cast("long").alias("n"), F.col(order).alias("first_ord"), *([] if size is None else [size.alias("least_size"), size.alias("most_size")]))
    totals = {"n": F.sum, "first_ord": F.min, "least_size": F.min, "most_size": F.max}
    summed = [f(c).alias(c) for c, f in totals.items() if c in named.columns]
    counted = named.groupBy(key, "sequence").agg(*summed)
    seqs = persist_table(counted if ids is None else counted.withColumn("pattern", seq.strip_prefix(F.col("id"))), "sequences")
    lengths = seqs.groupBy("pattern", F.length("sequence").alias("len")).agg(*summed)
    rest = [c for c in totals if c in named.columns and c.endswith("_size")]
    modal = lengths.groupBy("pattern").agg(
        F.sum("n").alias("n_sites"), F.max(F.struct("n", (-F.col("len")).alias("short"))).alias("top"), *[totals[c](c).alias(c) for c in ("first_ord", *rest)]
    ).select("pattern", "n_sites", "first_ord", *rest, (-F.col("top.short")).alias("len"))
    if ids is not None:
        modal, rest = modal.join(seqs.groupBy("pattern").agg(F.collect_set("id").alias("ids")), "pattern"), [*rest, "ids"]
    kept = seqs.select("pattern", "sequence", "n").withColumn("len", F.length("sequence")).join(modal.select("pattern", "len"), ["pattern", "len"])
    bases = kept.select("pattern", "n", F.posexplode(F.split(F.upper("sequence"), "")).alias("pos", "base"))
    counts = bases.groupBy("pattern", "pos").agg(*[F.sum(F.when(F.col("base") == b.upper(), F.col("n")).otherwise(0)).alias(b) for b in "atgc"])
    called = counts.select("pattern", "pos", _call({b: F.col(b) for b in "atgc"}).alias("letter"))
    spelled = called.groupBy("pattern").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "letter"))), lambda x: x["letter"]), "").alias("true_consensus"))
    return modal.join(spelled, "pattern", "left").select("pattern", F.coalesce("true_consensus", F.lit("")).alias("true_consensus"), "n_sites", "first_ord", *rest)


def with_order(motifs: DataFrame, first: str = "first_ord") -> DataFrame:
    """Motifs with ``ord`` from 1 by first appearance."""
    return motifs.withColumn("ord", F.row_number().over(Window.orderBy(first, "pattern")))
