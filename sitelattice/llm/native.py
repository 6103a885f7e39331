"""Column expressions shared by the native operators: matches with positions, and
normal probabilities."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches of a Java pattern."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def between(text: Column, pattern: str) -> Column:
    """What stands before, between and after the matches: one piece more than there are."""
    return F.split(text, pattern, -1)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often and in whatever
    lambda the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, join=lambda a, b: a + b) -> Column:
    """What ``join``, an associative function, makes of each element and all before it.

    Each pass joins what stands 1, 2, 4, ... places before, so n elements take n log n
    steps; a fold that appends to its list would take n squared.
    """

    def passed(a: Column, k: Column) -> Column:
        far = F.pow(F.lit(2), k).cast("int")
        return F.transform(a, lambda x, i: F.when(i >= far, join(F.get(a, i - far), x)).otherwise(x))

    passes = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values).cast("double"))).cast("int") - 1)
    return F.when(F.size(values) > 1, F.aggregate(passes, values, passed)).otherwise(values)


SPANS = "array<struct<start:bigint,stop:bigint>>"


def spans(text: Column, pattern: str, found: Column) -> Column:
    """Where the matches ``found`` of a pattern stand: array<struct<start, stop>> in
    code points. Texts without a match are not split."""

    def placed(x: Column) -> Column:
        ends = let(F.zip_with(F.slice(x["gaps"], 1, F.size(x["sizes"])), x["sizes"], lambda a, b: a + b), lambda v: running(v))
        return F.zip_with(ends, x["sizes"], lambda e, n: F.struct((e - n).alias("start"), e.alias("stop")))

    lengths = lambda texts: F.transform(texts, lambda t: F.length(t).cast("bigint"))
    both = F.struct(lengths(between(text, pattern)).alias("gaps"), lengths(found).alias("sizes"))
    return F.when(F.size(found) > 0, let(both, placed)).otherwise(F.array().cast(SPANS))


def untouched(runs: Column, others: Column) -> Column:
    """Those of ``runs`` (structs with start and stop) that none of the spans ``others``
    overlaps: the largest end among the spans that begin before a run's end is no more
    than its start."""

    def apart(x: Column) -> Column:
        nothing = F.lit(None).cast("bigint")
        marks = F.concat(
            F.transform(x["runs"], lambda r, i: F.struct(r["stop"].alias("at"), F.lit(0).alias("kind"), nothing.alias("end"), i.cast("bigint").alias("run"))),
            F.transform(x["others"], lambda o: F.struct(o["start"].alias("at"), F.lit(1).alias("kind"), o["stop"].alias("end"), nothing.alias("run"))),
        )

        def judged(m: Column) -> Column:
            reached = let(F.transform(m, lambda e: e["end"]), lambda ends: running(ends, F.greatest))
            free = lambda e, top: F.when((e["kind"] == 0) & (F.coalesce(top, F.lit(0)) <= F.get(x["runs"], e["run"].cast("int"))["start"]), e["run"])
            kept = F.filter(F.zip_with(m, reached, free), lambda i: i.isNotNull())
            return F.transform(kept, lambda i: F.get(x["runs"], i.cast("int")))

        return let(F.array_sort(marks), judged)

    both = F.struct(runs.alias("runs"), others.alias("others"))
    return F.when((F.size(runs) > 0) & (F.size(others) > 0), let(both, apart)).otherwise(runs)


def normal_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal (Abramowitz and Stegun 26.2.17)."""
    a = F.abs(z)
    t = 1 / (1 + F.lit(0.2316419) * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    q = F.greatest(F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly, F.lit(1e-300))
    return F.when(z >= 0, q).otherwise(1 - q)


def two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * normal_tail(F.abs(z)))
