"""Column expressions over motif sequences. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The bases each IUPAC letter stands for, as bits A=1 C=2 G=4 T=8.
MASKS = {"A": 1, "C": 2, "G": 4, "T": 8, "R": 5, "Y": 10, "S": 6, "W": 9, "K": 12, "M": 3, "B": 14, "D": 13, "H": 11, "V": 7, "N": 15}
LETTERS = "".join(MASKS)
COMPLEMENT = ("ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN")


def strip_prefix(motif_id: Column) -> Column:
    """The pattern: what follows the first hyphen, or the whole id."""
    return F.substr(motif_id, F.instr(motif_id, "-") + 1)


def gc_content(s: Column) -> Column:
    n = F.length(s)
    return F.when(n > 0, F.length(F.regexp_replace(F.upper(s), "[^GC]", "")) / n).otherwise(F.lit(0.0))


def base_fraction(s: Column, base: str) -> Column:
    """Share of one letter, in its own case."""
    n = F.length(s)
    return F.when(n > 0, (n - F.length(F.replace(s, F.lit(base)))) / n).otherwise(F.lit(0.0))


def reverse_complement(s: Column) -> Column:
    return F.reverse(F.translate(s, *COMPLEMENT))


def masks(s: Column) -> Column:
    """array<int> of base bits. A letter outside the alphabet only meets itself: it
    becomes a number beyond the four bits."""
    return F.transform(F.split(F.upper(s), ""), lambda c: F.when(F.instr(F.lit(LETTERS), c) > 0, F.element_at(F.array(*[F.lit(m) for m in MASKS.values()]), F.greatest(F.instr(F.lit(LETTERS), c), F.lit(1)))).otherwise(F.ascii(c) * 16))


def _meets(a: Column, b: Column) -> Column:
    return (a == b) | ((a < 16) & (b < 16) & (a.bitwiseAND(b) != 0))


def compatible(a: Column, b: Column, shift: int = 0) -> Column:
    """Places i of the shorter length where a[i] and b[i + shift] share a base; ``a``
    and ``b`` are masks."""
    n = F.least(F.size(a), F.size(b))
    places = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i + shift >= 0) & (i < F.size(a)) & (i + shift < F.size(b)))
    return F.size(F.filter(places, lambda i: _meets(F.get(a, i), F.get(b, i + shift))))


def similarity(a: Column, b: Column, a_masks: Column | None = None, b_masks: Column | None = None) -> Column:
    """Compatible places over the shorter length, less 0.2 for each letter of
    difference in length; 0 at least, and 0 for an empty sequence."""
    ma, mb = masks(a) if a_masks is None else a_masks, masks(b) if b_masks is None else b_masks
    n = F.least(F.length(a), F.length(b))
    score = compatible(ma, mb) / n - F.abs(F.length(a) - F.length(b)) * F.lit(0.2)
    return F.when(n > 0, F.greatest(F.lit(0.0), score)).otherwise(F.lit(0.0))


def comparable(a: Column, b: Column) -> Column:
    """Cheap test before scoring: lengths differ by 3 at most, neither is under 3."""
    return (F.abs(F.length(a) - F.length(b)) <= 3) & (F.length(a) >= 3) & (F.length(b) >= 3)


def aligned_similarity(a: Column, b: Column) -> Column:
    """Best of the direct comparison and of shifts by up to 3 that still compare 70 %
    of the shorter, against b and its reverse complement. Argument order matters."""
    ma = masks(a)
    low, high = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    options = []
    for other in (b, reverse_complement(b)):
        mb = masks(other)
        options.append(compatible(ma, mb) / high)
        for shift in range(-3, 4):
            compared = _compared(low, F.length(b), shift)
            options.append(F.when((compared > 0) & (compared >= low * F.lit(0.7)), compatible(ma, mb, shift) / compared * (low / high)).otherwise(F.lit(0.0)))
    return F.when(low > 0, F.greatest(F.lit(0.0), *options)).otherwise(F.lit(0.0))


def _compared(low: Column, length_b: Column, shift: int) -> Column:
    """How many i below ``low`` have i + shift inside b."""
    first, last = max(0, -shift), F.least(low - 1, length_b - 1 - shift)
    return F.greatest(F.lit(0), last - first + 1)


def width_evalue_similarity(w1: Column, w2: Column, e1: Column, e2: Column) -> Column:
    """Ladder over width and E-value: 0 for widths over 3 apart, else by how
    significant both are; 0.3 without E-values, 0.1 without widths."""
    both = F.greatest(e1, e2)
    return (
        F.when(w1.isNull() | w2.isNull(), F.lit(0.1))
        .when(F.abs(w1 - w2) > 3, F.lit(0.0))
        .when(e1.isNull() | e2.isNull(), F.lit(0.3))
        .when(both < 0.001, F.lit(0.8))
        .when(both < 0.01, F.lit(0.6))
        .when(both < 0.05, F.lit(0.4))
        .otherwise(F.lit(0.2))
    )


def positional_similarity(s: Column, consensus: Column) -> Column:
    """For equal lengths: 1 a place that agrees or has an N, 0.5 where either letter is
    ambiguous; over the length. 0 for other lengths or nothing."""
    plain = lambda c: c.isin("A", "C", "G", "T")
    score = F.zip_with(
        F.split(F.upper(s), ""), F.split(F.upper(consensus), ""),
        lambda a, b: F.when((a == b) | (a == "N") | (b == "N"), 1.0).when(~plain(a) | ~plain(b), 0.5).otherwise(0.0),
    )
    same = (F.length(s) == F.length(consensus)) & (F.length(s) > 0)
    return F.when(same, F.aggregate(score, F.lit(0.0), lambda t, v: t + v) / F.length(s)).otherwise(F.lit(0.0))


def mutation_share(s: Column, consensus: Column) -> Column:
    """Share of places where both have a plain base and it differs; null unless the
    lengths are equal and not 0."""
    plain = lambda c: c.isin("A", "C", "G", "T")
    off = F.zip_with(F.split(F.upper(s), ""), F.split(F.upper(consensus), ""), lambda a, b: (a != b) & plain(a) & plain(b))
    return F.when((F.length(s) == F.length(consensus)) & (F.length(s) > 0), F.size(F.filter(off, lambda x: x)) / F.length(s))


#: From this length on, letters that are frequent in the second text begin no block.
LONG_TEXT = 200


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _agreeing(a: Column, b: Column) -> Column:
    """How many letters the beginnings of two texts share."""
    n = F.least(F.length(a), F.length(b))
    longer = lambda k, p: F.when((k == p - 1) & (F.substring(a, p, F.lit(1)) == F.substring(b, p, F.lit(1))), p).otherwise(k)
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), n), F.lit(0), longer)).otherwise(F.lit(0))


def _longest_block(a: Column, b: Column, frequent: Column) -> Column:
    """struct<n, i, j>: the longest text that ``a`` and ``b`` share and where it begins (from 1)
    in each; of equally long ones the first in ``a``, and there the first in ``b``.

    What ends at a place of ``a`` is at most a letter longer than the longest that ends
    before, so one look for one text a place finds it. ``frequent`` letters begin no block
    but lengthen one to both sides.
    """
    hidden = lambda s, mark: F.when(frequent == "", s).otherwise(F.call_function("translate", s, frequent, F.repeat(F.lit(mark), F.length(frequent))))

    def longest(t: Column) -> Column:
        def step(best: Column, p: Column) -> Column:
            longer = F.call_function("instr", t["b"], F.substring(t["a"], p - best["n"], best["n"] + 1)) > 0
            return F.when(longer, F.struct((best["n"] + 1).alias("n"), (p - best["n"]).alias("i"))).otherwise(best)

        return F.aggregate(F.sequence(F.lit(1), F.length(a)), F.struct(F.lit(0).alias("n"), F.lit(1).alias("i")), step)

    def placed(t: Column) -> Column:
        at = lambda x: F.when(x["n"] > 0, F.call_function("instr", t["b"], F.substring(t["a"], x["i"], x["n"]))).otherwise(F.lit(1))
        return _bind(longest(t), lambda x: F.struct(x["n"].alias("n"), x["i"].alias("i"), at(x).alias("j")))

    def lengthened(x: Column) -> Column:
        before = _agreeing(F.reverse(F.substring(a, F.lit(1), x["i"] - 1)), F.reverse(F.substring(b, F.lit(1), x["j"] - 1)))
        after = _agreeing(F.substring(a, x["i"] + x["n"], F.length(a)), F.substring(b, x["j"] + x["n"], F.length(b)))
        more = _bind(before, lambda k: F.struct((x["n"] + k + after).alias("n"), (x["i"] - k).alias("i"), (x["j"] - k).alias("j")))
        return F.when(frequent == "", x).otherwise(more)

    return _bind(_bind(F.struct(hidden(a, "\ue001").alias("a"), hidden(b, "\ue002").alias("b")), placed), lengthened)


def matching_ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp: twice the letters in shared blocks over all letters, capitals and
    small letters alike; 0 if either text is empty or null.

    The longest shared block splits both texts in two, and each pair of rests is split
    again; the rests wait in a list. From ``LONG_TEXT`` letters on, those that make up over
    a hundredth of ``b`` begin no block, as is usual for this measure.
    """
    a, b = F.upper(a), F.upper(b)
    often = lambda c: (F.length(b) - F.length(F.replace(b, c))) > F.floor(F.length(b) / 100) + 1
    frequent = F.when(F.length(b) >= LONG_TEXT, F.array_join(F.filter(F.array_distinct(F.split(b, "")), often), "")).otherwise(F.lit(""))

    def split(acc: Column, t: Column, common: Column) -> Column:
        def rests(x: Column) -> Column:
            left = F.struct(F.substring(t["a"], F.lit(1), x["i"] - 1).alias("a"), F.substring(t["b"], F.lit(1), x["j"] - 1).alias("b"))
            right = F.struct(F.substring(t["a"], x["i"] + x["n"], F.length(t["a"])).alias("a"), F.substring(t["b"], x["j"] + x["n"], F.length(t["b"])).alias("b"))
            open_ = F.filter(F.array(left, right), lambda r: (x["n"] > 0) & (F.length(r["a"]) > 0) & (F.length(r["b"]) > 0))
            waiting = F.concat(F.slice(acc["rests"], F.lit(1), F.size(acc["rests"]) - 1), open_)
            return F.struct(waiting.alias("rests"), (acc["n"] + x["n"]).alias("n"))

        return _bind(_longest_block(t["a"], t["b"], common), rests)

    def shared(common: Column) -> Column:
        # A block of one letter or more opens two rests at most.
        turns = F.sequence(F.lit(0), 2 * F.least(F.length(a), F.length(b)))
        start = F.struct(F.array(F.struct(a.alias("a"), b.alias("b"))).alias("rests"), F.lit(0).alias("n"))
        turn = lambda acc, _: F.when(F.size(acc["rests"]) == 0, acc).otherwise(_bind(F.element_at(acc["rests"], -1), lambda t: split(acc, t, common)))
        return F.aggregate(turns, start, turn, lambda acc: acc["n"])

    return F.when((F.length(a) > 0) & (F.length(b) > 0), 2.0 * _bind(frequent, shared) / (F.length(a) + F.length(b))).otherwise(F.lit(0.0))


def parse_evalue(s: Column) -> Column:
    return F.regexp_extract(s, r"([0-9.]+(?:[eE][-+]?[0-9]+)?)", 1).try_cast("double")


def significance(e: Column, combined: bool = False) -> Column:
    """H, M, L or N at 0.001, 0.01, 0.05; the combined form calls all the rest L."""
    rest = F.lit("L") if combined else F.when(e < 0.05, "L").otherwise("N")
    return F.when(e < 0.001, "H").when(e < 0.01, "M").otherwise(rest)


def alike(a: Column, b: Column) -> Column:
    """GC contents under 0.2 apart and lengths within a fifth. Two empty texts are alike, as in SQL; null if a text is missing."""
    low, high = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    return F.when(a.isNotNull() & b.isNotNull(), (F.abs(gc_content(a) - gc_content(b)) < F.lit(0.2)) & ((high == 0) | (low / high > F.lit(0.8))))


def decay(position: Column) -> Column:
    return F.exp(-position / F.lit(1000.0))
