"""Operator 1 - secret scans with a randomness test battery (native).

Base spans come from three patterns (assignments, access keys, hexadecimal runs).
The method adds spans of kind ``random``: unbroken runs of encoding characters that no
base span touches. Each run's encoding is inferred from its characters (hexadecimal,
base 32, else base 64) and tested against it:

* chi-squared uniformity over the encoding's alphabet,
* a runs test of symbols above and below the middle of the alphabet,
* serial correlation of neighbouring symbols,

joined by Fisher's method into one probability that a random string looks like this.
Ordinary names fail uniformity the more clearly the longer they are. How likely an
ordinary name is to look as random as a run does is joined, by Fisher's method again,
from its chi-squared value (by its noncentral law for text), its share of common letters
and its turns between small letters, capitals and digits; shares of names are set on the
safe side, since the first two are not independent, and a test counts the false
discoveries. Hexadecimal needs none of these: text hardly ever stays within sixteen
characters (``HEX_SHARE`` a character at most). These probabilities go through Benjamini-Hochberg control within classes of
length, over all runs of all documents; the step-up runs over a histogram of
probabilities of fixed size, so the driver sees four thresholds and no rows. A run is
reported if it is discovered there and the battery does not reject it as random.

Texts are scanned once and never shuffled; spans and test values are written out
between the two steps. Only built-in expressions are used.

Nulls: a null text is empty. A null doc_id stays null. Repeated rows each give a row.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .native import let, matches, normal_tail, spans, two_sided, untouched

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = (ASSIGN, r"AKIA[A-Z0-9]+", r"[0-9a-f]+")
LEAST = (8, 16, 32)
#: A run may follow "=" (KEY=value); padding is not the sign between a name and its value.
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?:={1,2}(?![A-Za-z0-9+/_-]))?"
FDR = 0.01
NOT_RANDOM = 1e-4
CLASSES = (32, 64, 128)
#: Alphabets in value order, and the excess of ordinary text's chi-squared a character:
#: size * (sum of squared shares) - 1, with 0.066 for letters and 0.1 for digits.
ALPHABETS = {
    "hex": ("0123456789abcdef", 0.0),  # see HEX_SHARE
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 32 * 0.066 - 1),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 64 * 0.066 - 1),
}
BINS = 400
#: Turns from small to capital letters, and between letters and digits; how often ordinary names have them at most.
TURNS = "(?<=[a-z])(?=[A-Z])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"
TURN_SHARE = {64: 0.2, 32: 0.08}
#: Letters that make up over three quarters of ordinary text, and how much of names at least, with their signs
#: and digits; of random strings they are three eighths.
COMMON, COMMON_SHARE = "ETAOINSRHDLU", {64: 0.66, 32: 0.74}
#: Share of hexadecimal characters in ordinary text (a to f are 0.32 of English letters).
HEX_SHARE = 0.4


def base_spans(text: Column, kind: int) -> Column:
    """Spans of a base kind, those too short dropped after matching."""
    # Access keys and hexadecimal are maximal runs: asking for the length in the pattern drops the same matches.
    pattern = (ASSIGN, r"AKIA[A-Z0-9]{12,}", r"[0-9a-f]{32,}")[kind]

    def kept(found: Column) -> Column:
        at = spans(text, pattern, found)
        if kind:
            return at
        values = F.when(F.size(found) > 0, matches(text, pattern, 2)).otherwise(F.array().cast("array<string>"))
        long_enough = F.zip_with(at, values, lambda s, v: F.when(F.length(v) >= LEAST[0], s))
        return F.filter(long_enough, lambda s: s.isNotNull())

    return let(matches(text, pattern), kept)


def encoding_of(s: Column) -> Column:
    return F.when(s.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "hex").when(s.rlike("^[A-Z2-7]+=*$"), "base32").otherwise("base64")


def _tests(s: Column, alphabet: str, excess: float) -> Column:
    """Battery of one string under one alphabet: struct<p_random, p_text>."""
    k, df = len(alphabet), len(alphabet) - 1

    def counted(x: Column) -> Column:
        """Sums over the symbols, in one pass each."""
        v, size = x["v"], F.size(x["v"])
        mean = F.aggregate(v, F.lit(0.0), lambda a, y: a + y) / size
        pairs = F.zip_with(F.slice(v, 1, size - 1), F.slice(v, 2, size - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        return let(
            F.struct(mean.alias("mean"), v.alias("v"), pairs.alias("pairs"), size.cast("double").alias("n"), x["squares"].alias("squares")),
            lambda y: F.struct(
                y["n"].alias("n"),
                (k / y["n"] * y["squares"] - y["n"]).alias("chi"),
                F.size(F.filter(y["v"], lambda c: c >= k // 2)).cast("double").alias("high"),
                F.size(F.filter(y["pairs"], lambda p: (p["a"] >= k // 2) != (p["b"] >= k // 2))).cast("double").alias("changes"),
                F.aggregate(y["v"], F.lit(0.0), lambda a, c: a + (c - y["mean"]) * (c - y["mean"])).alias("variance"),
                F.aggregate(y["pairs"], F.lit(0.0), lambda a, p: a + (p["a"] - y["mean"]) * (p["b"] - y["mean"])).alias("covariance"),
            ),
        )

    def scored(y: Column) -> Column:
        n, high, chi = y["n"], y["high"], y["chi"]
        low = n - high
        z_chi = (F.pow(F.greatest(chi, F.lit(1e-9)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
        expected = 2 * high * low / n
        spread = F.sqrt(F.greatest(expected * (expected - 1) / (n - 1), F.lit(1e-9)))
        z_runs = F.when((high > 0) & (low > 0), (y["changes"] - expected) / spread).otherwise(F.lit(20.0))
        z_serial = F.when(y["variance"] > 0, y["covariance"] / y["variance"] * F.sqrt(n)).otherwise(F.lit(20.0))
        half = F.struct((-(F.log(normal_tail(z_chi)) + F.log(two_sided(z_runs)) + F.log(two_sided(z_serial)))).alias("h"))
        z_text = (chi - (df + n * excess)) / F.sqrt(2 * df + 4 * n * excess)
        joint = lambda x: F.exp(-x["h"]) * (1 + x["h"] + x["h"] * x["h"] / 2)  # noqa: E731  Fisher's method, six degrees of freedom
        fisher = let(half, joint)
        if k == 16:
            return F.struct(fisher.alias("p_random"), F.pow(F.lit(HEX_SHARE), n).alias("p_text"))
        changed = normal_tail((F.regexp_count(s, F.lit(TURNS)) - 0.5 - n * TURN_SHARE[k]) / F.sqrt(n * TURN_SHARE[k] * (1 - TURN_SHARE[k])))
        common = n - F.length(F.translate(F.upper(s), COMMON, ""))
        letters = normal_tail((n * COMMON_SHARE[k] - common - 0.5) / F.sqrt(n * COMMON_SHARE[k] * (1 - COMMON_SHARE[k])))
        h = F.struct((-F.log(normal_tail(-z_text)) - F.log(letters) - F.log(changed)).alias("h"))
        return F.struct(fisher.alias("p_random"), let(h, joint).alias("p_text"))

    symbols = F.transform(F.split(s, ""), lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("double"))
    squares = F.aggregate(F.split(F.lit(alphabet), ""), F.lit(0.0), lambda a, c: a + F.pow((F.length(s) - F.length(F.replace(s, c, F.lit("")))).cast("double"), F.lit(2.0)))
    return let(let(F.struct(symbols.alias("v"), squares.alias("squares")), counted), scored)


def candidates(text: Column) -> Column:
    """Runs with their test values: array<struct<start, stop, band, p_random, p_text>>."""

    def tested(x: Column) -> Column:
        bare = F.translate(F.regexp_replace(x["s"], "=+$", ""), "-_", "+/")

        def scored(b: Column) -> Column:
            kind, body, length = b["kind"], b["body"], F.length(b["body"])
            result = F.when(kind == "hex", _tests(body, *ALPHABETS["hex"])).when(kind == "base32", _tests(body, *ALPHABETS["base32"])).otherwise(_tests(body, *ALPHABETS["base64"]))
            band = F.when(length < CLASSES[0], 0).when(length < CLASSES[1], 1).when(length < CLASSES[2], 2).otherwise(3)
            return let(result, lambda r: F.struct(b["at"]["start"].alias("start"), b["at"]["stop"].alias("stop"), band.alias("band"), r["p_random"].alias("p_random"), r["p_text"].alias("p_text")))

        kind = encoding_of(x["s"])
        body = F.when(kind == "hex", F.lower(bare)).otherwise(bare)
        return let(F.struct(kind.alias("kind"), body.alias("body"), x["at"].alias("at")), scored)

    def placed(found: Column) -> Column:
        both = F.filter(F.arrays_zip(found.alias("s"), spans(text, RUN, found).alias("at")), lambda x: ~x["s"].rlike("^[0-9]+$|^[_=/+-]+$"))
        none = F.array().cast("array<struct<start:bigint,stop:bigint,band:int,p_random:double,p_text:double>>")
        return F.when(F.size(found) > 0, F.transform(both, tested)).otherwise(none)

    return let(matches(text, RUN), placed)


def _bin(p: Column) -> Column:
    return F.least(F.lit(BINS), F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-40)))).cast("int"))


def thresholds(runs: DataFrame, fdr: float = FDR) -> list[int | None]:
    """Per length class the lowest histogram bin (largest probability) that
    Benjamini-Hochberg still accepts; None if it accepts nothing."""
    bins = runs.groupBy("band", _bin(F.col("p_text")).alias("bin")).agg(F.count("*").alias("n"))
    whole = Window.partitionBy("band")  # at most BINS + 1 rows
    stepped = bins.select("band", "bin", F.sum("n").over(whole.orderBy(F.desc("bin"))).alias("below"), F.sum("n").over(whole).alias("m"))
    edge = F.pow(F.lit(10.0), -F.col("bin") / 10)  # the largest probability in the bin
    found = {r["band"]: r["bin"] for r in stepped.where(edge * F.col("m") <= fdr * F.col("below")).groupBy("band").agg(F.min("bin").alias("bin")).collect()}
    return [found.get(b) for b in range(len(CLASSES) + 1)]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """(id, assign, access, hex, random): arrays of spans (start, stop) a row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.select("id", *[base_spans(text, i).alias(k) for i, k in enumerate(KINDS[:3])], candidates(text).alias("runs"))
    rows = common.persist_table(rows, "secret-spans")
    base = F.concat(*KINDS[:3])
    rows = rows.withColumn("free", untouched(F.col("runs"), base))
    limits = thresholds(rows.where(F.size("runs") > 0).select(F.explode("free").alias("r")).select("r.*"), fdr)
    def accepted(r: Column) -> Column:
        out = F.lit(False)
        for band, limit in enumerate(limits):
            if limit is not None:
                out = out | ((r["band"] == band) & (_bin(r["p_text"]) >= limit))
        return out & (r["p_random"] >= NOT_RANDOM)

    kept = F.transform(F.filter("free", accepted), lambda r: F.struct(r["start"].alias("start"), r["stop"].alias("stop")))
    return rows.select(F.col("id").alias(id_col), *KINDS[:3], kept.alias("random"))


def joined(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the kinds' spans by start, then kind."""
    def tagged(kind: int) -> Column:
        return F.transform(kinds[kind], lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["stop"].alias("stop")))

    text = lambda s: F.concat(F.element_at(F.array(*[F.lit(k) for k in kinds]), s["kind"] + 1), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["stop"].cast("string"))
    return F.array_join(F.transform(F.array_sort(F.concat(*[tagged(i) for i in range(len(kinds))])), text), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(common.table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(joined(KINDS[:3]), 256).alias("base_sha256"), joined(KINDS).alias("spans")
    )
