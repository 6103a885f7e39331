"""Greedy leader clustering of motifs: in order, each motif that no leader has claimed
becomes a leader and claims every later motif similar to it. Leaders are the
lexicographically first maximal independent set of the similarity graph; every other
motif belongs to its earliest similar leader."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelattice.functions import seq
from sitelattice.plans.tables import persist_table

THRESHOLD = 0.75
#: Edges up to this many are swept on the driver (some 16 MB); more go through rounds of joins.
DRIVER_EDGES = 500_000
#: Places of a part that go into a key; ambiguous letters make up to 4 words a place.
KEY_PLACES = 4


def _words(m: Column, start: Column, width: Column) -> Column:
    """The plain words that ``width`` places of the masks ``m`` may stand for. Two
    stretches share one just if they share a base at each place."""
    bases = lambda p: F.when(p < 16, F.filter(F.array(*[F.lit(1 << i) for i in range(4)]), lambda b: p.bitwiseAND(b) != 0)).otherwise(F.array(p))
    longer = lambda words, p: F.flatten(F.transform(words, lambda w: F.transform(bases(p), lambda b: F.concat(w, F.lit(","), b.cast("string")))))
    return F.aggregate(F.slice(m, start + 1, width), F.array(F.lit("")), longer)


def _keys(m: Column, length: Column, threshold: float, reach: int) -> Column:
    """array<struct<n, d, part, word>>: keys of which similar motifs share one.

    Motifs of n and n + d places are similar only if at most n (1 - threshold - 0.2 d)
    of the n places differ, so of one part more than that, one part is the same in both.
    Its first ``KEY_PLACES`` places are the key, spelled out in plain words.
    """
    def of(n: Column, d: int) -> Column:
        differing = F.floor(n * F.lit(1 - threshold - 0.2 * d) + F.lit(1e-9)).cast("int")
        free = (differing >= n) | F.lit(threshold <= 0)  # nothing needs to be the same
        parts = F.when(free, 1).otherwise(F.greatest(differing, F.lit(0)) + 1)

        def part(i: Column) -> Column:
            first, end = (F.floor(n * x / parts).cast("int") for x in (i, i + 1))
            words = _words(m, first, F.when(free, 0).otherwise(F.least(F.lit(KEY_PLACES), end - first)))
            return F.transform(words, lambda w: F.struct(n.cast("int").alias("n"), F.lit(d).alias("d"), i.alias("part"), w.alias("word")))

        none = F.array().cast("array<struct<n:int,d:int,part:int,word:string>>")
        return F.when((n >= 3) & (differing >= 0), F.flatten(F.transform(F.sequence(F.lit(0), parts - 1), part))).otherwise(none)

    as_shorter, as_longer = [of(length, d) for d in range(reach + 1)], [of(length - d, d) for d in range(1, reach + 1)]
    return F.concat(*as_shorter, *as_longer)


def similar_pairs(motifs: DataFrame, threshold: float = THRESHOLD, text: str = "true_consensus", since: int | None = None) -> DataFrame:
    """(i, j, similarity) of motifs i < j (by ``ord``) that are similar; with ``since``, only
    those whose j is at least that (the others are compared with them, not with each other).

    Motifs under 3 letters are similar to none, nor are those whose lengths differ by
    over 3; a difference of d costs 0.2 d. Candidates meet in an equi-join on the parts
    that they must have in common (``_keys``), and are scored there.
    """
    reach = min(3, int((1 - threshold) / 0.2 + 1e-9)) if threshold > 0 else 3
    m = motifs.where(F.length(text) >= 3).select("ord", F.col(text).alias("s"), seq.masks(F.col(text)).alias("m"))
    keyed = m.withColumn("key", F.explode(_keys(F.col("m"), F.length("s"), threshold, reach)))
    left = keyed.select(F.col("ord").alias("i"), F.col("s").alias("a"), F.col("m").alias("ma"), "key")
    later = keyed if since is None else keyed.where(F.col("ord") >= since)
    right = later.select(F.col("ord").alias("j"), F.col("s").alias("b"), F.col("m").alias("mb"), "key")
    met = left.join(right, "key").where((F.col("i") < F.col("j")) & (F.abs(F.length("a") - F.length("b")) == F.col("key.d")))
    score = seq.similarity(F.col("a"), F.col("b"), F.col("ma"), F.col("mb"))
    return met.select("i", "j", score.alias("similarity")).where(F.col("similarity") >= threshold).distinct()


def _sweep(edges: list[tuple[int, int]]) -> dict[int, int]:
    """member -> leader of the motifs that have edges."""
    later: dict[int, list[int]] = {}
    for i, j in edges:
        later.setdefault(i, []).append(j)
    leader: dict[int, int] = {}
    for i in sorted({x for e in edges for x in e}):
        if i not in leader:
            leader[i] = i
            for j in later.get(i, ()):
                leader.setdefault(j, i)
    return leader


def _rounds(edges: DataFrame) -> DataFrame:
    """(member, leader) by rounds: whoever has no earlier open neighbour leads, and its
    neighbours leave."""
    nodes = edges.select(F.col("i").alias("n")).union(edges.select("j")).distinct().withColumn("state", F.lit(0))
    nodes = persist_table(nodes, "leaders")
    while nodes.where("state = 0").take(1):
        open_ = nodes.where("state = 0").select("n")
        blocked = edges.join(open_.withColumnRenamed("n", "i"), "i", "left_semi").select(F.col("j").alias("n")).distinct()
        leads = open_.join(blocked, "n", "left_anti")
        out = edges.join(leads.withColumnRenamed("n", "i"), "i", "left_semi").select(F.col("j").alias("n")).distinct()
        marked = nodes.join(leads.withColumn("leads", F.lit(True)), "n", "left").join(out.withColumn("out", F.lit(True)), "n", "left")
        nodes = persist_table(marked.select("n", F.when(F.col("state") != 0, F.col("state")).when(F.col("leads"), 1).when(F.col("out"), 2).otherwise(0).alias("state")), "leaders")
    leaders = nodes.where("state = 1").select(F.col("n").alias("i"))
    claimed = edges.join(leaders, "i", "left_semi").join(nodes.where("state = 2").select(F.col("n").alias("j")), "j", "left_semi")
    return claimed.groupBy(F.col("j").alias("ord")).agg(F.min("i").alias("leader")).unionByName(leaders.select(F.col("i").alias("ord"), F.col("i").alias("leader")))


def _mapping(edges: DataFrame, driver_edges: int) -> DataFrame:
    """(ord, leader) of the motifs that have edges."""
    edges = persist_table(edges.select("i", "j"), "edges")  # scored once
    if edges.count() > driver_edges:
        return _rounds(edges)
    found = edges.toArrow()  # two numbers an edge
    pairs = list(_sweep(list(zip(found["i"].to_pylist(), found["j"].to_pylist(), strict=True))).items())
    return edges.sparkSession.createDataFrame(pairs, "ord int, leader int")


def _numbered(placed: DataFrame) -> DataFrame:
    numbers = placed.where("leader = ord").select("leader").withColumn("cluster_no", _dense("leader"))
    return placed.join(numbers, "leader")


def leaders_of(motifs: DataFrame, edges: DataFrame, driver_edges: int = DRIVER_EDGES) -> DataFrame:
    """``motifs`` with ``leader`` (an ord) and ``cluster_no`` (from 1, by leader)."""
    return _numbered(motifs.join(_mapping(edges, driver_edges), "ord", "left").withColumn("leader", F.coalesce("leader", "ord")))


def leaders_by_class(motifs: DataFrame, key: Column, alike: bool, edges_of: Callable[[DataFrame], DataFrame], driver_edges: int = DRIVER_EDGES) -> DataFrame:
    """``leaders_of`` where motifs of one ``key`` are similar to the same others, so only
    the first of each is compared; ``edges_of`` gives the edges of those.

    Motifs of a key that are similar to each other (``alike``) go where their first goes.
    If they are not, they lead if it does: whoever is similar to them and comes between
    belongs to the first.
    """
    keyed = motifs.withColumn("_key", key)
    firsts = keyed.groupBy("_key").agg(F.min("ord").alias("_first"))
    heads = motifs.join(firsts.select(F.col("_first").alias("ord")), "ord", "left_semi")
    found = firsts.join(_mapping(edges_of(heads), driver_edges).withColumnRenamed("ord", "_first"), "_first", "left").withColumn("leader", F.coalesce("leader", "_first"))
    placed = keyed.join(found, "_key")
    if not alike:
        placed = placed.withColumn("leader", F.when(F.col("leader") == F.col("_first"), F.col("ord")).otherwise(F.col("leader")))
    return _numbered(placed.drop("_key", "_first"))


def _dense(column: str) -> Column:
    from pyspark.sql import Window

    return F.row_number().over(Window.orderBy(column))  # one row a cluster


def cluster(motifs: DataFrame, threshold: float = THRESHOLD, text: str = "true_consensus", name: Callable[[Column], Column] | None = None) -> DataFrame:
    """(pattern, leader, consolidated_motif_id, motif_consensus, cluster_size, ...)."""
    # Equal texts are similar to each other, unless they are too short to be compared.
    key = F.coalesce(F.when((F.length(text) >= 3) & F.lit(threshold <= 1), F.concat(F.lit("="), text)), F.col("ord").cast("string"))
    placed = leaders_by_class(motifs, key, True, lambda heads: similar_pairs(heads, threshold, text))
    heads = placed.where("leader = ord").select("leader", F.col(text).alias("motif_consensus"))
    sizes = placed.groupBy("leader").agg(F.count("*").alias("cluster_size"))
    label = name or (lambda n: F.format_string("MOTIF_%03d", n))
    return placed.join(heads, "leader").join(sizes, "leader").withColumn("consolidated_motif_id", label(F.col("cluster_no")))


def cluster_aligned(motifs: DataFrame, threshold: float = 0.8, text: str = "consensus") -> DataFrame:
    """Leader clustering by the shifted, both-strand similarity; ids from 0."""

    def edges(heads: DataFrame) -> DataFrame:
        m = heads.select("ord", F.col(text).alias("s"))
        a, b = m.select(F.col("ord").alias("i"), F.col("s").alias("a")), m.select(F.col("ord").alias("j"), F.col("s").alias("b"))
        # The score is at most shorter / longer: only lengths within that ratio meet.
        reach = a.withColumn("len", F.explode(F.sequence(F.ceil(F.length("a") * threshold).cast("int"), F.floor(F.length("a") / threshold).cast("int"))))
        return reach.join(b.withColumn("len", F.length("b")), "len").where("i < j").where(seq.aligned_similarity(F.col("a"), F.col("b")) >= threshold)

    key = F.coalesce(F.when((F.length(text) > 0) & F.lit(threshold <= 1), F.concat(F.lit("="), text)), F.col("ord").cast("string"))
    return leaders_by_class(motifs, key, True, edges).withColumn("cluster_id", F.format_string("cluster_%03d", F.col("cluster_no") - 1))


def cluster_across_lines(motifs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Leader clustering by width and E-value between different lines; ids from 1."""
    cols = ["ord", "line", "width", "evalue"]

    def edges(heads: DataFrame) -> DataFrame:
        a = heads.select(*[F.col(c).alias(f"a_{c}") for c in cols]).withColumn("w", F.explode(F.sequence(F.col("a_width") - 3, F.col("a_width") + 3)))
        b = heads.select(*[F.col(c).alias(f"b_{c}") for c in cols]).withColumn("w", F.col("b_width"))
        score = seq.width_evalue_similarity(F.col("a_width"), F.col("b_width"), F.col("a_evalue"), F.col("b_evalue"))
        return a.join(b, "w").where("a_ord < b_ord and a_line <> b_line").where(score >= threshold).select(F.col("a_ord").alias("i"), F.col("b_ord").alias("j"))

    # The score hangs on widths and the bands of E-values alone; without a width or a line a motif is similar to none.
    band = F.when(F.col("evalue").isNull(), "none").otherwise(seq.significance(F.col("evalue")))
    key = F.coalesce(F.concat(F.col("width").cast("string"), F.lit("|"), band, F.lit("|"), F.col("line")), F.col("ord").cast("string"))
    return leaders_by_class(motifs, key, False, edges).withColumn("cluster_id", F.format_string("cluster_%d", F.col("cluster_no")))
