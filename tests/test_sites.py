"""Scalar functions, folds, clustering and models against plain versions."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitelattice.functions import seq
from sitelattice.operators import cluster, consensus, encode, features, models, quality, sites
from sitelattice.sources import sinks

BASES = {k: {b for b, bit in zip("ACGT", (1, 2, 4, 8), strict=True) if m & bit} for k, m in seq.MASKS.items()}


def plain_similarity(a, b):
    n = min(len(a), len(b))
    if not n:
        return 0.0
    hits = sum(bool(BASES.get(x, {x}) & BASES.get(y, {y})) for x, y in zip(a, b, strict=False))
    return max(0.0, hits / n - 0.2 * abs(len(a) - len(b)))


def test_similarity(spark):
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("ACGTRYSWKMBDHVNX") for _ in range(rng.randint(0, 9)))
    pairs = [(word(), word()) for _ in range(400)] + [("ACGT", "ACGT"), ("ACGT", "ACGTA"), ("N", "A"), ("", "A"), ("X", "X"), ("X", "N")]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", seq.similarity(F.col("a"), F.col("b")).alias("s"), seq.similarity(F.col("b"), F.col("a")).alias("t"), seq.comparable(F.col("a"), F.col("b")).alias("c")).collect()
    for r in rows:
        assert r["s"] == r["t"] == plain_similarity(r["a"], r["b"])
        assert r["c"] == (abs(len(r["a"]) - len(r["b"])) <= 3 and min(len(r["a"]), len(r["b"])) >= 3)


def test_scalars(spark):
    row = spark.createDataFrame([("1-AAAARA", "ACGT", "ACGTRYKMBDHVN", "E= 1.5e-05", "GgCc")], "i string, j string, s string, e string, g string").select(
        seq.strip_prefix(F.col("i")), seq.strip_prefix(F.col("j")), seq.reverse_complement(F.col("s")), seq.parse_evalue(F.col("e")), seq.gc_content(F.col("g")), seq.base_fraction(F.col("g"), "G"), seq.gc_content(F.lit("")),
        seq.significance(F.lit(0.0005)), seq.significance(F.lit(0.005)), seq.significance(F.lit(0.03)), seq.significance(F.lit(0.5)), seq.significance(F.lit(0.5), combined=True),
        seq.width_evalue_similarity(F.lit(8), F.lit(12), F.lit(0.1), F.lit(0.1)), seq.width_evalue_similarity(F.lit(8), F.lit(9), F.lit(0.0001), F.lit(0.0005)), seq.width_evalue_similarity(F.lit(8), F.lit(9), F.lit(None).cast("double"), F.lit(0.1)),
        seq.positional_similarity(F.lit("ACGR"), F.lit("ACTN")), seq.mutation_share(F.lit("ACGR"), F.lit("ATTG")), seq.aligned_similarity(F.lit("ACGTT"), F.lit("AACGT")),
    ).first()
    assert list(row) == ["AAAARA", "ACGT", "NBDHVKMRYACGT", 1.5e-05, 1.0, 0.25, 0.0, "H", "M", "L", "N", "L", 0.0, 0.8, 0.3, 0.75, 0.5, 1.0]


def fold(hits, threshold=0.5):
    out = []
    for start, end, score, text in hits:
        if out:
            m = out[-1]
            overlap = max(0, min(m[1], end) - max(m[0], start) + 1)
            short = min(m[1] - m[0] + 1, end - start + 1)
            if (overlap / short if short > 0 else 0.0) >= threshold:
                out[-1] = [min(m[0], start), max(m[1], end), max(m[2], score), text if len(text) > len(m[3]) else m[3], m[4] + 1]
                continue
        out.append([start, end, score, text, 1])
    return out


@pytest.mark.parametrize("threshold", [0.5, 0.9, 0.0])
def test_merge(spark, threshold):
    rng = random.Random(3)
    rows, want = [], []
    for g in range(60):
        hits = []
        for k in range(rng.randint(1, 25)):
            start, n = rng.randint(1, 90), rng.randint(1, 14)
            hits.append((start, f"{k:03d}", start + n - 1, float(rng.randint(1, 9)), "A" * n))
        rows += [(f"g{g}", "l", "+", "M", s, o, e, v, t, "id") for s, o, e, v, t in hits]
        want += [(f"g{g}", *m) for m in fold([(s, e, v, t) for s, o, e, v, t in sorted(hits)], threshold)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "gene_id string, line string, strand string, consolidated_motif_id string, start_pos int, src_ord string, end_pos int, score double, sequence string, original_motif_id string")
    found = sites.merge_overlaps(table, threshold).select("gene_id", "start_pos", "end_pos", "score", "sequence", "merged_count").collect()
    assert sorted(map(tuple, found)) == sorted(want)
    assert sum(r["merged_count"] for r in found) == len(rows)
    best = sites.merge_overlaps(table, threshold, keep="best_score")
    assert best.count() == len(want)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("10000", "3", "1"):  # intervals are carried over the ends of batches
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            for keep in ("longest", "best_score"):
                a, b = sites.merge_overlaps(table, threshold, keep), sites.merge_overlaps_streamed(table, threshold, keep)
                assert a.columns == b.columns and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sites.merge_overlaps_streamed(table.where("start_pos < 0")).count() == 0


HIT = "gene_id string, line string, strand string, consolidated_motif_id string, start_pos int, src_ord string, end_pos int, score double, sequence string, original_motif_id string"


def test_merge_sums_up_dense_hits(spark):
    """Hits that are sure to join are summed up before the fold, so it grows with the places, not the hits."""
    rng = random.Random(11)
    hits = [(rng.randint(1, 300), f"{k:05d}", n, float(rng.randint(1, 50)), "".join(rng.choice("ACGT") for _ in range(n))) for k, n in enumerate(rng.choices((3, 8, 11, 40), k=6000))]
    rows = [("g", "l", "+", "M", s, o, s + n - 1, v, t, o) for s, o, n, v, t in hits]
    table = spark.createDataFrame(rows, HIT)
    for threshold in (0.5, 0.95, 1.0):
        want = fold([(s, s + n - 1, v, t) for s, o, n, v, t in sorted(hits)], threshold)
        found = sites.merge_overlaps(table, threshold).select("start_pos", "end_pos", "score", "sequence", "merged_count").collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, want))
        assert sites._runs(table, threshold, "longest", "src_ord").count() <= 300


def test_merge_odd_hits(spark):
    """Reversed hits, hits of no length, missing sequences and scores: as the streamed merge has them."""
    rng = random.Random(12)
    rows = []
    for g in range(40):
        for k in range(25):
            start, n = rng.randint(1, 60), rng.randint(1, 14)
            odd = rng.random()
            end = start - rng.randint(0, 3) if odd < 0.03 else start + n - 1
            score = None if 0.03 < odd < 0.06 else float("inf") if odd > 0.98 else float(rng.randint(1, 9))
            rows.append((f"g{g}", "l", "+", "M", start, f"{k:03d}", end, score, None if 0.06 < odd < 0.09 else "A" * n, "id"))
    table = spark.createDataFrame(rows, HIT)
    for threshold in (0.0, 0.5, 1.0, 1.5):
        for keep in ("longest", "best_score"):
            a, b = sites.merge_overlaps(table, threshold, keep), sites.merge_overlaps_streamed(table, threshold, keep)
            assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


def test_merge_sums_up_hits_of_one_start_first(spark):
    """With the sizes of a motif's hits known, hits of one start are one row before the windows;
    motifs whose sizes differ too much, or that lack whole values, stay as they are."""
    rng, rows = random.Random(13), []
    for motif, sizes in (("M", (6, 8, 11)), ("W", (3, 8, 40)), ("O", (6, 8, 11))):
        for k in range(1500):
            start, n = rng.randint(1, 120), rng.choice(sizes)
            score = None if motif == "O" and rng.random() < 0.05 else float(rng.randint(1, 9))
            rows.append(("g", "l", "+", motif, start, f"{k:05d}", start + n - 1, score, "".join(rng.choice("ACGT") for _ in range(n)), "id", *{"M": (6, 11), "W": (3, 40), "O": (0, 11)}[motif]))
    table = spark.createDataFrame(rows, HIT + ", least_size int, most_size int")
    for keep in ("longest", "best_score"):
        a, b = sites.merge_overlaps(table, 0.5, keep), sites.merge_overlaps_streamed(table, 0.5, keep)
        assert a.columns == b.columns and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    left = dict(map(tuple, sites._starts(table, 0.5, "longest", "src_ord").groupBy("consolidated_motif_id").count().collect()))
    assert left["M"] <= 120 and left["W"] == left["O"] == 1500


def test_clusters_tell_the_sizes_of_their_hits(spark):
    cols = "original_motif_id string, sequence string, src_ord string, start_pos int, end_pos int, score double"
    rows = [("1-ACGTACGT", "ACGTACGT", "1", 5, 12, 1.0), ("7-ACGTACGT", "ACGTACGTA", "2", 5, 13, 1.0), ("TTTTTTTT", "TTTTTTTT", "3", 5, 12, None), ("TTTTTTTT", "TTTTTTTT", "4", 5, 12, 1.0)]
    table = spark.createDataFrame(rows, cols).withColumn("pattern", seq.strip_prefix(F.col("original_motif_id")))
    found = {r["pattern"]: (sorted(r["ids"]), r["least_size"], r["most_size"]) for r in sites.motif_clusters(table).collect()}
    assert found == {"ACGTACGT": (["1-ACGTACGT", "7-ACGTACGT"], 8, 9), "TTTTTTTT": (["TTTTTTTT"], 0, 8)}


def test_consensus_scans_the_hits_once(spark):
    table = spark.createDataFrame([("p", "A", "1")], "pattern string, sequence string, src_ord string")
    plan = consensus.pattern_consensus(table)._jdf.queryExecution().toString()
    assert "sequences-" in plan and "ExistingRDD" not in plan and "LogicalRDD" not in plan


def test_merge_documented_example(spark):
    rows = [("g", "l", "+", "M", s, str(i), e, 1.0, "A" * 15, "x") for i, (s, e) in enumerate([(786, 800), (787, 801), (788, 802), (789, 803), (791, 805)])]
    table = spark.createDataFrame(rows, "gene_id string, line string, strand string, consolidated_motif_id string, start_pos int, src_ord string, end_pos int, score double, sequence string, original_motif_id string")
    r = sites.merge_overlaps(table).first()
    assert (r["start_pos"], r["end_pos"], r["merged_count"], r["length"]) == (786, 805, 5, 20)


def test_consensus(spark):
    rows = [("p", "A")] + [("p", "T")] * 7 + [("p", "C")] * 2 + [("q", "A")] + [("q", "T")] * 7 + [("q", "G")] * 2 + [("r", "AC"), ("r", "ACG"), ("s", "X")]
    table = spark.createDataFrame([(p, s, f"{i:03d}") for i, (p, s) in enumerate(rows)], "pattern string, sequence string, src_ord string")
    found = {r["pattern"]: r["true_consensus"] for r in consensus.pattern_consensus(table).collect()}
    assert found == {"p": "Y", "q": "N", "r": "AC", "s": "N"}


def test_leaders_by_sweep_and_by_rounds(spark):
    rng = random.Random(7)
    for _ in range(3):
        n = 40
        edges = sorted({tuple(sorted(rng.sample(range(1, n + 1), 2))) for _ in range(90)})
        leaders, of = [], {}
        for i in range(1, n + 1):
            near = [j for j in leaders if (j, i) in edges]
            of[i] = min(near) if near else i
            if not near:
                leaders.append(i)
        motifs = spark.range(1, n + 1).select(F.col("id").cast("int").alias("ord"))
        table = spark.createDataFrame(edges, "i int, j int")
        for limit in (10_000, 0):
            found = {r["ord"]: (r["leader"], r["cluster_no"]) for r in cluster.leaders_of(motifs, table, limit).collect()}
            assert found == {i: (v, leaders.index(v) + 1) for i, v in of.items()}


def greedy(n, similar):
    """Leader of each of ``n`` things in order."""
    leaders, of = [], {}
    for j in range(n):
        of[j] = next((i for i in leaders if similar(i, j)), j)
        if of[j] == j:
            leaders.append(j)
    return of


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.6, 0.75, 0.9, 1.0, 1.1])
def test_similar_pairs_and_clusters_plain(spark, threshold):
    rng = random.Random(11)
    core = ["".join(rng.choice("ACGT") for _ in range(rng.randint(5, 14))) for _ in range(8)]
    near = lambda w: "".join(rng.choice("ACGTRYSWKMBDHVNX") if rng.random() < 0.2 else c for c in w) + rng.choice(["", "", "A", "AC", "TTT"])
    words = [near(rng.choice(core)) for _ in range(70)] + core * 3 + ["", "A", "AC", "AC", "ACG", "NNNNNNNN", "NNNNNNNN", "acgtacgt"]
    rng.shuffle(words)
    table = spark.createDataFrame(list(enumerate(words)), "ord int, true_consensus string")

    def similar(i, j):
        a, b = words[i], words[j]
        return min(len(a), len(b)) >= 3 and abs(len(a) - len(b)) <= 3 and plain_similarity(a.upper(), b.upper()) >= threshold

    found = {(r["i"], r["j"]): r["similarity"] for r in cluster.similar_pairs(table, threshold).collect()}
    assert found == {(i, j): plain_similarity(words[i].upper(), words[j].upper()) for j in range(len(words)) for i in range(j) if similar(i, j)}
    placed = {r["ord"]: r["leader"] for r in cluster.cluster(table, threshold).collect()}
    assert placed == greedy(len(words), similar)


def test_clusters_by_class_plain(spark):
    """One motif a class is compared; the result is that of comparing all."""
    rng = random.Random(12)
    words = ["".join(rng.choice("ACGT") for _ in range(rng.randint(4, 7))) for _ in range(25)] * 2 + ["", ""]
    rng.shuffle(words)
    table = spark.createDataFrame(list(enumerate(words)), "ord int, consensus string")
    a, b = table.select(F.col("ord").alias("i"), F.col("consensus").alias("a")), table.select(F.col("ord").alias("j"), F.col("consensus").alias("b"))
    near = {(r["i"], r["j"]) for r in a.join(b, F.col("i") < F.col("j")).where(seq.aligned_similarity(F.col("a"), F.col("b")) >= 0.8).collect()}
    assert {r["ord"]: r["leader"] for r in cluster.cluster_aligned(table, 0.8).collect()} == greedy(len(words), lambda i, j: (i, j) in near)

    rows = [(i, rng.choice(["x", "y", "z", None]), rng.choice([6, 8, 13, 20, 25, None]), rng.choice([0.0001, 0.0005, 0.005, 0.02, 0.3, float("nan"), None])) for i in range(150)]
    table = spark.createDataFrame(rows, "ord int, line string, width int, evalue double")

    def band(i, j):
        if None in rows[i][1:3] + rows[j][1:3] or rows[i][1] == rows[j][1] or abs(rows[i][2] - rows[j][2]) > 3:
            return 0.0
        e = [rows[i][3], rows[j][3]]
        return 0.3 if None in e else next((v for top, v in ((0.001, 0.8), (0.01, 0.6), (0.05, 0.4)) if all(x < top for x in e)), 0.2)

    for threshold in (0.2, 0.3, 0.5, 0.8):
        placed = {r["ord"]: r["leader"] for r in cluster.cluster_across_lines(table, threshold).collect()}
        assert placed == greedy(len(rows), lambda i, j: band(i, j) >= threshold)


def test_order_of_rows_does_not_matter(spark):
    from sitelattice.plans import views

    raw = views.sites_raw(spark, "/root/testdata/sf0.001").limit(800)
    rows = raw.collect()
    random.Random(1).shuffle(rows)
    a = sites.consolidate(spark.createDataFrame(rows, raw.schema)).collect()
    b = sites.consolidate(spark.createDataFrame(sorted(rows), raw.schema)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_empty_tables(spark):
    schema = "gene_id string, line string, original_motif_id string, start_pos int, end_pos int, strand string, score double, sequence string, src_ord string"
    table = sites.consolidate(spark.createDataFrame([], schema))
    assert table.count() == 0
    assert quality.verdict(quality.cluster_profile(table)).first()["verdict"] is None
    assert features.position_features(table).count() == features.crossline_layer(table).count() == 0


def test_densities(spark):
    rows = [("g", "l", "M", p) for p in (0, 299, 300, 699, 700, 1000)]
    table = spark.createDataFrame(rows, "gene_id string, line string, consolidated_motif_id string, start_pos int")
    r = features.position_features(table).first()
    assert np.allclose([r["density_distal"], r["density_core"], r["density_proximal"]], [2 / 3, 2 / 4, 2 / 3])
    spaced = spark.createDataFrame([("g", "l", "M", p) for p in (100, 200, 300)] + [("h", "l", "M", p) for p in (100, 200)], table.schema)
    assert {r["spacing_regularity"] for r in features.position_features(spaced).collect()} == {0.0}


def test_matcher_similarity(spark):
    rows = [("g", "l", "M", "ACGTAC", "ACGGAC"), ("g", "l", "M", "", "ACG"), ("g", "l", "M", "TTTT", "ATTA")]
    r = features.matcher_similarity(spark.createDataFrame(rows, "gene_id string, line string, consolidated_motif_id string, sequence string, motif_consensus string")).first()
    want = [SequenceMatcher(None, a, b).ratio() if a and b else 0.0 for *_, a, b in rows]
    assert "Python" not in features.matcher_similarity(spark.createDataFrame(rows, "gene_id string, line string, consolidated_motif_id string, sequence string, motif_consensus string").limit(3))._jdf.queryExecution().executedPlan().toString()
    assert abs(r["consensus_similarity_mean"] - np.mean(want)) < 1e-9 and abs(r["consensus_similarity_std"] - np.std(want)) < 1e-9


def test_matching_ratio_is_the_usual_one(spark):
    """10,000 pairs of random texts over small alphabets, long texts with frequent letters, and edges."""
    rng = np.random.default_rng(3)
    text = lambda letters, most: "".join(rng.choice(list(letters), int(rng.integers(0, most))))
    pairs = [(text("ACGT", 16), text("ACGTRYN", 16)) for _ in range(6000)] + [(text("AC", 24), text("AcC", 24)) for _ in range(3980)]
    for n in range(20):
        a = text("ACGTXYZ", 60) + "".join(chr(0x400 + i) for i in rng.permutation(50)) + text("ACGT", 260)
        pairs.append((a[: 120 + 10 * n], text("ACGT", 130) + a[20:140] + text("ACGTXYZ", 120)))
    pairs += [("", ""), ("A", ""), ("", "A"), ("A", "A"), ("acgt", "ACGT"), ("A" * 250, "A" * 250), ("AC" * 110, "AC" * 110)]
    rows = [(i, a, b) for i, (a, b) in enumerate(pairs)]
    table = spark.createDataFrame([*rows, (-1, None, "A")], "i int, a string, b string").repartition(8)
    got = {r["i"]: r["ratio"] for r in table.select("i", seq.matching_ratio(F.col("a"), F.col("b")).alias("ratio")).collect()}
    assert got.pop(-1) == 0.0 and sum(len(b) >= seq.LONG_TEXT for _, b in pairs) >= 10
    for i, a, b in rows:
        want = SequenceMatcher(None, a.upper(), b.upper()).ratio() if a and b else 0.0
        assert abs(got[i] - want) < 1e-12, (a, b, got[i], want)


def test_number_rows(spark):
    table = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    assert all(r["n"] == r["k"] for r in encode.number_rows(table, "k").collect())


@pytest.fixture(scope="module")
def regression(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 4))
    y = 1.5 + x @ np.array([2.0, -1.0, 0.0, 0.5]) + rng.normal(scale=0.1, size=120)
    rows = [(f"g{i % 24:02d}", f"l{i // 24}", float(y[i]), [float(v) for v in x[i]]) for i in range(120)]
    return x, y, spark.createDataFrame(rows, "gene_id string, line string, y double, x array<double>")


def test_linear_models(spark, regression):
    x, y, table = regression
    data = models.group_folds(table)
    assert data.groupBy("gene_id").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    sums = models.gather(data, list("abcd"))
    a = np.column_stack((np.ones(len(y)), x))
    assert np.allclose(models.ridge(sums.total(), 0.0), np.linalg.lstsq(a, y, rcond=None)[0])
    c, t = x - x.mean(axis=0), y - y.mean()
    assert np.allclose(models.ridge(sums.total(), 10.0)[1:], np.linalg.solve(c.T @ c + 10 * np.eye(4), c.T @ t))
    b = models.lasso(sums.total(), 0.05)[1:]
    slope = c.T @ (t - c @ b) / len(y)
    assert all(abs(s - 0.05 * np.sign(v)) < 1e-6 if v else abs(s) <= 0.05 + 1e-6 for s, v in zip(slope, b, strict=True))
    found = models.linear_models(data, list("abcd"))
    rows = data.collect()
    held = []
    for f in range(5):
        train, test = [r for r in rows if r["fold"] != f], [r for r in rows if r["fold"] == f]
        beta = np.linalg.lstsq(np.array([[1, *r["x"]] for r in train]), np.array([r["y"] for r in train]), rcond=None)[0]
        e = np.array([r["y"] - beta @ [1, *r["x"]] for r in test])
        v = np.array([r["y"] for r in test])
        held.append(1 - (e**2).sum() / ((v - v.mean()) ** 2).sum())
    assert np.isclose(found["ols"]["cv_r2"], np.mean(held)) and np.isclose(found["ols"]["cv_std"], np.std(held))
    assert all(m["r2"] > 0.99 for m in found.values())
    residuals = [r["residual"] for r in models.predictions(table, found["ols"]["beta"]).collect()]
    assert np.isclose(np.sqrt(np.mean(np.square(residuals))), found["ols"]["rmse"])
    lines = sinks.report(models.metrics_table(spark, found), "t", "relative")
    assert lines[0] == "# t" and "strong" in lines[4]
    grid = models.diagnostic_grid(spark, models.gather(models.row_folds(table), list("abcd")), sums)
    assert grid.count() == 12 and grid.where("cv_r2 < 0.9").count() == 0


def test_within_gene(spark, regression):
    x, y, table = regression
    coefficients, found = models.within_gene(table, list("abcd"))
    rows = table.collect()
    genes, lines = sorted({r["gene_id"] for r in rows}), sorted({r["line"] for r in rows})
    v = np.array([r["x"] for r in rows])
    centred = np.array([r["x"] - np.mean([s["x"] for s in rows if s["gene_id"] == r["gene_id"]], axis=0) for r in rows])
    a = np.column_stack((np.ones(len(rows)), centred, *[[r["line"] == n for r in rows] for n in lines[1:]], *[[r["gene_id"] == g for r in rows] for g in genes[1:]])).astype(float)
    t = np.array([r["y"] for r in rows])
    beta = np.linalg.lstsq(a, t, rcond=None)[0]
    r2 = 1 - ((t - a @ beta) ** 2).sum() / ((t - t.mean()) ** 2).sum()
    assert np.isclose(found["r2"], r2) and v.shape == (120, 4)
    assert np.allclose([r["coefficient"] for r in coefficients.collect()], beta[1:5])


def test_penalties_plain(spark, regression):
    """The ridge's by leaving each row out, the lasso's by thirds, against plain fits."""
    data = models.group_folds(regression[2])
    rows = data.select("gene_id", "line", "x", "y", "fold", F.pmod(F.xxhash64("gene_id", "line", F.lit(7)), F.lit(models.THIRDS)).alias("t")).collect()
    x, y, fold, third = (np.array([r[c] for r in rows], dtype=float) for c in ("x", "y", "fold", "t"))
    sums = models.gather(data, list("abcd"))
    full = np.column_stack((np.ones(len(y)), x, y))
    folds = [0, None]
    ridges, lassos = models.best_ridge(data, sums, folds), models.best_lasso(sums, folds)
    for f in folds:
        own = fold != (-1 if f is None else f)
        a, t = full[own], third[own]
        assert np.allclose(sums.total(f), a.T @ a)
        errors = []
        for alpha in models.ALPHAS:
            held = [models.ridge(np.delete(a, i, 0).T @ np.delete(a, i, 0), alpha) for i in range(len(a))]
            errors.append(sum((r[-1] - b[0] - r[1:-1] @ b[1:]) ** 2 for r, b in zip(a, held, strict=True)))
        assert ridges[f] == models.ALPHAS[int(np.argmin(errors))]
        path = models.lasso_alphas(a.T @ a)
        error = np.zeros(len(path))
        for k in np.unique(t):
            for i, alpha in enumerate(path):
                b = models.lasso(a[t != k].T @ a[t != k], alpha)
                error[i] += np.mean((a[t == k][:, -1] - b[0] - a[t == k][:, 1:-1] @ b[1:]) ** 2)
        assert error[int(np.argmin(np.abs(path - lassos[f])))] <= error.min() * (1 + 1e-3)


def test_gene_by_gene_of_many_lines(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 12))
    y = x[:, :10] @ rng.normal(size=10) + 0.1 * rng.normal(size=40)
    rows = [("g", f"l{i // 8}", float(v), u.tolist()) for i, (u, v) in enumerate(zip(x, y, strict=True))]
    r = models.gene_by_gene(spark.createDataFrame(rows, "gene_id string, line string, y double, x array<double>"), [f"f{i}" for i in range(12)]).first()
    a = np.column_stack((np.ones(40), x[:, :10], *[(np.arange(40) // 8 == v).astype(float) for v in range(1, 5)]))
    left = y - a @ np.linalg.lstsq(a, y, rcond=None)[0]
    assert (r["n_obs"], r["n_lines"]) == (40, 5) and abs(r["r2"] - (1 - (left**2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-9


def test_gene_by_gene(spark):
    rows = [("a", f"l{i}", float(i), [float(i)]) for i in range(5)] + [("b", "l0", 1.0, [0.0]), ("b", "l1", 1.0, [1.0])]
    found = models.gene_by_gene(spark.createDataFrame(rows, "gene_id string, line string, y double, x array<double>"), ["f"], most=0).collect()
    assert [(r["gene_id"], round(r["r2"], 9)) for r in found] == [("a", 1.0)]  # b has no spread
    assert models.gene_by_gene(spark.createDataFrame(rows, "gene_id string, line string, y double, x array<double>"), ["f"]).count() == 0  # more columns than rows
    one = spark.createDataFrame([("a", f"l{i % 2}", float(2 * i), [float(i)]) for i in range(6)], "gene_id string, line string, y double, x array<double>")
    r = models.gene_by_gene(one, ["f"]).first()
    assert np.isclose(r["r2"], 1.0) and (r["n_obs"], r["n_lines"], r["important"]) == (6, 2, 1)


def plain_merge(hits, threshold=0.5):
    """Intervals of sorted (start, end, score, sequence): start, end, score, sequence, count."""
    out = []
    for s, e, score, seq in hits:
        if out:
            a, b, c, d, n = out[-1]
            if max(0, min(b, e) - max(a, s) + 1) / min(b - a + 1, e - s + 1) >= threshold:
                out[-1] = (min(a, s), max(b, e), max(c, score), seq if len(seq) > len(d) else d, n + 1)
                continue
        out.append((s, e, score, seq, 1))
    return out


def test_merge_long_island(spark):
    """Chains of very many touching hits, in time that grows with their number."""
    import time

    rng = random.Random(3)
    hits = sorted((i * 6 + rng.randint(0, 3), i * 6 + rng.randint(8, 14), float(rng.randint(0, 9)), "ACGT" * rng.randint(1, 4)) for i in range(100_000))
    rows = [("g", "l", "+", "M1", s, e, score, seq, f"{i:08d}", "x") for i, (s, e, score, seq) in enumerate(hits)]
    cols = "gene_id string, line string, strand string, consolidated_motif_id string, start_pos int, end_pos int, score double, sequence string, src_ord string, pattern string"
    began = time.time()
    got = sites.merge_overlaps(spark.createDataFrame(rows, cols)).orderBy("start_pos", F.col("src_ord")).collect()
    assert time.time() - began < 60
    want = sorted(plain_merge(hits))
    assert sorted((r["start_pos"], r["end_pos"], r["score"], r["sequence"], r["merged_count"]) for r in got) == want and len(want) > 10_000


def test_gather_in_blocks(spark, monkeypatch):
    """Blocks that do not divide the columns, handed on every few rows, give the plain products."""
    rng = np.random.default_rng(5)
    rows = [(f"g{i % 23}", f"l{i}", float(rng.normal()), [float(v) for v in rng.integers(-3, 4, 11)], int(i % 3)) for i in range(200)]
    data = spark.createDataFrame(rows, "gene_id string, line string, y double, x array<double>, fold int").repartition(5)
    monkeypatch.setattr(models, "BLOCK", 4)
    monkeypatch.setattr(models, "SLICE", 60)
    monkeypatch.setattr(models, "HELD", 50)
    sums = models.gather(data, [f"f{i}" for i in range(11)])
    for fold in range(3):
        a = np.array([[1.0, *x, y] for _, _, y, x, f in rows if f == fold])
        assert np.allclose(sums.products[fold], a.T @ a, atol=1e-9)
    assert len(sums.thirds()) == models.THIRDS
    empty = models.gather(data.where("fold > 9"), [f"f{i}" for i in range(11)])
    assert empty.parts == {}


def test_least_squares_of_columns_in_any_unit():
    """Columns in units from 1e-4 to 1e4, some of them made up of others or constant."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(90, 8)) * 10.0 ** np.arange(-4, 4)
    x = np.column_stack((x, x[:, 6] + 100 * x[:, 5], np.full(90, 3.0), np.zeros(90)))
    y = 2 + x[:, :8] @ (rng.normal(size=8) / 10.0 ** np.arange(-4, 4)) + rng.normal(scale=0.1, size=90)
    full = np.column_stack((np.ones(90), x, y))
    beta = models.ridge(full.T @ full, 0.0)
    want = np.linalg.lstsq(x - x.mean(axis=0), y - y.mean(), rcond=1e-12)[0]
    assert np.allclose(beta[0] + x @ beta[1:], y.mean() + (x - x.mean(axis=0)) @ want, atol=1e-6)
    assert np.linalg.norm(beta[1:]) <= np.linalg.norm(want) * (1 + 1e-6)


def test_consolidate_streamed(spark):
    from sitelattice.plans import views

    raw = views.sites_raw(spark, "/root/testdata/sf0.001")
    a, b = sites.consolidate(raw), sites.consolidate(raw, streamed=True)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
