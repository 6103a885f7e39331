"""File sources, sinks and the command line over a tiny three-line fixture."""

import pytest
from pyspark.sql import functions as F

from sitelattice import cli
from sitelattice.operators import encode, sites
from sitelattice.sources import files, sinks

HITS = """IM502 | 1-TATAAA  | g1 | 100 | 105 | + | 9.0 | TATAAA
IM502 | 1-TATAAA  | g1 | 102 | 107 | + | 8.0 | TATAAA
IM502 | 2-GGGCGG  | g1 | 300 | 305 | - | 7.5 | GGGCGG
IM502 | 2-GGGCGG  | g2 |  50 |  55 | + | 7.0 | GGGCGC
IM664 | 1-TATAAAT | g1 | 110 | 116 | + | 9.5 | TATAAAT
IM664 | 1-TATAAAT | g2 | 720 | 726 | + | 6.0 | TATATAT
IM767 | 3-TATAAA  | g1 | 100 | 105 | + | 9.1 | TATAAA
IM767 | 1-CACGTG  | g2 | 400 | 405 | + | 8.8 | CACGTG
IM767 | 1-CACGTG  | g2 | 404 | 409 | + | 8.9 | CACGTG"""

EXPECTED = """MOTIF_001 | 1-TATAAA | TATAAA | TATAAA | IM502 | g1 | 100 | 107 | + | 9.0 | TATAAA | 1 | 2 | 0.5 | 2 | 2 | 8
MOTIF_001 | 1-TATAAAT | TATAAA | TATAAAT | IM664 | g1 | 110 | 116 | + | 9.5 | TATAAAT | 1 | 1 | 1.0 | 2 | 1 | 7
MOTIF_001 | 1-TATAAAT | TATAAA | TATAAAT | IM664 | g2 | 720 | 726 | + | 6.0 | TATATAT | 1 | 1 | 1.0 | 2 | 1 | 7
MOTIF_001 | 3-TATAAA | TATAAA | TATAAA | IM767 | g1 | 100 | 105 | + | 9.1 | TATAAA | 1 | 1 | 1.0 | 2 | 1 | 6
MOTIF_002 | 2-GGGCGG | GGGCGS | GGGCGG | IM502 | g1 | 300 | 305 | - | 7.5 | GGGCGG | 2 | 2 | 1.0 | 1 | 1 | 6
MOTIF_002 | 2-GGGCGG | GGGCGS | GGGCGG | IM502 | g2 | 50 | 55 | + | 7.0 | GGGCGC | 1 | 1 | 1.0 | 1 | 1 | 6
MOTIF_003 | 1-CACGTG | CACGTG | CACGTG | IM767 | g2 | 400 | 405 | + | 8.8 | CACGTG | 1 | 2 | 0.5 | 1 | 1 | 6
MOTIF_003 | 1-CACGTG | CACGTG | CACGTG | IM767 | g2 | 404 | 409 | + | 8.9 | CACGTG | 2 | 2 | 1.0 | 1 | 1 | 6"""


def cells(text):
    return [[c.strip() for c in line.split("|")] for line in text.splitlines()]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("runs")
    header = "extra\tsite_Score\tmotif_ID\tseq_ID\tsite_Start\tsite_End\tsite_Strand\tsite_Sequence"
    by_line = {}
    for line, motif, gene, start, end, strand, score, seq in cells(HITS):
        by_line.setdefault(line, []).append(f"x\t{score}\t{motif}\t{gene}\t{start}.0\t{end}\t{strand}\t{seq.lower()}")
    for line, rows in by_line.items():
        d = top / f"streme_Genes_{line}_DNA"
        d.mkdir()
        bad = ["", "# note", "x\t1\tm", "x\tNaN\t1-A\tg\t1\t2\t+\tA", "x\tabc\t1-A\tg\t1\t2\t+\tA", "x\t1\t1-A\tg\tinf\t2\t+\tA"]
        (d / "sites.tsv").write_text("\n".join([header, *rows, *bad]) + "\n")
        (d / "streme.txt").write_text(f"intro\nMOTIF 1-TATAWA STREME-1\nletter-probability matrix: alength= 4 w= 6 nsites= 20 E= 1.0e-004\n 0.1 0.2 0.3 0.4\n 1 0 0 0\nMOTIF 2-{'CACGTG' if line == 'IM767' else 'GGGCGG'} STREME-2\nletter-probability matrix: alength= 4 w= 6 nsites= 5 E= 0.02\n\nMOTIF 3-QQ STREME-3\n")
    broken = top / "streme_IM1"
    broken.mkdir()
    (broken / "sites.tsv").write_text("motif_ID\tseq_ID\n1-A\tg\n")
    lines = ["IM502", "IM664", "IM767"]
    genes = [f"g{i}" for i in range(1, 7)]
    (top / "wide.tsv").write_text("\n".join(["\t".join(["gene", "LRTadd", *lines]), *["\t".join([g, "9", *[str(round((i * 7 + j * 3) % 5 / 3 if x != "IM767" else 0.0, 3)) for j, x in enumerate(lines)]]) for i, g in enumerate(genes)]]) + "\n")
    (top / "long.tsv").write_text("Gene\tLine\tExpression\ng1\tIM502\t1.5\ng1\tIM502\t2.5\ng2\tIM664\tx\n")
    return str(top)


def test_consolidate_fixture(spark, folder):
    found = sites.consolidate(files.read_sites(spark, folder)).select(*sites.COLUMNS).collect()
    want = sorted(tuple(r) for r in cells(EXPECTED))
    assert sorted(tuple(str(v) for v in r) for r in found) == want


def test_line_filter_and_names(spark, folder):
    assert {r[0] for r in files.read_sites(spark, folder, ["IM664"]).select("line").distinct().collect()} == {"IM664"}
    names = spark.createDataFrame([("streme_Genes_IM155_DNA_lifted",), ("streme_IM502",), ("streme_abc",)], "d string")
    assert [r[0] for r in names.select(files.line_name(F.col("d"))).collect()] == ["IM155", "IM502", "abc"]
    assert [r[0] for r in names.select(files.line_number(F.col("d"))).collect()] == ["155", "502", "streme_abc"]


def test_motif_records(spark, folder):
    rows = files.read_motifs(spark, f"{folder}/streme_*/streme.txt", pwm=True).orderBy("ord").collect()
    assert len(rows) == 9 and rows[0]["consensus"] == "TATAWA" and rows[0]["width"] == 6 and rows[0]["n_sites"] == 20 and rows[0]["evalue"] == 1e-4
    assert rows[0]["pwm"] == [[0.1, 0.2, 0.3, 0.4], [1.0, 0.0, 0.0, 0.0]] and rows[2]["evalue"] is None
    assert files.read_motifs(spark, f"{folder}/streme_*/streme.txt", iupac_only=True).count() == 6
    line = spark.createDataFrame([("MOTIF 1-ACGT STREME-1",), ("no",)], "t string").select(files.motif_from_line(F.col("t")).alias("m")).collect()
    assert line[0]["m"]["consensus"] == "ACGT" and line[1]["m"]["consensus"] is None
    assert {r["n_motifs"] for r in files.motif_counts(spark, f"{folder}/streme_*/streme.txt").collect()} == {3}


def test_expression_readers(spark, folder):
    wide = files.read_expression(spark, f"{folder}/wide.tsv", reference="IM767")
    assert wide.count() == 12 and {r[0] for r in wide.select("line").distinct().collect()} == {"IM502", "IM664"}
    rows = {(r["gene_id"], r["line"]): r["expression"] for r in files.read_expression_lenient(spark, f"{folder}/long.tsv").collect()}
    assert rows == {("g1", "IM502"): 2.5, ("g2", "IM664"): 0.0}
    assert files.read_expression(spark, f"{folder}/long.tsv").count() == 3


def test_small_readers(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">s1 first one\nACGT\nACG\n>s2\nTTTT\n")
    (tmp_path / "m.tsv").write_text("# c\nm1\tn1\t1e-3\t5\t8\nm2\tN/A\nalone\n")
    (tmp_path / "g.txt").write_text("g1\n  g2 \n\n")
    (tmp_path / "c.json").write_text('{"all_motifs": {"a": {"consensus": "ACG", "width": 3}},\n "line_motifs": {}, "motif_positions": {"a": [{"position": 4, "strand": "+"}]}}')
    assert [(r["id"], r["description"], r["sequence"]) for r in files.read_fasta(spark, str(tmp_path / "a.fa")).orderBy("ord").collect()] == [("s1", "s1 first one", "ACGTACG"), ("s2", "s2", "TTTT")]
    rows = files.read_motif_list(spark, str(tmp_path / "m.tsv")).collect()
    assert [(r["motif_id"], r["name"], r["evalue"], r["n_sites"]) for r in rows] == [("m1", "n1", 1e-3, 5), ("m2", None, None, None)]
    assert [r[0] for r in files.read_genes(spark, str(tmp_path / "g.txt")).collect()] == ["g1", "g2"]
    assert [r[0] for r in files.read_genes(spark, text="g1, g2,,").collect()] == ["g1", "g2"]
    assert files.read_compiled(spark, str(tmp_path / "c.json")).first()["all_motifs"]["a"]["consensus"] == "ACG"


def test_fasta_is_split_between_records(spark, tmp_path):
    made = [(f"s{i}", "ACGT" * (i % 7) + "N>"[: i % 2]) for i in range(400)]
    (tmp_path / "a.fa").write_text("; a note\n" + "".join(f">{n} of > one\r\n{s[:9]}\r\n{s[9:]}\r\n" for n, s in made))
    (tmp_path / "b.fa").write_text(">>odd\nAC\n\n>last")
    (tmp_path / "c.fa").write_text("")
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        table = files.read_fasta(spark, f"{tmp_path}/*.fa")
        assert table.rdd.getNumPartitions() > 1
        assert [(r["id"], r["sequence"]) for r in table.orderBy("ord").collect()] == [*made, (">odd", "AC"), ("last", "")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


def test_commands(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    assert cli.main(["consolidate", folder, "--output", out, "--validate"]) == 0
    table = files.read_consolidated(spark, f"{out}/sites")
    assert table.count() == 8 and spark.read.csv(f"{out}/sites", sep="\t", header=True).columns == sites.COLUMNS
    assert cli.main(["validate", f"{out}/sites", "--output", out]) == 0
    assert cli.main(["features", f"{out}/sites", "--min-sites", "1", "--expression", f"{folder}/long.tsv", "--output", out]) == 0
    wide = files.read_features(spark, f"{out}/features")
    assert wide.count() == 6 and "MOTIF_001_present" in wide.columns and dict(wide.dtypes)["MOTIF_001_position_mean"] == "double"
    assert cli.main(["relative", "--trees", "3", f"{out}/sites", f"{folder}/wide.tsv", "--min-sites", "1", "--output", f"{out}/rel"]) == 0
    assert "Best: " in "\n".join(r[0] for r in spark.read.text(f"{out}/rel/report").collect())
    assert cli.main(["gene-specific", "--trees", "3", f"{out}/sites", f"{folder}/wide.tsv", "--genes", "g1,g2", "--output", f"{out}/gene"]) == 0
    for _ in range(2):  # what the standing catalog has is not added again
        assert cli.main(["catalog", folder, "--standing", f"{out}/standing", "--output", f"{out}/cat"]) == 0
    assert spark.read.csv(f"{out}/cat/standing", sep="\t", header=True).count() == spark.read.csv(f"{out}/cat/line_map", sep="\t", header=True).count()
    assert spark.read.csv(f"{out}/cat/catalog", sep="\t", header=True).count() == 6  # consensus under 3 letters never matches
    assert cli.main(["diagnostic", f"{out}/sites", f"{folder}/wide.tsv", "--output", f"{out}/diag"]) == 0
    assert cli.main(["mixed", f"{out}/features", f"{folder}/wide.tsv", "--output", f"{out}/mixed"]) == 0
    assert cli.main(["comprehensive", "--trees", "3", f"{out}/sites", f"{folder}/wide.tsv", "--interactions", "--top-motifs", "5", "--output", f"{out}/comp"]) == 0
    assert cli.main(["absolute", "--trees", "3", f"{out}/features", f"{folder}/wide.tsv", "--detailed", "--output", f"{out}/abs"]) == 0
    assert cli.main(["full", "--trees", "3", folder, "--expression", f"{folder}/wide.tsv", "--min-sites", "1", "--output", f"{out}/full"]) == 0


def test_fasta_header(spark):
    rows = spark.createDataFrame([("L", "ACG", 5, 3, "+", "a"), ("L", "TTT", 9, 3, "-", "b")], "line string, consensus string, position int, width int, strand string, src_ord string")
    assert sinks.fasta_header("spaced", rows).first()["header"] == "L mode=spaced motifs=2 consensuses=ACG,TTT positions=5,9"
    assert encode.spaced_string(rows).first()["encoded"] == "ACGNTTT" and encode.positional_string(rows).first()["encoded"] == "P000ACGNNP1000[TTT]"


def test_chart_and_report_sinks(spark, tmp_path):
    table = spark.createDataFrame([(float(i), "a" if i % 2 else "b") for i in range(11)], "v double, k string")
    rows = sinks.histogram(table, "v", 5).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 2, 2, 2, 3] and rows[0]["low"] == 0.0 and rows[-1]["high"] == 10.0
    assert sinks.histogram(table.where("false"), "v").count() == 0
    assert {r["k"]: r["median"] for r in sinks.box_data(table, "v", "k").collect()} == {"a": 5.0, "b": 5.0}
    docs = spark.createDataFrame([(1, "GGCC"), (2, "GGCA"), (3, "A")], "n int, t string")
    pairs = encode.adjacent_pairs(docs, "n", "n", "t")
    assert [(r["kind"], r["second_id"]) for r in pairs.orderBy("pair_no").collect()] == [("dissimilar_pair", 2), ("single_remaining", None)]
    sinks.write_group_report(pairs, str(tmp_path / "groups"))
    assert spark.read.text(str(tmp_path / "groups")).count() == 2
    assert [r["motif_group"] for r in encode.pair_groups(pairs, ["m"]).collect()] == ["orphan", "orphan"]


def test_split_files_keep_their_order(spark, folder):
    """The same hits in the same order, however the files are cut into splits."""
    key = "spark.sql.files.maxPartitionBytes"
    whole = [tuple(r)[:-1] for r in files.read_sites(spark, folder).orderBy("src_ord").collect()]
    spark.conf.set(key, "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        cut = files.read_sites(spark, folder)
        assert files._lines(spark, f"{folder}/streme_*/sites.tsv").rdd.getNumPartitions() > 5 and [tuple(r)[:-1] for r in cut.orderBy("src_ord").collect()] == whole
    finally:
        spark.conf.unset(key)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_reports(spark):
    from sitelattice.operators import features, models

    found = {"ols": {"cv_r2": 0.45, "cv_std": 0.1, "r2": 0.5, "rmse": 1.0}, "lasso": {"cv_r2": float("nan"), "cv_std": 0.0, "r2": 0.1, "rmse": 2.0}}
    weights = spark.createDataFrame([("ols", "MOTIF_001_presence_diff", 0.5), ("ols", "MOTIF_002_gc_content_diff", 0.1)], "model string, feature string, importance double")
    data = spark.createDataFrame([("g1", "IM62", 1.0), ("g2", "IM155", -1.0)], "gene_id string, line string, y double")
    lines = sinks.report(models.metrics_table(spark, found), "t", "relative", weights, sinks.facts(data, "IM767"))
    assert lines[0] == "# t" and "| ols |" in lines[4] and "strong" in lines[4] and "Best: ols" in lines
    assert "- MOTIF_001 (presence change): 0.5000" in lines and "- MOTIF_002_gc_content_diff (other): 0.1000" in lines
    assert "- lines: IM155, IM62" in lines and "- reference line: IM767" in lines and "45.0 %" in lines[-1]
    described = sinks.feature_descriptions(spark.createDataFrame([("MOTIF_001", 7)], "consolidated_motif_id string, n_sites long"), ["present", *features.POSITION, *features.VARIATION])
    assert "- MOTIF_001: 7 hits" in described and all(f"- <motif>_{c}: {sinks.DESCRIBED[c]}" in described for c in ("present", *features.POSITION, *features.VARIATION))
    runs = spark.createDataFrame([("IM62", 3), ("IM155", 2)], "line string, n_motifs long")
    catalog = spark.createDataFrame([("cluster_1", 2, 4, "IM155,IM62"), ("cluster_2", 1, 1, "IM62")], "cluster_id string, n_lines long, occurrences long, lines string")
    pairs = spark.createDataFrame([(1, "IM155", "a", "IM62", "b")], "pair_no int, line_1 string, motif_1 string, line_2 string, motif_2 string")
    lines = sinks.master_report(runs, catalog, pairs)
    assert "runs: 2, motifs: 5, clusters: 2, in several lines: 1" in lines and "- pair 1: IM155 and IM62, 1 pairs of motifs" in lines and "- cluster_1: 4 in 2 lines (IM155,IM62)" in lines


def test_hit_tables_in_parts(spark):
    """A run's hit table may be a folder of files, each with its header; none is written by one task."""
    from pathlib import Path

    from sitelattice.plans import source_queries, views

    sf = "/root/testdata/sf0.001"
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        folder = source_queries._hits(spark, sf)
    finally:
        spark.conf.unset(key)
    for line in views.LINES:
        assert len(list(Path(folder.removeprefix("file://")).glob(f"streme_{line}/sites.tsv/part-*"))) > 1
    columns = ["gene_id", "line", "original_motif_id", "start_pos", "end_pos", "strand", "score", "sequence"]
    raw, found = views.sites_raw(spark, sf), files.read_sites(spark, folder)
    for line in views.LINES:  # the same hits in the same order
        rows = lambda df: [tuple(r) for r in df.where(F.col("line") == line).orderBy("src_ord").select(*columns).collect()]  # noqa: B023, E731
        assert rows(found) == rows(raw)


def test_sites_of_lines_reads_their_files_alone(spark, tmp_path):
    """Runs are chosen by directory, before their hits are read; a directory's name is no pattern."""
    head = "\t".join(files.REQUIRED)
    hit = "1-ACGT\tg1\t{}\t9\t+\t1.5\tacgt"
    for name, start in (("streme_IM1", 1), ("streme_b [x]*_IM2", 2), ("streme_c", 3), ("streme_late_IM2", 4)):
        (tmp_path / name).mkdir()
        lines = [hit.format(start), head] if "late" in name else ["", "# note", f" {head} ".replace("\t", " \t "), hit.format(start), head, hit.format(start + 10)]
        (tmp_path / name / "sites.tsv").write_text("\n".join(lines) + "\n")
    (tmp_path / "streme_IM3" / "sites.tsv").mkdir(parents=True)
    for part in "ab":
        (tmp_path / "streme_IM3" / "sites.tsv" / part).write_text(f"{head}\n{hit.format(ord(part))}\n")
    starts = lambda *x: sorted((r["line"], r["start_pos"]) for r in files.read_sites(spark, str(tmp_path), *x).collect())
    want = [("IM1", 1), ("IM1", 11), ("IM2", 2), ("IM2", 12), ("IM3", 97), ("IM3", 98), ("c", 3), ("c", 13)]  # a file that begins with a hit has no header
    assert starts() == want
    for lines in (["IM2"], ["IM3", "c"], ["IM"]):
        assert starts(lines) == [x for x in want if x[0] in lines]
    read = files.read_sites(spark, str(tmp_path), ["IM2", "IM3"]).inputFiles()
    assert len(read) == 4 and all("IM2" in f or "IM3" in f for f in read)
