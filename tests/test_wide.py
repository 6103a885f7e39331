"""Wide tables of any width."""

from sitelattice.operators import encode, features, wide


def test_five_thousand_motifs_in_parts(spark):
    n = 5000
    rows = [(f"g{m % 3}", "ab"[m % 2], f"M{m:04d}", 1, m + 1) for m in range(n)]
    table = spark.createDataFrame(rows, f"gene_id string, line string, {features.MOTIF} string, present int, count long")
    spark.conf.set("spark.sql.codegen.wholeStage", "false")  # a row of this width is beyond one method
    try:
        found = features.matrix(table, ["count"])
        assert len(found.columns) == 2 + n and found.columns[2] == "M0000_count" and found.columns[-1] == "M4999_count"
        got = {(r["gene_id"], r["line"]): r for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.codegen.wholeStage")
    assert len(got) == 6
    for g, line, m, _, c in rows[::97]:
        assert got[g, line][f"{m}_count"] == c and sum(r[f"{m}_count"] for r in got.values()) == c
    assert sum(sum(r[2:]) for r in got.values()) == n * (n + 1) // 2


def test_parts_equal_the_whole(spark):
    rows = [("g", "a", "M1", 1, 2), ("g", "a", "M2", 1, 1), ("h", "b", "M3", 1, 5), ("h", "a", "M2", 1, 4), ("i", "b", None, 1, 9)]
    table = spark.createDataFrame(rows, f"gene_id string, line string, {features.MOTIF} string, present int, count long")
    keys, columns = ["gene_id", "line"], ["present", "count"]
    whole = wide.widen(table, keys, features.MOTIF, columns)
    assert whole.columns == [*keys, *[f"M{i}_{c}" for i in (1, 2, 3) for c in columns]]
    for chunk in (1, 2):
        part = wide.widen(table, keys, features.MOTIF, columns, chunk=chunk)
        assert part.columns == whole.columns and sorted(map(tuple, part.collect())) == sorted(map(tuple, whole.collect()))
    assert ("i", "b", 0, 0, 0, 0, 0, 0) in {tuple(r) for r in whole.collect()}
    assert wide.widen(table.where("false"), keys, features.MOTIF, columns).columns == keys


def test_training_matrix_finds_its_words(spark):
    table = spark.createDataFrame([("a", "ACG"), ("a", "ACG"), ("b", "TTT")], "line string, consensus string")
    found = encode.training_matrix(table)
    assert found.columns == ["line", "ACG", "TTT"] and sorted(map(tuple, found.collect())) == [("a", 1, 0), ("b", 0, 1)]
