"""Layer blocks and products of pairs against a dense table in pandas."""

import itertools
import random

import pandas as pd
import pytest

from sitelattice.operators import features, layers, models

M = layers.MOTIF


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(4)
    rows = []
    for g, line, m in itertools.product(range(6), "ab", range(5)):
        for _ in range(rng.choice([0, 0, 1, 2]) if m else 1):
            rows.append((f"g{g}", line, f"M{m}", rng.randint(0, 1900), 8, "".join(rng.choice("ACGT") for _ in range(8)), "ACGTACGT", 1.0))
    table = spark.createDataFrame(rows, f"gene_id string, line string, {M} string, start_pos int, length int, sequence string, motif_consensus string, score double").cache()
    target = spark.createDataFrame([(f"g{g}", line, None if (g, line) == (0, "a") else float(g)) for g in range(5) for line in "ab"] + [("g9", "a", 1.0)], "gene_id string, line string, expression double")
    return table, target, rows


def dense(rows):
    """Presence and position score of every motif, over the rows with a target."""
    kept = [(f"g{g}", line) for g in range(5) for line in "ab" if (g, line) != (0, "a")]
    present, score = pd.DataFrame(0.0, kept, [f"M{m}" for m in range(5)]), pd.DataFrame(0.0, kept, [f"M{m}" for m in range(5)])
    for g, line, m, p, *_ in rows:
        if (g, line) in kept:
            present.loc[[(g, line)], m] = 1.0
            score.loc[[(g, line)], m] += 2.718281828459045 ** (-p / 1000)
    return present, score


def test_ranking_counts_absent_rows_as_zero(spark, made):
    table, target, rows = made
    present, _ = dense(rows)
    ranking = layers.presence_ranking(table, layers.rows_of(table, target))
    got = {r[M]: r for r in ranking.collect()}
    want = present.var()
    assert {m: pytest.approx(r["variance"]) for m, r in got.items()} == want.to_dict() and {r["n_rows"] for r in got.values()} == {9}
    assert layers.top_motifs(ranking, 5) == sorted(want.index, key=lambda m: (-round(want[m], 12), m))
    assert layers.top_motifs(ranking, 2) == layers.top_motifs(ranking, 5)[:2] and layers.top_motifs(ranking, 5)[-1] == "M0"  # always there


def test_products_are_those_of_the_dense_table(spark, made):
    table, target, rows = made
    present, score = dense(rows)
    motifs = ["M3", "M1", "M2"]  # rank order, not order of names
    assert layers.pair_names(motifs)[:3] == ["M3_X_M1_presence", "M3_X_M2_presence", "M1_X_M2_presence"] and len(layers.pair_names(motifs)) == 6
    got = {(r["gene_id"], r["line"], r["feature"]): r["value"] for r in layers.pair_values(table, motifs).collect() if (r["gene_id"], r["line"]) in present.index}
    want = {}
    for a, b in itertools.combinations(motifs, 2):
        for (g, line), both in (present[a] * present[b]).items():
            if both:
                want[g, line, f"{a}_X_{b}_presence"] = 1.0
                want[g, line, f"{a}_position_X_{b}_presence"] = pytest.approx(score[a][g, line])
    assert got == want and len(want) > 4
    assert {r["feature"] for r in layers.pair_values(table, motifs, position=False).collect()} <= set(layers.pair_names(motifs, position=False))


def test_block_variances_without_zeros(spark, made):
    table, target, _ = made
    rows = layers.rows_of(table, target)
    values = layers.block_values(table, ["M1", "M2"], list(layers.LAYERS))
    assert values.where("abs(value) <= 1e-12").count() == 0 and {r[0].split("_")[0] for r in values.select("feature").distinct().collect()} == {"M1", "M2"}
    wide = values.join(rows, layers.ROW, "left_semi").toPandas().pivot_table(index=layers.ROW, columns=["layer", "feature"], values="value").reindex(pd.MultiIndex.from_tuples([tuple(r) for r in rows.collect()])).fillna(0)
    want = wide.var()
    got = {(r["layer"], r["feature"]): r["variance"] for r in layers.column_variances(values, rows).collect()}
    assert got == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}


def test_sizes_and_kinds(spark):
    motifs, chosen = ["M1", "M2", "M3"], ["presence", "position"]
    assert layers.sizes(motifs, chosen, motifs[:2]) == [("presence", 6), ("position", 18), ("interaction", 2), ("combined", 6 + 21 + 2)]
    kinds = {r["feature"]: r["layer"] for r in layers.column_layers(spark, motifs, chosen, motifs[:2]).collect()}
    assert len(kinds) == 29 and kinds["M1_X_M2_presence"] == kinds["M1_position_X_M2_presence"] == "interaction" and kinds["M3_total_hits"] == "position"


def test_empty_tables(spark, made):
    table, target, _ = made
    nothing = table.where("false")
    rows = layers.rows_of(nothing, target)
    assert rows.count() == 0 and layers.presence_ranking(nothing, rows).count() == 0 and layers.presence_ranking(table, rows).count() == 0
    assert layers.block_values(nothing, [], list(layers.LAYERS)).count() == 0 and layers.pair_values(table, []).count() == 0


def test_design_lays_out_missing_and_null_values_as_zero(spark):
    values = spark.createDataFrame([("g", "a", "f2", 2.0), ("g", "a", "f1", None), ("h", "a", "other", 5.0)], "gene_id string, line string, feature string, value double")
    target = spark.createDataFrame([("g", "a", 1.0), ("g", "b", 3.0), ("h", "a", None)], "gene_id string, line string, expression double")
    assert sorted((r["gene_id"], r["line"], r["y"], list(r["x"])) for r in models.design(values, target, ["f1", "f2"]).collect()) == [("g", "a", 1.0, [0.0, 2.0]), ("g", "b", 3.0, [0.0, 0.0])]
    assert [list(r["x"]) for r in models.design(values, target, []).collect()] == [[], []]
    assert features.long_values(spark.createDataFrame([("g", "a", "M", 1)], f"gene_id string, line string, {M} string, present int"), ["present"]).first()["feature"] == "M_present"


def test_forests_read_the_expression_once(spark):
    """Every layer's design joins the target; it is a small written table, not the orders again."""
    from sitelattice.plans import layer_queries

    _, target, rows, _ = layer_queries._ranked(spark, "/root/testdata/sf0.001")
    plan = target._jdf.queryExecution().toString()
    assert "expression-" in plan and "lineitem" not in plan and target.join(rows, ["gene_id", "line"], "left_semi").count() == rows.count()


def test_loose_profile_reads_written_sites(spark):
    """The profile's two passes do not consolidate twice."""
    from sitelattice.plans import catalog

    plan = catalog._loose_profile(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "consolidated-" in plan and "lineitem" not in plan
