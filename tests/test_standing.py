"""The standing catalog: run by run as all at once; repeated and broken runs."""

import random

from sitelattice.operators import cluster, standing
from sitelattice.plans import tables

SCHEMA = "ord int, line string, motif_id string, consensus string"


def test_runs_in_order_are_one_sweep(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("ACGTRYN") for _ in range(rng.choice([2, 6, 7, 8]))) for _ in range(14)]
    rows = [(i, f"L{i // 12}", f"m{i}", rng.choice(words) if rng.random() < 0.6 else "".join(rng.choice("ACGT") for _ in range(6))) for i in range(36)]
    table = spark.createDataFrame(rows, SCHEMA)
    path = tables.new_path(spark, "standing")
    assert standing.runs(spark, path) == [] and standing.leaders(spark, path).count() == 0
    assert standing.append(table.where("line = 'L0'"), path, "L0")
    # A run that broke after its leaders were written does not count, and is done over.
    spark.createDataFrame([(99, "TTTTTT")], "number int, text string").write.parquet(f"{path}/leaders/run=L1")
    assert standing.runs(spark, path) == ["L0"]
    for run in ("L1", "L2"):
        assert standing.append(table.where(f"line = '{run}'"), path, run)
    before = sorted(map(tuple, standing.members(spark, path).collect()))
    assert not standing.append(table.where("line = 'L1'"), path, "L1") and sorted(map(tuple, standing.members(spark, path).collect())) == before
    once = cluster.cluster(table, text="consensus").select("ord", "cluster_no").collect()
    got = standing.members(spark, path).collect()
    assert {r["ord"]: r["cluster_no"] for r in got} == {r["ord"]: r["cluster_no"] for r in once} and len(got) == 36
    assert standing.leaders(spark, path).count() == len({r["cluster_no"] for r in once})


def test_empty_run(spark):
    path = tables.new_path(spark, "standing")
    assert standing.append(spark.createDataFrame([], SCHEMA), path, "none") and standing.runs(spark, path) == ["none"] and standing.members(spark, path).count() == 0
