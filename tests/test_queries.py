"""Every query with an oracle against DuckDB on the smallest tables; the flagship."""

import math

import duckdb
import pytest

from sitelattice.plans import catalog, layer_queries, linear_queries, model_queries, source_queries  # noqa: F401

SF = "/root/testdata/sf0.001"


def rounded(v):
    return round(v, 6) + 0.0 if isinstance(v, float) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("lineitem", "documents"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(rounded(r[c]) for c in cols) for r in df.collect()), key=repr)
    result = con.execute(catalog.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    want = sorted((tuple(rounded(r[names.index(c)]) for c in cols) for r in result.fetchall()), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, abs_tol=2e-6)) for x, y in zip(a, b, strict=True)), (a, b)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())


def test_pairs_of_odd_texts(spark, tmp_path):
    """Ratios that end in a five (41/640), missing and empty texts: as in SQL."""
    texts = ["G" * 41 + "A" * 599, "C" * 5 + "A" * 635, None, "ACG", "G", "", None, None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    result = c.execute(catalog.ORACLES["adjacent_pairs"])
    names = [d[0] for d in result.description]
    want = sorted(result.fetchall())
    assert sorted(map(tuple, catalog.QUERIES["adjacent_pairs"](spark, str(tmp_path)).select(*names).collect())) == want


@pytest.mark.parametrize("rows", [[(1, "GC"), (2, "A"), (3, "")], [(None, "GGG"), (3, "A"), (1, None), (2, "AGT"), (5, "AAA"), (4, None)], [(7, None)]])
@pytest.mark.parametrize("name", ["adjacent_pairs", "pair_groups"])
def test_odd_count_and_missing_ids(spark, tmp_path, name, rows):
    """An odd last row has no second GC content; missing ids come last; a missing text is like none: as in SQL."""
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    result = c.execute(catalog.ORACLES[name])
    names = [d[0] for d in result.description]
    want = sorted(result.fetchall(), key=repr)
    assert sorted(map(tuple, catalog.QUERIES[name](spark, str(tmp_path)).select(*names).collect()), key=repr) == want
