"""Every dealt operator over nulls, empty and long texts, ties, repeated rows, empty
tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

from sitelattice.llm import decontaminate, encoding, licenses, packing, pii, quality, secrets, simhash, token_counts, topk, toxicity
from sitelattice.llm import common

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, row string, hit_spans string, digest string, _text string"
LONG = "wörd " * 30_000 + "x" * 50_000
TEXTS = [None, "", "   \n\t", "one", "a b c d e f g", "a b c d e f g", LONG, "Mr John Smith token=abcdefgh12 +1 (974) 555-3436", "日本語 <|endoftext|> text", "Released under the MIT License."]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, None, None, 1.0, 5, "r", "h", "d", "t") for i, t in enumerate(TEXTS)]
    rows += [(None, "null id text", *rows[0][2:]), rows[4], rows[4], (4, "other text of id four", *rows[0][2:])]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(8)] + [(3, None, None), (None, 1, 1), (5, 0, 1), (5, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "one"), (1, "a b c"), (2, None), (None, "b c d"), (3, ""), (10, "A-b.C")], "item_id long, text string")


def by_id(df, name="doc_id"):
    out = {}
    for r in df.collect():
        out.setdefault(r[name], []).append(r)
    return out


def test_secrets(docs, empty):
    rows = by_id(secrets.scan(docs))
    assert sum(map(len, rows.values())) == docs.count() and len(rows[4]) == 4 and len(rows[None]) == 1
    assert [tuple(s) for s in rows[7][0]["assign"]] == [(14, 30)]
    assert all(not rows[i][0][k] for i in (0, 1, 2, 3) for k in secrets.KINDS)
    assert secrets.scan(empty).count() == 0


def test_simhash(docs, empty):
    rows = by_id(simhash.near_duplicates(docs))
    assert sum(map(len, rows.values())) == docs.count()
    assert rows[0][0]["fp"] == 0 and {rows[i][0]["component_id"] for i in (0, 1, 2)} == {0}
    assert {r["component_id"] for r in rows[5]} == {4}
    assert rows[None][0]["component_id"] is None or rows[None][0]["component_id"] >= 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("text = 'a b c d e f g'").count() == 1
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_decontaminate(docs, empty, benchmark):
    found = by_id(decontaminate.scan(docs, benchmark, ["doc_id", "hit_spans"]).withColumn("n_hit", decontaminate.n_hit()))
    assert found[0][0]["n_words"] == 0 and found[3][0]["n_hit"] == 1 and found[3][0]["hit_items"] == [1]
    assert found[4][0]["n_hit"] == 4 and found[4][0]["hit_items"] == [1, 10] and found[4][0]["_kept_hit_spans"] == "h"
    clean = decontaminate.remove_documents(docs, benchmark)
    assert clean.columns == docs.columns and not clean.where("text = 'one'").count() and clean.where("doc_id is null").count() == 1
    cut = by_id(decontaminate.remove_spans(docs, benchmark))
    assert cut[3][0]["text"] == "" and cut[4][0]["text"] == " e f g" and cut[0][0]["text"] is None
    nothing = benchmark.where("false")
    assert decontaminate.remove_documents(docs, nothing).count() == docs.count()
    assert decontaminate.scan(empty, benchmark, ["doc_id"]).count() == 0
    again = decontaminate.scan(docs, benchmark, ["doc_id"], block_bytes=70).collect()
    assert sorted(again, key=str) == sorted(decontaminate.scan(docs, benchmark, ["doc_id"]).collect(), key=str)


def test_classifiers(docs, empty, labels):
    for found in (quality.score(docs, labels, ["doc_id"]), toxicity.score(docs, labels)):
        rows = found.collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(empty, labels, ["doc_id"]).count() == 0 and toxicity.score(empty, labels).count() == 0
    none = labels.where("false")
    assert {r["score"] for r in quality.score(docs, none, ["doc_id"]).collect()} == {0.5}
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.5}
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns


def test_topk(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [0.5, 0.5]), (1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0]), (8, []), (9, [1e15, 0.0])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, q string, id int")
    found = by_id(topk.top_k(table, F.col("id") % 50 == 0), "query_id")
    assert [(r["rank"], r["vec_id"]) for r in sorted(found[0], key=lambda r: r["rank"])] == [(1, 9), (2, 1), (3, 7), (4, 50)]
    assert sorted(r["vec_id"] for r in found[50]) == [0, 1, 7, 9] and set(found) == {0, 50}
    assert topk.top_k(table.where("false"), F.col("id") % 50 == 0).count() == 0


def test_tokens(docs, empty):
    path = encoding.default_path()
    cache = common.new_path(docs.sparkSession, "cache")
    rows = by_id(token_counts.count_tokens(docs, path, cache))
    assert sum(map(len, rows.values())) == docs.count() and rows[0][0]["n_tokens"] == 0 and rows[1][0]["n_bytes"] == 0 and rows[6][0]["over_limit"]
    stored = docs.sparkSession.read.parquet(cache).count()
    again = by_id(token_counts.count_tokens(docs, path, cache))
    assert again == rows and docs.sparkSession.read.parquet(cache).count() == stored  # all hits
    assert token_counts.count_tokens(empty, path, cache).count() == 0


def test_packing(docs, empty):
    rows = packing.pack_documents(docs, encoding.default_path()).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    assert sum(r["doc_id"] == 4 for r in rows) == 4 and [r["length"] for r in rows if r["doc_id"] == 0] == [1]
    assert packing.pack_documents(empty, encoding.default_path()).count() == 0


def test_pii(docs, empty):
    new = pii.surrogates(docs)
    assert new.columns == docs.columns and new.count() == docs.count()
    text = new.where("doc_id = 7").first()
    assert "555-3436" not in text["text"] and text["text"].startswith("Mr ") and text["_text"] == "t"
    assert new.where("doc_id = 0").first()["text"] is None and new.where("doc_id = 6").first()["text"] == LONG
    assert pii.surrogates(empty).count() == 0


def test_licenses(docs, empty):
    rows = by_id(licenses.scan(docs))
    assert rows[9][0]["licences"] == ["MIT"] and rows[0][0]["known"] == [] and len(rows[4]) == 4
    assert licenses.scan(empty).count() == 0
