"""The recurrent network against finite differences and a plain recurrence; languages of
held-out texts."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitelattice.llm import languages, queries

SF = "/root/testdata/sf0.01"


def small(seed=0, count=3, units=4):
    rng = np.random.default_rng(seed)
    net = languages.Network(count, units=units, seed=seed)
    net.p = {k: v.astype(np.float64) + rng.normal(0, 0.2, v.shape) for k, v in net.p.items()}
    segments = rng.integers(0, 5, (7, 6)).astype(np.int16)
    segments[2, 4:] = segments[5, 1:] = 256
    return net, segments, rng.integers(0, count, 7), rng


def plain_states(net, row):
    """One segment's states, number by number."""
    squash = lambda v: v / (1 + abs(v))
    u, symbols = net.units, [int(s) for s in row if s != 256]
    out = [[None, None] for _ in symbols]
    for d in (0, 1):
        table, inner, rest = net.p["table"][d], net.p["inner"][d], net.p["rest"][d]
        h = [0.0] * u
        for t in range(len(symbols)) if d == 0 else reversed(range(len(symbols))):
            a = [sum(inner[k][j] * h[j] for j in range(u)) for k in range(3 * u)]
            x = [table[k][symbols[t]] for k in range(3 * u)]
            z = [(squash(a[k] + x[k]) + 1) / 2 for k in range(u)]
            r = [(squash(a[u + k] + x[u + k]) + 1) / 2 for k in range(u)]
            n = [squash(r[k] * (a[2 * u + k] + rest[k][0]) + x[2 * u + k]) for k in range(u)]
            h = [(1 - z[k]) * n[k] + z[k] * h[k] for k in range(u)]
            out[t][d] = h
    return out


def test_states_and_sums_are_the_plain_ones():
    net, segments, _, _ = small()
    states, sums = net.states(segments), net.sums(segments)
    for s, row in enumerate(segments):
        want = plain_states(net, row)
        total = np.zeros(3)
        for t, both in enumerate(want):
            assert np.allclose(states[t, :, :, s], both)
            y = np.exp(net.p["out"] @ np.concatenate(both) + net.p["base"][:, 0])
            total += y / y.sum()
        assert np.allclose(sums[s], total, atol=1e-5)


def test_gradient_is_the_finite_difference():
    net, segments, wanted, rng = small(1)
    _, grad = net.loss(segments, wanted)
    for name, value in net.p.items():
        for _ in range(15):
            at = tuple(int(rng.integers(0, n)) for n in value.shape)
            at = (*at[:2], int(rng.integers(0, 5))) if name == "table" else at
            was, step = value[at], 1e-5
            value[at] = was + step
            up = net.loss(segments, wanted)[0]
            value[at] = was - step
            down = net.loss(segments, wanted)[0]
            value[at] = was
            assert math.isclose((up - down) / (2 * step), grad[name][at], rel_tol=1e-4, abs_tol=1e-8), (name, at)


def test_every_byte_of_a_long_text_counts_once_whatever_the_batch():
    net, *_ = small(2)
    model = languages.Model([])
    model.languages, model.network = ["a", "b", "c"], net
    texts = ["".join(chr(97 + (i * 7 + k) % 26) for k in range(n)).encode() for i, n in enumerate([0, 1, 63, 64, 65, 1000, 5, 12_345])] + [None]
    whole = model.probabilities(texts)
    assert np.allclose(whole.sum(axis=1), [float(bool(t)) for t in texts])
    for batch in (1, 3, 50):
        assert np.allclose(model.probabilities(texts, batch=batch), whole, atol=1e-6)


@pytest.fixture(scope="module")
def found(spark):
    rows = queries.QUERIES["op13_language_id"](spark, SF).collect()
    return {r["doc_id"]: r for r in rows}


def test_held_out_documents(spark, found):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").collect()
    assert len(docs) == len(found)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for i, r in found.items())
    held = [d for d in docs if found[d["doc_id"]]["held_out"]]
    right = sum(found[d["doc_id"]]["lang_pred"] == d["lang"] for d in held)
    assert len(held) > 200 and right / len(held) > 0.98


SCHEMA = "doc_id long, text string, lang string, lang_pred string, lang_score double, share double, place int, score double"


def test_edges(spark):
    model = languages.Model([(b"uno dos tres cuatro cinco" * 9, "es"), ("eins zwei drei vier fünf".encode() * 9, "de")])
    rows = [(0, None), (1, ""), (2, "12 345 !?\n"), (3, "x"), (3, "x"), (None, "uno dos tres"), (4, "eins zwei " * 20_000), (5, "日本語"), (6, "x" * 100_000)]
    docs = spark.createDataFrame([(i, t, "es", "p", 0.5, 0.1, 1, 0.0) for i, t in rows], SCHEMA)
    got = languages.identify(docs, ["doc_id", "score", "place"], model=model)
    assert got.columns == ["doc_id", "score", "place", "lang_pred", "lang_score"]
    by = {}
    for r in got.collect():
        by.setdefault(r["doc_id"], []).append((r["lang_pred"], r["lang_score"]))
    assert by[0] == by[1] == by[2] == [("und", 0.0)] and len(by[3]) == 2 and by[3][0] == by[3][1]
    assert by[4][0][0] == "de" and by[None][0][0] == "es" and all(v[0][0] in ("de", "es") for k, v in by.items() if k in (3, 5, 6))
    assert languages.identify(docs.where("false"), ["doc_id"]).count() == 0
    none = languages.identify(docs.withColumn("lang", F.lit(None).cast("string")), ["doc_id"])
    assert {(r["lang_pred"], r["lang_score"]) for r in none.collect()} == {("und", 0.0)}
    one = {r["doc_id"]: r for r in languages.identify(docs, ["doc_id"]).collect()}
    assert one[4]["lang_pred"] == "es" and one[4]["lang_score"] == 1.0 and one[2]["lang_pred"] == "und"


def test_sample_is_balanced_bounded_and_outside_the_fold(spark):
    rows = [(i, f"text {i}", "en" if i % 10 else "fr") for i in range(3000)] + [(1, "text 1", "en")] * 500 + [(i, None, "de") for i in range(5)] + [(None, "t", "es"), (9, "t", None)]
    got = languages.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most=200).collect()
    assert [sum(r["lang"] == v for r in got) for v in ("en", "fr", "de", "es")] == [100, 100, 0, 0]
    assert all(zlib.crc32(r["text"][5:].encode()) % 4 != 2 for r in got) and len({r["text"] for r in got}) == 200
