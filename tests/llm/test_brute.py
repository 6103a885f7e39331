"""Queries against plain versions, round trips and held-out accuracy."""

import hashlib
import random
import re
import textwrap
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sitelattice.llm import common, decontaminate, encoding, licenses, packing, pii, queries, secrets, simhash, topk, toxicity

SF = "/root/testdata/sf0.001"
BIG = "/root/testdata/sf0.01"
KEY = "key of the tests"


@pytest.fixture(autouse=True, scope="module")
def surrogate_key(spark):
    spark.conf.set(pii.KEY_SETTING, KEY)
    yield
    spark.conf.unset(pii.KEY_SETTING)


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in df.collect())
    result = con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    want = sorted(tuple(r[names.index(c)] for c in cols) for r in result.fetchall())
    assert got == want


KINDS = (
    ("assign", re.compile(r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile("[0-9a-f]+"), 0, 32),
)


def plain_secrets(text):
    found = [(m.start(), k, m.end()) for k, (_, rx, group, least) in enumerate(KINDS) for m in rx.finditer(text or "") if len(m[group]) >= least]
    return ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in sorted(found)), [sum(f[1] == k for f in found) for k in range(3)]


def test_secrets_base(spark):
    rng = random.Random(5)
    parts = ["password", "PassWD", "api_key", "apikey", "token", " ", "  ", ":", "=", '"', "'", "abcdefgh", "x", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", "\U0001f600", ".", "-"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)] + ["token=secret: abcdefghij", None]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    for r in secrets.scan(docs).select("doc_id", secrets.joined(secrets.KINDS[:3]).alias("s"), *[F.size(k).alias(k) for k in secrets.KINDS[:3]]).collect():
        spans, counts = plain_secrets(made[r["doc_id"]])
        assert (r["s"], [r[k] for k in secrets.KINDS[:3]]) == (spans, counts), made[r["doc_id"]]


def test_secrets_query(spark, texts):
    for r in queries.QUERIES["op1_secret_scan"](spark, SF).collect():
        spans, counts = plain_secrets(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest() and [r["n_assign"], r["n_access"], r["n_hex"]] == counts


def test_secrets_battery(spark):
    rng = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    made = ["k " + "".join(rng.choice(alphabet) for _ in range(n)) + " e" for n in (24, 40, 64, 100) for _ in range(25)]
    plain = ["thequickbrownfoxjumpsoverthelazydogandthenrunsaway", "a_very_long_identifier_name_for_some_function_in_code", "abcdefghijklmnopqrstuvwxyz0123456789", "1234567890123456789012345", "----------------------------"]
    docs = spark.createDataFrame(list(enumerate(made + plain * 20)), "doc_id long, text string")
    rows = {r["doc_id"]: r["random"] for r in secrets.scan(docs).collect()}
    assert sum(bool(rows[i]) for i in range(100)) >= 97 and not any(rows[i] for i in range(100, len(rows)))
    assert all([tuple(s) for s in rows[i]] in ([], [(2, len(made[i]) - 2)]) for i in range(100))


def test_secrets_battery_after_equals_sign(spark):
    rng = random.Random(6)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    heads = ["AWS_SECRET_ACCESS_KEY=", "GET /blob?sig=", "x=1&signature_of_the_request=", "export DB_PASS_PHRASE=="]
    values = ["".join(rng.choice(alphabet) for _ in range(40)) + "=" * (i % 3) for i in range(100)]
    made = [heads[i % 4] + v + " e" for i, v in enumerate(values)]
    plain = ["path=thequickbrownfoxjumpsoverthelazydogandthenrunsaway", "a_very_long_identifier_name_for_some_function=another_long_identifier_name_in_code"]
    docs = spark.createDataFrame(list(enumerate(made + plain * 50)), "doc_id long, text string")
    rows = {r["doc_id"]: [tuple(s) for s in r["random"]] for r in secrets.scan(docs).collect()}
    assert sum(bool(rows[i]) for i in range(100)) >= 97 and not any(rows[i] for i in range(100, len(rows)))
    assert all(rows[i] in ([], [(len(heads[i % 4]), len(made[i]) - 2)]) for i in range(100))


WORDS = "get set user name value list table index count read write file path open close the of and in result error value default config server client update delete insert stream buffer parse token state handler manager service".split()
ENCODINGS = {
    "hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}


def test_secrets_recall_and_false_discoveries(spark):
    """Random keys of every encoding at 20 to 128 characters among ordinary names and paths."""
    rng = random.Random(21)
    keys = [(e, n, "k " + "".join(rng.choice(a) for _ in range(n)) + " e") for e, a in ENCODINGS.items() for n in (20, 24, 31, 48, 64, 128) if (e, n > 31) != ("hex", True) for _ in range(40)]

    def name(i):
        parts = [rng.choice(WORDS) for _ in range(rng.randint(4, 14))]
        text = ["_".join(parts), "-".join(parts), "/".join(parts), parts[0] + "".join(p.capitalize() for p in parts[1:]), "".join(parts), "_".join(parts).upper()][i % 6]
        return f"see {text}{rng.randint(0, 9999) if i % 4 == 0 else ''} there"

    plain = [name(i) for i in range(6000)]
    docs = spark.createDataFrame(list(enumerate([t for _, _, t in keys] + plain)), "doc_id long, text string")
    rows = {r["doc_id"]: [tuple(s) for s in r["random"]] for r in secrets.scan(docs).collect()}
    caught = Counter((e, n) for i, (e, n, t) in enumerate(keys) if rows[i] == [(2, len(t) - 2)])
    wrong = sum(bool(rows[len(keys) + i]) for i in range(len(plain)))
    assert all(caught[e, n] >= (36 if n == 20 else 38) for e, n, _ in keys) and wrong <= 0.01 * (wrong + sum(caught.values())), (wrong, caught)


def test_secrets_many_matches(spark):
    """A text of very many matches takes n log n steps, and the same places."""
    rng = random.Random(2)
    pieces = [rng.choice(["token=abcdefgh12", "AKIA" + "A" * 14, "".join(rng.choice("0123456789abcdef") for _ in range(33)), "".join(rng.choice(ENCODINGS["base64"]) for _ in range(24)), "é"]) for _ in range(60_000)]
    text = " ".join(pieces)
    r = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).select(secrets.joined(secrets.KINDS[:3]).alias("s"), "random", *[F.size(k).alias(k) for k in secrets.KINDS[:3]]).first()
    spans, counts = plain_secrets(text)
    assert (r["s"], [r[k] for k in secrets.KINDS[:3]]) == (spans, counts)
    taken = [tuple(map(int, x.split(":")[1:])) for x in spans.split(",")]
    ends = np.array([b for _, b in taken])
    for a, b in r["random"]:
        i = int(np.searchsorted(ends, a, side="right"))
        assert i == len(taken) or taken[i][0] >= b


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    counts = Counter(i for s in shingles for h in [xxhash.xxh64_intdigest(s.encode(), 42)] for i in range(64) if h >> i & 1)
    return sum(1 << i for i in counts if 2 * counts[i] > len(shingles))


def plain_components(fps, radius=4):
    label = {i: i for i in range(len(fps))}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    a = np.array(fps, dtype=np.uint64)
    for i in range(len(fps)):
        for j in (i + 1 + np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= radius)).tolist():
            x, y = root(i), root(j)
            label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(fps))]


def test_simhash_query(spark, texts):
    rows = queries.QUERIES["op2_simhash_near_dedup"](spark, SF).collect()
    ids = sorted(texts)
    fps = [plain_fingerprint(texts[i]) for i in ids]
    want = {i: (f"{f:016x}", ids[c]) for i, f, c in zip(ids, fps, plain_components(fps), strict=True)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == want


@pytest.mark.parametrize("large", [4096, 8])
def test_simhash_links_near_groups(spark, large):
    """Chains and dense groups of near fingerprints, also with crowded keys dealt on."""
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
    for _ in range(8):
        f = rng.getrandbits(64)
        for _ in range(60):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
            fps.add(f)
        fps |= {f ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(12)}
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), large=large).distinct().collect()
    place = {s[0]: i for i, s in enumerate(signed)}
    label = list(range(len(fps)))
    for _ in range(len(fps)):
        changed = False
        for e in edges:
            m = min(label[place[e["a"]]], label[place[e["b"]]])
            for x in (place[e["a"]], place[e["b"]]):
                changed |= label[x] != m
                label[x] = m
        if not changed:
            break
    assert label == plain_components(fps)
    assert all(bin(fps[place[e["a"]]] ^ fps[place[e["b"]]]).count("1") <= 4 for e in edges)


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)] + [(7, 7)]
    found = {r["node"]: r["component"] for r in common.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            label[max(x, y)] = min(x, y)
    assert found == {x: root(x) for x in label}


def test_decontamination_plain(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("alpha beta gamma delta é x1".split())
    items = [(i % 12, " ".join(word() for _ in range(rng.choice([1, 3, 14, 20])))) for i in range(15)]
    docs = [(i, " ".join([*(word() for _ in range(rng.randint(0, 30))), *(rng.choice(items)[1].upper().split() if i % 3 == 0 else []), *(word() for _ in range(5))])) for i in range(60)]

    def plain(text):
        w = [x.decode() for x in decontaminate.words(text)]
        hit, found = set(), set()
        for item, t in items:
            v = [x.decode() for x in decontaminate.words(t)]
            n = min(13, len(v))
            for i in range(len(v) - n + 1):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[i : i + n]:
                        hit.update(range(p, p + n))
                        found.add(item)
        return len(w), len(hit), sorted(found)

    docs_, items_ = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {i: plain(t) for i, t in docs}
    for bounds in ({}, {"block_windows": 60}, {"block_bytes": 60}):
        rows = decontaminate.scan(docs_, items_, ["doc_id"], **bounds).withColumn("n", decontaminate.n_hit()).collect()
        assert {r["doc_id"]: (r["n_words"], r["n"], r["hit_items"]) for r in rows} == want
        assert all(a["stop"] < b["start"] for r in rows for a, b in zip(r["hit_spans"], r["hit_spans"][1:], strict=False))
    assert sum(1 for _ in decontaminate.benchmark_blocks(items_, block_windows=60)) > 5


def test_decontamination_long_items():
    """Parts of a long item have its windows and no others; equal hashes are told apart."""
    rng = random.Random(7)
    w = [rng.choice("abcdefgh") for _ in range(500)]
    windows = lambda v: {tuple(v[i : i + 13]) for i in range(len(v) - 12)}
    for most in (1, 7, 100, 487, 488, 1000):
        parts = [t.split() for _, t in decontaminate.item_parts(1, " ".join(w), 13, most)]
        assert set().union(*map(windows, parts)) == windows(w) and all(len(p) < most + 13 or len(parts) == 1 for p in parts)
    found = decontaminate.Windows([(1, "a b"), (2, "c d")], 2)
    (hashes, owner, place) = found.tables[2]
    found.tables[2] = (np.full(2, hashes[0]), owner, place)
    assert found.scan([[b"a", b"b"]])[0][1] <= {1} and found.scan([[b"c", b"d"]])[0][1] <= {2} and found.scan([[b"a", b"d"], [b"a"], [b"b"]]) == [([], set())] * 3


def test_decontamination_memory():
    """A block's windows take a bounded multiple of its text."""
    import pickle

    rng = random.Random(3)
    text = [(i, " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(3000))) for i in range(100)]
    size = sum(len(t) for _, t in text)
    assert len(pickle.dumps(decontaminate.Windows(text))) < 5 * size


def heldout(spark, name, label):
    found = {r["doc_id"]: r for r in queries.QUERIES[name](spark, BIG.replace("0.01", "0.1")).collect()}
    rows = duckdb.sql(f"select doc_id, {label} from '/root/testdata/sf0.1/labels.parquet'").fetchall()
    pairs = [(found[i]["score"], y, found[i]["predicted"]) for i, y in rows if found[i]["held_out"]]
    good, bad = [s for s, y, _ in pairs if y], [s for s, y, _ in pairs if not y]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    return auc, np.mean([p == y for _, y, p in pairs])


def test_quality_plain(spark, texts):
    """Word vectors and scores, word by word."""
    import math

    from sitelattice.llm import quality

    rng = np.random.default_rng(3)
    sequences = [rng.integers(0, 50, rng.integers(0, 30)) for _ in range(12)]
    index, want = quality.index_vectors().astype(float), np.zeros((quality.BUCKETS, quality.DIMENSIONS))
    for ids in sequences:
        for i, w in enumerate(ids):
            for j in range(max(0, i - quality.WINDOW), min(len(ids), i + quality.WINDOW + 1)):
                if i != j:
                    want[w] += index[ids[j]]
    size = np.linalg.norm(want, axis=1, keepdims=True)
    want = index / np.sqrt(8) + np.where(size > 0, want / np.where(size > 0, size, 1), 0)
    assert np.allclose(quality.word_vectors(sequences), want / np.linalg.norm(want, axis=1, keepdims=True), atol=1e-5)
    vectors, network = quality.fit(common.table(spark, SF, "documents"), common.table(spark, SF, "labels"))
    for r in queries.QUERIES["op5_quality_classifier"](spark, SF).collect():
        words = re.findall(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+", (texts[r["doc_id"]] or "").encode())
        ids = [2 + zlib.crc32(w) % (quality.BUCKETS - 2) for w in words]
        n = max(1, len(ids))
        mean = sum((vectors[i].astype(float) for i in ids), np.zeros(quality.DIMENSIONS)) / n
        capitals = sum(w.isupper() for w in words) / n
        again = sum((ids[i] == ids[i - 1]) + (i > 1 and ids[i] == ids[i - 2]) for i in range(1, len(ids))) / n
        x = [*(mean + capitals * vectors[0] + again * vectors[1]), capitals, again, math.sqrt(sum(v * v for v in mean))]
        z = [min(4, max(-4, (v - m) / d)) for v, m, d in zip(x, network.mean, network.scale, strict=True)]
        h = [math.tanh(sum(v * w for v, w in zip(z, column, strict=True)) + b) for column, b in zip(network.p[0].T, network.p[1], strict=True)]
        logit = sum(v * w for v, w in zip(h, network.p[2], strict=True)) + network.p[3][0]
        assert abs(r["score"] - 1 / (1 + math.exp(-logit / network.temperature))) < 1e-4
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= 0.7)


def test_toxicity_plain(spark, texts):
    """Hits by distances to every term, and the score from them."""
    import math

    lexicon, model = toxicity.fit(common.table(spark, SF, "documents"), common.table(spark, SF, "labels"))
    own = lexicon.terms | lexicon.inflected

    def last_row(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row

    def find(w):
        if w in lexicon.terms:
            return 0, lexicon.terms[w]
        for n in range(1, len(w) + 1):
            if w[:n] in lexicon.stems:
                return 1, lexicon.stems[w[:n]]
        if len(w) < 3 or w in lexicon.clean:
            return None
        edits = lambda t: 0 if len(t) < 4 else 1 if len(t) < 12 else 2
        near = [v for t, v in own.items() if abs(len(t) - len(w)) <= 2 and last_row(t, w)[-1] <= edits(t) and (len(t) >= 6 or w[0] == t[0] or w[0].isdigit())]
        near += [v for t, v in lexicon.stems.items() if len(t) >= 6 and len(w) >= 5 and min(last_row(t, w[: len(t) + 2])) <= edits(t)]
        return (2, max(near)) if near else None

    known = {}
    for r in queries.QUERIES["op10_toxicity"](spark, SF).collect():
        low, out = (texts[r["doc_id"]] or "").lower(), [0.0] * 8
        marks = [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\W_]+", low)]
        for i, (w, start, end) in enumerate(marks):
            hit = known.setdefault(w, find(w)) if w not in known else known[w]
            if hit:
                around = {x for x, _, _ in marks[max(0, i - 6) : i] + marks[i + 1 : i + 7]}
                before, after = low[marks[max(0, i - 6)][1] : start], low[end : marks[min(len(marks) - 1, i + 6)][2]]
                quoted = bool((set(before) & set(toxicity.OPENS) and set(after) & set(toxicity.CLOSES)) or around & toxicity.REPORTS)
                out[2 * hit[0] + quoted] += 1
                out[6] += bool(around & toxicity.ADDRESS)
                out[7] = max(out[7], hit[1] * (0.5 if quoted else 1))
        assert r["n_hits"] == sum(out[:6]), (r, out)
        x = [*(float(v > 0) for v in out[:7]), *(math.log1p(v) for v in out[:7]), out[7], 1.0]
        want = model.share if model.constant else 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.w, strict=True))))
        assert abs(r["score"] - want) < 1e-9
    assert any(known.values())


def test_quality_heldout(spark):
    auc, accuracy = heldout(spark, "op5_quality_classifier", "quality")
    assert auc > 0.97 and accuracy > 0.97


def test_toxicity_heldout(spark):
    auc, accuracy = heldout(spark, "op10_toxicity", "toxic")
    assert auc > 0.93 and accuracy > 0.97


def test_levenshtein_automaton():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row[-1]

    rng = random.Random(1)
    terms = {"".join(rng.choice("abc") for _ in range(rng.randint(3, 14))): 1.0 for _ in range(60)}
    lexicon = toxicity.Lexicon(terms, {})
    for _ in range(400):
        w = "".join(rng.choice("abc") for _ in range(rng.randint(1, 15)))
        want = {t for t in terms if distance(w, t) <= lexicon.edits(len(t))}
        assert set(lexicon.intersect(w)) == want
        if any(t for t in want if len(t) >= toxicity.FUZZY_FROM) and w not in terms:
            assert lexicon.find(w) is not None


def test_toxicity_misspelled_and_quoted():
    lexicon = toxicity.Lexicon({"worthless": 5.0, "clown": 5.0}, {"lostra": 4.0})
    exact, fuzzy, stem, quoted = (toxicity.hits(lexicon, t) for t in ("you are worthless", "you are wortless", "so lostraeu", 'he said "you clown" loudly'))
    assert exact[0] == 1 and exact[6] == 1 and fuzzy[4] == 1 and stem[2] == 1 and quoted[1] == 1 and quoted[0] == 0
    assert not toxicity.hits(lexicon, "nothing of that kind").any()


def test_toxicity_short_terms_and_stems_misspelled():
    lexicon = toxicity.Lexicon({"clown": 5.0, "idiot": 5.0, "loser": 5.0}, {"lostra": 4.0, "brak": 4.0}, {"brakomi": 4.5}, {"lower"})
    for w in ("cl0wn", "idiott", "1diot", "losr", "lstraeu", "lozstraeu", "l0strauma", "bralomi"):
        assert toxicity.hits(lexicon, f"you {w} there")[4] == 1, w
    assert toxicity.hits(lexicon, "lostraeu")[2] == 1 and toxicity.hits(lexicon, "brakomi")[2] == 1
    assert not toxicity.hits(lexicon, "the lower closer brown frown last strata").any()
    learned = toxicity.learn_lexicon([f"{a} clown {b}" for a in "abcdefghij" for b in "klmnopqrst"] + [f"{a} crown {b}" for a in "abcdefghij" for b in "klmnopqrst"], np.array([1] * 100 + [0] * 100))
    assert "clown" in learned.terms and learned.find("cl0wn")[0] == 2 and learned.find("crown") is None


def plain_topk(q, own, x, ids, k):
    clip = lambda v: max(-(1 << 63), min((1 << 63) - 1, v))
    return [sorted((-clip(sum(int(a) * int(b) for a, b in zip(r, v, strict=True))), int(i)) for v, i in zip(x, ids, strict=True) if i != o)[:k] for r, o in zip(q, own, strict=True)]


def test_topk_search():
    """Blocks in any order against plain scoring; ties, equal vectors, large numbers."""
    rng = np.random.default_rng(0)
    for n, d in ((1, 8), (3, 8), (5, 1), (6, 8), (40, 0), (900, 8)):
        for scale in (3, 1000, 10**9, 1 << 62):
            x, q = rng.integers(-scale, scale, (n, d)), rng.integers(-scale, scale, (12, d))
            if scale == 1000 and d == 8:
                x[::2, 0] *= 50
                q[:, 0] *= 20
                x[n // 2 :] = x[0]
            ids, own = np.arange(n) * 3, rng.integers(0, 3 * n, 12)
            search = topk.Search(q, own, 5)
            for part in np.array_split(rng.permutation(n), 3):
                search.add(x[part], ids[part])
            rows, found, score = search.results()
            for r, want in enumerate(plain_topk(q, own, x, ids, 5)):
                assert [(-int(s), int(i)) for s, i in zip(score[rows == r], found[rows == r], strict=True)] == want


def test_topk_stops_early():
    """On the test table every query stops before the ends of the lists."""
    rows = duckdb.sql("select vec_id, embedding from '/root/testdata/sf0.1/embeddings.parquet'").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.floor(256 * np.array([r[1] for r in rows], dtype=float)).astype(np.int64)
    at = np.flatnonzero(ids % 50 == 0)
    search = topk.Search(x[at], ids[at], 5)
    search.add(x, ids)
    share = search.read / search.entries
    assert share.max() < 1 and share.mean() < 0.9, (share.max(), share.mean())


def test_topk_query_blocks(spark):
    """Many blocks of queries, vectors of two lengths, an id with two vectors, equal rows."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6 if i % 3 else 4).tolist()) for i in range(300)] + [(10, [1.0] * 6), (10, [1.0] * 6), (20, None), (None, [1.0] * 4), (30, [float("nan")] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    one, many = (sorted(map(tuple, topk.top_k(df, F.col("id") % 10 == 0, query_bytes=size).collect())) for size in (1 << 20, 300))
    fine = sorted({(i, tuple(int(np.floor(256 * c)) for c in v)) for i, v in rows if i is not None and v is not None and np.isfinite(v).all()})
    want = []
    for i, v in fine:
        if i % 10 == 0:
            same = [(j, w) for j, w in fine if len(w) == len(v)]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(plain_topk([v], [i], [w for _, w in same], [j for j, _ in same], 5)[0])]
    assert one == many == sorted(want)


def test_topk_many_equal(spark):
    rows = [(i, [0.5, 0.25]) for i in range(5000)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") == 50).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [0, 1, 2, 3, 4]


def library_ids(text):
    return encoding.encoder(encoding.default_path())._slow(text or "").tolist()


def test_encoder_agrees_with_library():
    encoder = encoding.encoder(encoding.default_path())
    for t in ["hello <|endoftext|> wörld", "日本語 text", " " * 5000, "a" * 30_000, "x\n\n y\t'll don't 12345 ½ ²", "“q” – €5…", "É ſ ǅ ʼ́", "​  ", "<|endoftext|><|endoftext|>"]:
        assert encoder.ids(t).tolist() == library_ids(t)


def test_encoder_agrees_on_all_pairs():
    """The characters that the fast path takes: each, all pairs, and runs of all classes."""
    encoder = encoding.encoder(encoding.default_path())
    own = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not encoding._OTHER.search(chr(c))]
    assert 600 < len(own) < 800
    rng = random.Random(17)
    # A class each of white space, marks, digits, letters and signs, and what the pattern names.
    few = [" ", "\n", "\r", "\t", "\u00a0", "\u2028", "'", "s", "S", "l", "é", "ǅ", "1", "²", "½", "_", ".", "\u00ad", "\x00", "\x85", "–", "€", "<", "|", ">"]
    made = own + [a + b for a in own for b in own] + [a + b + c for a in few for b in few for c in few]
    made += ["".join(rng.choice(few if rng.random() < 0.7 else own) for _ in range(rng.randint(4, 30))) for _ in range(20_000)]
    for i in range(0, len(made), 50_000):
        part = made[i : i + 50_000]
        want = [e.ids for e in encoder.library.encode_batch_fast(part, add_special_tokens=False)]
        assert [encoder.ids(t).tolist() for t in part] == want


def test_token_counts_query(spark, texts):
    for r in queries.QUERIES["op8_token_counts"](spark, SF).collect():
        t = texts[r["doc_id"]]
        n = len(library_ids(t))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 512)


def test_packing_query(spark, texts):
    rows = queries.QUERIES["op7_best_fit_packing"](spark, SF).collect()
    docs, bins = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append(r)
    for i, t in texts.items():
        ids, at = [*library_ids(t), 2], 0
        for k, r in enumerate(sorted(docs[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at) and (k == 0 or r["length"] == 1024)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for b in bins.values():
        at = 0
        for r in sorted(b, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    least = -(-sum(r["length"] for r in rows) // 1024)
    assert len(bins) <= least * 1.02 + 2


def test_packing_repeated_rows(spark):
    """Rows that repeat are dealt to all buckets, and packed each."""
    docs = spark.createDataFrame([(1, "same text")] * 4000 + [(None, None)] * 1000, "doc_id long, text string").repartition(3)
    pieces = packing.tokenized_pieces(docs, encoding.default_path())
    rows = packing.pack(pieces).collect()
    assert len(rows) == 5000 == len({(r["sequence_id"], r["offset"]) for r in rows})
    place = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(4))
    shares = [r["count"] for r in pieces.groupBy(place.alias("b")).count().collect()]
    assert len(shares) == 4 and max(shares) < 2000


def test_join_unique(spark):
    left = spark.createDataFrame([(7, i) for i in range(3000)] + [(i % 50, i) for i in range(500)] + [(None, 1), (99, 1)], "k long, v long").repartition(3)
    right = spark.createDataFrame([(i, f"n{i}") for i in range(60)], "k long, name string")
    want = sorted(map(tuple, left.join(right, "k").collect()))
    assert sorted(map(tuple, common.join_unique(left, right, "k", least=10).select("k", "v", "name").collect())) == want
    assert sorted(map(tuple, common.join_unique(left, right, "k", least=10_000).select("k", "v", "name").collect())) == want


def test_sample_of_repeated_ids(spark):
    """An id that very many rows repeat gives one row to the sample."""
    from sitelattice.llm import quality

    docs = spark.createDataFrame([(1, f"t{i % 3}") for i in range(2000)] + [(i, "x") for i in range(2, 40)] + [(5, None)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    sample = quality.labelled_sample(docs, labels, "quality", 4, 2, 20).collect()
    assert len(sample) == len({r["id"] for r in sample}) <= 20


def test_packing_plans():
    rng = random.Random(1)
    cases = [{}, {1024: 5}, {1: 3000}, {600: 10, 500: 3}, {1: 1, 1024: 1, 512: 2}]
    cases += [dict(Counter(rng.randint(*r) for _ in range(n))) for n in (10, 500, 5000) for r in ((1, 1024), (300, 600), (1, 60))]
    for h in cases:
        plan = packing.Plan(h)
        bins, placed = {}, Counter()
        for length, rank, n, base, per, offset in plan.placements:
            assert rank == placed[length]
            for i in range(n):
                bins.setdefault(base + i // per, []).append((offset + i % per * length, length))
            placed[length] += n
        assert placed == Counter(h) and set(bins) == set(range(plan.bins))
        for b in bins.values():
            at = 0
            for o, n in sorted(b):
                assert o == at
                at += n
            assert at <= 1024


def test_pii_surrogates(spark):
    made = [
        "Mr John Smith met Mrs. Jane Smith and Mr Smith. Mail john.s@corp.example.org or JOHN.S@corp.example.org",
        "Call +1 (974) 555-3436; card 4111 1111 1111 1111, 4111-1111-1111-1111.",
        "Госпожа Анна Иванова, ip 10.0.0.1 ssn 123-45-6789 iban DE89 3704 0044 0532 0130 00",
        "plain 3.14 and 2020-01-01, v1.2.3.4.5, nothing",
    ]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    a, b, c, d = [r["text"] for r in pii.surrogates(docs).orderBy("doc_id").collect()]
    assert d == made[3]
    names = re.match(r"Mr (\S+) (\S+) met Mrs\. (\S+) (\S+) and Mr (\S+)\.", a)
    assert names and names[2] == names[4] == names[5] and not names[1].endswith("a") and names[3].endswith("a")
    mails = re.findall(r"[\w.]+@[\w.]+\.org", a)
    assert len(mails) == 2 and mails[0].lower() == mails[1].lower() and "corp" not in a
    cards = re.findall(r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}", b)
    digits = [int(x) for x in re.sub(r"\D", "", cards[0])][::-1]
    assert cards[0].replace(" ", "") == cards[1].replace("-", "") and (sum(digits[::2]) + sum(sum(divmod(2 * x, 10)) for x in digits[1::2])) % 10 == 0
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", b) and "555-3436" not in b
    assert re.match(r"Госпожа [А-Яа-я]+ [А-Яа-я]+, ip \d+\.\d+\.\d+\.\d+ ssn \d{3}-\d{2}-\d{4} iban DE\d\d", c) and "Иванова" not in c


def test_pii_distinct(spark):
    """Many names over a small pool: surrogates stay one to one."""
    names = ["".join(p) for p in zip("BCDFGHJKLMNPRSTVWZ" * 4, ["aba", "ebe", "ibi", "obo"] * 18, strict=True)]
    docs = spark.createDataFrame([(i, f"Mr {n} Smith") for i, n in enumerate(dict.fromkeys(names))], "doc_id long, text string")
    new = [r["text"].split(" ")[1] for r in pii.surrogates(docs).orderBy("doc_id").collect()]
    assert len(set(new)) == len(new) == len(set(names)) > 24


def test_pii_full_shapes(spark):
    """Shapes whose values are (nearly) all entities of the corpus: the rest widen."""
    phones = [f"+123{i}" for i in range(10)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.de" for a in letters for b in letters][:500]
    docs = spark.createDataFrame([(i, f"to {e} now") for i, e in enumerate(phones + mails)], "doc_id long, text string")
    new = [r["text"].split(" ")[1] for r in pii.surrogates(docs).orderBy("doc_id").collect()]
    assert len(set(new)) == len(new) == 510 and not set(new) & {*phones, *mails}
    assert all(re.fullmatch(r"\+[0-9]{4,}", p) for p in new[:10]) and all(re.fullmatch(r"[a-z]+@[a-z]\.de", m) for m in new[10:])


def plain_shaped(kind, s, attempt=0, key=KEY):
    """One number or address, place by place: the permutation in plain Python."""
    more = max(0, attempt - pii.SAME_SHAPE)
    sep = lambda c: c in " ().-\t\n"
    tail = m[0] if (m := re.search(r"\.[^\W\d_]+$", s)) else ""
    longer = s + "0" * more
    compact = s if kind in ("email", "ip") else "".join(c for c in longer if not sep(c)).upper()
    codes = {"1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", *(str(i) for i in (*range(51, 59), *range(60, 67), 81, 82, 84, 86, *range(90, 96), 98))}
    fixed = ""
    if kind == "phone" and compact[0] == "+":
        fixed = next(("+" + compact[1 : 1 + n] for n in (1, 2) if compact[1 : 1 + n] in codes), compact[:4] if len(compact) > 4 or compact[1:4].isdigit() else "")
    if kind == "iban":
        fixed = compact[:2]
    if kind == "email":
        fixed = tail.lower()
    body = {"email": "a" * more + s[: len(s) - len(tail)], "account": compact[:-1], "iban": compact[4:], "phone": compact[len(fixed) :]}.get(kind, compact)
    pieces = s.split(".") if kind == "ip" else list(body)
    cells = []
    for c in pieces:
        alphabet = next((a for a in ("0123456789", *pii.LETTERS.values()) if c.lower() in a), None)
        if kind == "ip":
            cells.append((int(c) - 1, 254, None) if 1 <= int(c) <= 254 else (0, 1, None))
        else:
            cells.append((alphabet.index(c.lower()), len(alphabet), alphabet) if alphabet else (0, 1, None))
    v, r = [c[0] for c in cells], [c[1] for c in cells]
    tweak = "\x1f".join([key, kind, str(attempt), fixed, ""])

    def number(d, i):
        at = i * 7 % 61
        return (int(d[at : at + 4], 16) + i // 61 * 7919) % 65536

    def turn(even, name, sign):
        d = hashlib.sha256("\x1f".join([tweak, name, ",".join("" if (i % 2 == 0) == even else str(x) for i, x in enumerate(v))]).encode()).hexdigest()
        for i in range(len(v)):
            if (i % 2 == 0) == even:
                v[i] = (v[i] + sign * number(d, i)) % r[i]

    if any(x > 1 for x in r):
        at = next(i for i, x in enumerate(r) if x > 1)
        start = at % 2 == 0
        turn(start, "one", 1)
        turn(not start, "two", 1)
        v[at] = (v[at] + 1 + number(hashlib.sha256(f"{tweak}\x1fshift".encode()).hexdigest(), 0) % (r[at] - 1)) % r[at]
        turn(not start, "two", -1)
        turn(start, "one", -1)
    made = []
    for c, x, (_, size, alphabet) in zip(pieces, v, cells, strict=True):
        new = c if size == 1 else str(x + 1) if alphabet is None else alphabet[x]
        made.append(new.upper() if c.isupper() else new)
    if kind in ("ip", "email"):
        return ".".join(made) if kind == "ip" else "".join(made) + tail
    luhn = lambda t: sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(t)))
    spell = lambda t: int("".join(str(int(c, 36)) for c in t)) % 97
    new = "".join(made)
    if kind == "account":
        new += str((luhn(re.sub(r"\D", "", s)) - luhn(new + "0")) % 10)
    elif kind == "iban":
        plain = re.sub(r"\s", "", s)
        new = fixed + f"{(spell(plain[4:] + plain[:4]) - spell(new + fixed + '00') - 2) % 97 + 2:02d}" + new
    else:
        new = fixed + new
    at = iter(new)
    return "".join(c if sep(c) else next(at) for c in longer)


def test_pii_permutation_plain(spark):
    rng = random.Random(8)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda n: "".join(rng.choice("abcxyzÄßжЖλ09") for _ in range(n))
    made = [("phone", f"+{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)}") for _ in range(20)] + [("phone", f"+{rng.randint(100, 999)}{digits(8)}") for _ in range(20)]
    made += [("phone", f"({digits(3)}) {digits(3)}-{digits(4)}"), ("ssn", "123-45-6789"), ("ip", "10.0.0.255"), ("ip", "0.255.0.255"), ("email", "a.B+c@Mail-x.example.org")]
    made += [("ip", ".".join(str(rng.randint(0, 255)) for _ in range(4))) for _ in range(20)] + [("email", f"{word(9)}@{word(6)}.com") for _ in range(30)]
    made += [("account", " ".join(digits(4) for _ in range(4))) for _ in range(20)] + [("account", digits(13)), ("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    rows = spark.createDataFrame([(k, s, a) for k, s in made for a in (0, 2, 5)], "kind string, s string, a int")
    for r in rows.withColumn("new", pii.surrogate(F.col("kind"), F.col("s"), F.col("a"), KEY)).collect():
        assert r["new"] == plain_shaped(r["kind"], r["s"], r["a"]), r
        assert r["new"] != r["s"] or r["s"] == "0.255.0.255"
    spell = lambda t: int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97
    assert spell(plain_shaped("iban", "GB82WEST12345698765432")) == 1


def test_pii_plain(spark, texts):
    """The query on the test table: the plain scan finds the same entities, and what replaces
    them is one to one, and what the plain permutation says unless drawn again."""
    import regex

    any_, kinds = regex.compile(pii.ANY), {k: regex.compile(p) for k, p in pii.KINDS.items()}
    kind_of = lambda s: next(k for k, p in kinds.items() if p.fullmatch(s))
    seen, back, again = {}, {}, 0
    for r in queries.QUERIES["op3_pii_surrogates"](spark, SF).collect():
        old = texts[r["doc_id"]]
        found = [m[0] for m in any_.finditer(old)]
        assert r["n_entities"] == len(found) and r["kinds"] == ",".join(sorted({kind_of(f) for f in found}))
        between = regex.split(any_, old)
        at = 0
        for gap, entity in zip(between, [*found, None], strict=True):
            assert r["text"].startswith(gap, at)
            at += len(gap)
            if entity is not None:
                kind = kind_of(entity)
                assert kind != "name"  # the table has none
                new = next(n for n in (plain_shaped(kind, entity, a) for a in range(6)) if r["text"].startswith(n, at))
                again += new != plain_shaped(kind, entity)
                norm = lambda t: re.sub(r"[\s().-]", "", t) if kind in ("iban", "ssn", "account", "phone") else t.lower()  # noqa: B023, E731
                assert seen.setdefault((kind, norm(entity)), norm(new)) == norm(new) and back.setdefault((kind, norm(new)), norm(entity)) == norm(entity)
                at += len(new)
        assert at == len(r["text"])
    assert len(seen) > 10 and again <= 1


def test_pii_very_long(spark):
    """Very long texts that meet the patterns: a bounded part of a domain is a domain."""
    made = ["x a@" + "b." * 200_000 + "de", "x a@" + "bb." * 200_000 + "de y", "a." * 200_000, "+1 212 555 1234 " * 20_000, "a@" * 200_000 + "b.de", "Mr " * 100_000 + "A" * 100_000]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(6)
    rows = {r["doc_id"]: r for r in pii.surrogates(docs, entities_col="kinds").collect()}
    assert len(rows) == 6 and len(rows[3]["kinds"]) == 20_000 and "555 1234" not in rows[3]["text"] and rows[1]["kinds"][0] == "email"


def test_pii_many_given_names(spark):
    """Gender is kept for all of many names, and all stay apart."""
    rng = random.Random(12)
    names = sorted({"".join(rng.choice("bdgklmnrst") + rng.choice("aeiou") for _ in range(4)).capitalize() + rng.choice("nsr") for _ in range(6000)})[:5000]
    made = [f"{'Mr' if i % 2 else 'Mrs'} {n} Smith" for i, n in enumerate(names)]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    new = [r["text"].split(" ")[1] for r in pii.surrogates(docs).orderBy("doc_id").collect()]
    assert len(set(new)) == len(names) == 5000 and not set(new) & set(names)
    ends = {g: tuple(pii.ENDINGS[(g, "latin")]) for g in "mf"}
    assert all(n.endswith(ends["m" if i % 2 else "f"]) and bool(re.search(pii.FEMALE_END, n)) == (i % 2 == 0) for i, n in enumerate(new))


def test_pii_gender_and_coreference(spark):
    made = ["Dr Anna Berg met Frau Anna Berg", "Dr Maria Stein", "Dr Ines Voss met Mrs Ines Voss, Mrs Ines Kahn and Mr Ines Kahn", "Prof Ivo Lind", "Dr Ada Lind"]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    a, b, c, d, e = [re.sub(r"[,.]", "", r["text"]).split() for r in pii.surrogates(docs).orderBy("doc_id").collect()]
    assert a[1:3] == a[5:7] and re.search(pii.FEMALE_END, a[1]) and re.search(pii.FEMALE_END, b[1])
    assert c[1] == c[5] == c[8] != c[12] and c[2] == c[6] and c[9] == c[13] and re.search(pii.FEMALE_END, c[1]) and not re.search(pii.FEMALE_END, c[12])
    assert not re.search(pii.FEMALE_END, d[1]) and re.search(pii.FEMALE_END, e[1]) and d[2] == e[2]


def test_pii_dense_numbers(spark):
    """All values of a short shape, and a text's digest in many copies."""
    made = [f"+1 {i // 100 % 10} {i % 100:02d}" for i in range(1000)]
    docs = spark.createDataFrame([(i, f"to {e} now") for i, e in enumerate(made + made[:1] * 300)], "doc_id long, text string")
    new = [r["text"][3:-4] for r in pii.surrogates(docs).orderBy("doc_id").collect()]
    assert len(set(new)) == 1000 and not set(new) & set(made) and len(set(new[1000:])) == 1 and new[0] == new[1000]


def test_license_table_has_anchors():
    assert all(re.search(licenses.ANCHOR, s) for s in licenses.SENTENCES.values())
    assert all(i in licenses.SENTENCES for _, ids in licenses.RULES for i in ids)


def test_license_rules(spark):
    s = licenses.SENTENCES
    mit = ".\n".join(s[i].capitalize() for i in (3, 4, 5, 6)) + "."
    docs = spark.createDataFrame([(0, mit), (1, s[4] + ".\n" + s[3]), (2, s[10] + "\nsome text. " + s[30]), (3, "a licence of no kind")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert rows[0]["licences"] == ["MIT"] and rows[0]["fragments"] == []
    assert rows[1]["licences"] == [] and rows[1]["fragments"] == ["4", "3"]
    assert rows[2]["licences"] == ["Apache-2.0", "CC-BY-NC-4.0"] and [k["sentence"] for k in rows[2]["known"]] == [0, 2]
    assert rows[3]["known"] == []


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details."""


def test_license_wrapped(spark):
    wrap = lambda t, mark, end="\n": end.join(mark + line for p in t.split("\n") for line in textwrap.wrap(p, 78 - len(mark)) or [""])
    made = [wrap(t, mark, end) for t in (MIT, GPL) for mark, end in (("", "\n"), (" * ", "\n"), ("# ", "\r\n"), ("dnl ", "\n"))]
    apart = licenses.SENTENCES[4].replace("notice shall", "notice\n\nshall")
    docs = spark.createDataFrame(list(enumerate([*made, apart, "one\nall rights reserved\ntwo"])), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert all(rows[i]["licences"] == [("MIT", "GPL-3.0-or-later")[i // 4]] and rows[i]["fragments"] == [] for i in range(8))
    assert [k["id"] for k in rows[0]["known"]] == [3, 4, 5, 6] and [k["id"] for k in rows[4]["known"]] == [24, 25, 22, 23]
    assert rows[8]["known"] == [] and [tuple(k) for k in rows[9]["known"]] == [(1, 70)]


#: Notices and texts as published, and the licence that each is of.
PUBLISHED = {
    "Apache-2.0": """Copyright 2019 Some Body

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "BSD-3-Clause": """Copyright (c) 2019, Some Body. All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU Lesser General Public License for more details.""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU Affero General Public License for more details.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    "MIT": MIT,
}
PUBLISHED["BSD-2-Clause"] = "\n\n".join(p for p in PUBLISHED["BSD-3-Clause"].split("\n\n") if not p.startswith("3."))
LINES = {
    "GPL version 2 or later": "GPL-2.0-or-later", "Licensed under the GPLv3": "GPL-3.0", "// SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1-or-later", "Released under the Apache License, Version 2.0.": "Apache-2.0",
    "GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991": "GPL-2.0", "All rights reserved.": "Proprietary", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "CC-BY-NC-SA-4.0",
}


def test_license_published(spark):
    wrap = lambda t, mark: "\n".join(mark + line for p in t.split("\n") for line in textwrap.wrap(p, 78 - len(mark)) or [""])
    made = [(name, wrap(t, mark)) for name, t in PUBLISHED.items() for mark in ("", "# ", " * ", "// ")] + [(name, t) for t, name in LINES.items()]
    docs = spark.createDataFrame([(i, "some head\n\n" + t + "\n\nand a body") for i, (_, t) in enumerate(made)], "doc_id long, text string")
    rows = {r["doc_id"]: r["licences"] for r in licenses.scan(docs).collect()}
    assert [(name, rows[i]) for i, (name, _) in enumerate(made)] == [(name, [name]) for name, _ in made]


def test_license_very_long(spark):
    text = "Released under the MIT License.\n" * 100_000
    r = licenses.scan(spark.createDataFrame([(1, text), (2, "x " * 500_000 + "license")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert len(r[0]["known"]) == 100_000 and r[0]["licences"] == ["MIT"] and r[0]["known"][99_999]["sentence"] == 99_999 and r[1]["known"] == []


def test_pipeline(spark):
    import corpus_pipeline as pipeline

    docs = common.table(spark, SF, "documents")
    columns, sizes = docs.columns, [docs.count()]
    kept = [docs]
    for name, stage in pipeline.STAGES:
        kept.append(common.persist_table(stage(spark, kept[-1], SF), name.replace(" ", "-")))
        sizes.append(kept[-1].count())
    assert all(k.columns == columns for k in kept[:-1]) and sizes[1] >= sizes[2] >= sizes[3] == sizes[4]
    fps = [plain_fingerprint(r["text"]) for r in kept[1].orderBy("doc_id").collect()]
    firsts = sorted(set(plain_components(fps)))
    ids = [r["doc_id"] for r in kept[1].orderBy("doc_id").collect()]
    assert [r["doc_id"] for r in kept[2].orderBy("doc_id").collect()] == [ids[i] for i in firsts]
    assert {r["doc_id"] for r in kept[5].collect()} == {r["doc_id"] for r in kept[4].collect()}
    again = pipeline.run(spark, SF)
    assert sorted(map(tuple, again.drop("sequence_id", "offset").collect())) == sorted(map(tuple, kept[5].drop("sequence_id", "offset").collect()))
