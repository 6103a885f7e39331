"""Operator 5 - quality classifier on random-indexing word vectors.

Words (runs of letters, of digits, of other visible characters, case kept) are
hashed to ``BUCKETS`` ids, so the vocabulary and what is broadcast are bounded. Every
id has a fixed sparse random index vector; a word's vector is the sum of the index
vectors of the words around it in the labelled sample plus its own, scaled to unit
length. A document is the mean of its words' vectors; two pseudo-words stand for a
word in capitals and for a word said again after at most one other. A two-layer numpy network scores
the pooled vector and a temperature fitted on rows kept from its training calibrates
the probability.

Word vectors and network are fitted on at most ``SAMPLE`` labelled documents, taken
in the order of a hash of their ids, streamed to the driver one partition at a time
(a documented bound); all documents are scored, whole, in one pass without a
shuffle. Labels with crc32(doc_id) mod 4 = 2 are never used. The score depends on the
text alone.

Nulls: a null text scores as empty; a null doc_id is scored and is not held out;
null labels are ignored; a document labelled several times takes the majority, and
none if that is a tie. Repeated rows each give a row. Without labels of both kinds
every score is the share of ones (0.5 without any). An empty table gives an empty
result. Other columns are not read unless they are named in ``keep``.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

DIMENSIONS = 64
BUCKETS = 1 << 15
SAMPLE = 6000
HIDDEN = 24
WINDOW = 2
THRESHOLD = 0.7
_TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+")
CAPITALS, AGAIN = 0, 1  # pseudo-words


class _Ids(dict):
    """Word -> id, remembering at most ``most`` words."""

    most = 1 << 18

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        i = self[word] = 2 + zlib.crc32(word) % (BUCKETS - 2)
        return i


def tokens(text: str | None) -> list[bytes]:
    return _TOKEN.findall((text or "").encode())


def index_vectors(dimensions: int = DIMENSIONS, nonzero: int = 8) -> np.ndarray:
    """Sparse ternary random index vector of each id."""
    rng = np.random.default_rng(7)
    out = np.zeros((BUCKETS, dimensions), np.float32)
    at = np.argsort(rng.random((BUCKETS, dimensions)), axis=1)[:, :nonzero]
    np.put_along_axis(out, at, rng.choice(np.array([-1, 1], np.float32), at.shape), axis=1)
    return out


def word_vectors(documents: list[np.ndarray], window: int = WINDOW) -> np.ndarray:
    """Context vector of each id, from id sequences."""
    index = index_vectors()
    context = np.zeros_like(index)
    for ids in documents:
        for d in range(1, window + 1):
            if len(ids) > d:
                np.add.at(context, ids[d:], index[ids[:-d]])
                np.add.at(context, ids[:-d], index[ids[d:]])
    size = np.linalg.norm(context, axis=1, keepdims=True)
    out = index / np.sqrt(8) + np.divide(context, size, out=np.zeros_like(context), where=size > 0)
    return (out / np.linalg.norm(out, axis=1, keepdims=True)).astype(np.float32)


EXTRA = 3


def pool(vectors: np.ndarray, ids: np.ndarray, capitals: int) -> np.ndarray:
    """Mean word vector, then the shares of the pseudo-words and the length of the
    mean without them (1 if all words are the same, near 0 for varied text)."""
    n = max(1, len(ids))
    mean = np.zeros(vectors.shape[1], np.float64)
    for i in range(0, len(ids), 1 << 15):
        mean += vectors[ids[i : i + (1 << 15)]].sum(axis=0)
    mean /= n
    again = (np.count_nonzero(ids[1:] == ids[:-1]) + np.count_nonzero(ids[2:] == ids[:-2])) / n
    extra = [capitals / n, again, np.linalg.norm(mean)]
    return np.concatenate((mean + extra[0] * vectors[CAPITALS] + again * vectors[AGAIN], extra))


class Network:
    """Input -> tanh -> probability, standardised inputs, Adam, temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = 150, seed: int = 11):
        self.share = float(y.mean()) if len(y) else 0.5
        self.constant = len(np.unique(y)) < 2
        if self.constant:
            return
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        kept = max(1, len(y) // 5)
        test, train = order[:kept], order[kept:]
        self.mean, self.scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-6
        z, t = self.inputs(x), y.astype(np.float64)
        weight = np.where(t == 1, 0.5 / max(self.share, 1e-9), 0.5 / max(1 - self.share, 1e-9))
        p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(epochs):
            rng.shuffle(train)
            for i in range(0, len(train), 64):
                b = train[i : i + 64]
                h = np.tanh(z[b] @ p[0] + p[1])
                e = (_sigmoid(h @ p[2] + p[3]) - t[b]) * weight[b] / len(b)
                back = np.outer(e, p[2]) * (1 - h * h)
                grads = [z[b].T @ back + 1e-3 * p[0], back.sum(axis=0), h.T @ e + 1e-3 * p[2], e.sum(keepdims=True)]
                step += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - 0.005 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.p = p
        logits = self.logits(x[test])
        grid = np.exp(np.linspace(-1.5, 2.5, 81))
        self.temperature = float(min(grid, key=lambda c: float((weight[test] * (np.logaddexp(0, logits / c) - t[test] * logits / c)).sum())))

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -4, 4)

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(self.inputs(x) @ self.p[0] + self.p[1])
        return h @ self.p[2] + self.p[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share) if self.constant else _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(a: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(a, -60, 60)))


def remainder(id_col: str, folds: int):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of at most ``most`` labelled documents outside the fold ``held``.

    Ids are chosen first; that bounded list is then broadcast to the documents. Of rows
    that share an id one stays, that of the text of the least digest.
    """
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label).cast("double").alias("y")).dropna()
        .where(remainder("id", folds) != held)
        .groupBy("id").agg(F.avg("y").alias("y")).where("y <> 0.5")
        .select("id", (F.col("y") > 0.5).cast("int").alias("y"))
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(_first(chosen, most)), "id")
    least = F.min(F.struct(F.sha2("text", 256).alias("digest"), "text"))  # per map task first, so one id's rows do not meet
    return rows.groupBy("id", "y").agg(least.alias("least")).select("id", "least.text", "y")


def _first(chosen: DataFrame, most: int) -> DataFrame:
    """``most`` rows at most, half of them for each label where there are as many."""
    parts = [chosen.where(f"y = {k}").orderBy(F.xxhash64("id"), "id").limit(most // 2) for k in (0, 1)]
    return parts[0].unionAll(parts[1])


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, Network]:
    sample = labelled_sample(docs, labels, "quality", 4, 2, most, id_col, text_col)
    ids, sequences, rows = _Ids(), [], []
    for r in sample.toLocalIterator():
        words = tokens(r["text"])
        sequences.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
        rows.append((r["id"], r["y"], sum(map(bytes.isupper, words))))
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0], len(sequences[i]), sequences[i].tobytes()))  # whatever order they came in
    vectors = word_vectors([sequences[i] for i in order])
    x = np.array([pool(vectors, sequences[i], rows[i][2]) for i in order]).reshape(len(order), DIMENSIONS + EXTRA)
    return vectors, Network(x, np.array([rows[i][1] for i in order]))


def score(docs: DataFrame, labels: DataFrame, keep: list[str], most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", name: str = "score") -> DataFrame:
    """``keep`` of ``docs`` with the score in the column ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most, id_col, text_col))
    common.bounded_batches(docs.sparkSession)
    rows = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias(common.fresh("text", docs)))

    def run(batches):
        vectors, network = shared.value
        ids = _Ids()
        for b in batches:
            x = np.zeros((b.num_rows, DIMENSIONS + EXTRA))
            for i, t in enumerate(b.column(b.num_columns - 1)):
                words = tokens(t.as_py())
                x[i] = pool(vectors, np.fromiter(map(ids.__getitem__, words), np.int64, len(words)), sum(map(bytes.isupper, words)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(network.scores(x), pa.float64())], [*b.schema.names[:-1], name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField(name, T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score below the threshold."""
    name = common.fresh("score", docs)
    return score(docs, labels, docs.columns, id_col=id_col, text_col=text_col, name=name).where(F.col(name) >= threshold).drop(name)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"), ["doc_id"])
    return found.select(
        "doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
