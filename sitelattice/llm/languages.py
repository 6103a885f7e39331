"""Operator 13 - language identification by a bidirectional gated recurrent network.

The network reads the UTF-8 bytes of a text, in segments of ``LENGTH`` bytes: one gated
recurrent unit from the left and one from the right, whose states at a byte give that
byte's probability of each language. A document's probabilities are the means over all
its bytes. Both units are one set of arrays with a leading axis of two, the segments of a
batch are the last axis, and a byte's input is a column of a table, so a step is a few
numpy calls over thousands of segments at once.

It is trained here, in numpy, by backpropagation through time over a whole segment, on
at most ``SAMPLE`` documents with a language, outside the fold crc32(doc_id) mod 4 = 2,
equally many a language where there are as many, and at most ``SEGMENTS`` segments
of each, spread over its whole text (documented bounds; the ``LANGUAGES`` languages of most rows
are learned). All documents are labelled, whole, in one pass without a shuffle. A
prediction depends on the text alone.

Nulls: a null text and one without a letter give ``und`` with score 0; a null id is
labelled and not held out; rows without a language or an id are not learned from.
Repeated rows each give a row. Without any language to learn all are ``und``; with one,
all texts with a letter get it. Of equal probabilities the first name in order wins. An
empty table gives an empty result. Other columns are not read unless named in ``keep``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .quality import remainder

UNITS = 8
LENGTH = 64
SAMPLE = 2000
SEGMENTS = 6
LANGUAGES = 200
BATCH = 4096
UNKNOWN = "und"
LETTER = r"\p{L}"
_PAD = 256


def cut(data: bytes, length: int = LENGTH) -> np.ndarray:
    """A text's bytes as rows of ``length`` symbols, the last one padded."""
    flat = np.frombuffer(data, np.uint8)
    out = np.full((-(-len(flat) // length), length), _PAD, np.int16)
    out.reshape(-1)[: len(flat)] = flat
    return out


def _squash(a: np.ndarray) -> np.ndarray:
    """a / (1 + |a|), in place: in (-1, 1) like tanh, at a fraction of its cost."""
    size = np.abs(a)
    size += 1
    a /= size
    return a


def _gate(a: np.ndarray) -> np.ndarray:
    """The same in (0, 1)."""
    _squash(a)
    a += 1
    a *= 0.5
    return a


def _slope(squashed: np.ndarray) -> np.ndarray:
    """Derivative of ``_squash``, from its value."""
    return (1 - np.abs(squashed)) ** 2


class Network:
    """Embedding -> two gated recurrent units -> softmax over the languages at each byte.

    ``table`` holds, per direction, what each byte adds to the update gate, the reset gate
    and the candidate; ``inner`` what the state adds; ``rest`` the candidate's own offset
    inside the reset; ``out`` and ``base`` the last layer.
    """

    def __init__(self, languages: int, units: int = UNITS, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.units = units
        self.p = {
            "table": rng.normal(0, 0.3, (2, 3 * units, _PAD + 1)), "inner": rng.normal(0, units**-0.5, (2, 3 * units, units)), "rest": np.zeros((2, units, 1)),
            "out": rng.normal(0, 0.1, (languages, 2 * units)), "base": np.zeros((languages, 1)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def states(self, segments: np.ndarray, kept: list | None = None) -> np.ndarray:
        """State at each byte: (length, 2, units, segments). ``kept`` gets what the way back needs."""
        table, inner, rest = self.p["table"], self.p["inner"], self.p["rest"]
        n, length, u = len(segments), segments.shape[1], self.units
        symbols = np.ascontiguousarray(segments.T)
        there = (symbols != _PAD).astype(table.dtype)
        full = there.all(axis=1)
        h = np.zeros((2, u, n), table.dtype)
        out = np.empty((length, 2, u, n), table.dtype)
        x, a = np.empty((2, 3 * u, n), table.dtype), np.empty((2, 3 * u, n), table.dtype)
        for t in range(length):
            back = length - 1 - t
            np.take(table[0], symbols[t], axis=1, out=x[0], mode="clip")
            np.take(table[1], symbols[back], axis=1, out=x[1], mode="clip")
            np.matmul(inner, h, out=a)
            own = a[:, 2 * u :] + rest
            gates = a[:, : 2 * u] + x[:, : 2 * u]
            _gate(gates)
            z, r = gates[:, :u], gates[:, u:]
            new = r * own
            new += x[:, 2 * u :]
            _squash(new)
            next_h = h - new
            next_h *= z
            next_h += new
            if not full[t]:
                next_h[0] *= there[t]
            if not full[back]:
                next_h[1] *= there[back]
            if kept is not None:
                kept.append((h, z, r, own, new))
            h = next_h
            out[t, 0], out[back, 1] = h[0], h[1]
        return out

    def _softmax(self, states: np.ndarray) -> np.ndarray:
        """(languages, segments) at one byte."""
        y = self.p["out"] @ states.reshape(2 * self.units, -1)
        y += self.p["base"]
        y -= y.max(axis=0)
        np.exp(y, out=y)
        y /= y.sum(axis=0)
        return y

    def sums(self, segments: np.ndarray) -> np.ndarray:
        """Per segment the sum of its bytes' probabilities: (segments, languages)."""
        total = np.zeros((len(self.p["base"]), len(segments)), np.float32)
        for t, states in enumerate(self.states(segments)):
            y = self._softmax(states)
            y *= segments[:, t] != _PAD
            total += y
        return total.T

    def loss(self, segments: np.ndarray, wanted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of the bytes, and its gradient by backpropagation through time."""
        kept: list = []
        states, p, u = self.states(segments, kept), self.p, self.units
        n, length = segments.shape
        symbols = np.ascontiguousarray(segments.T)
        there = (symbols != _PAD).astype(states.dtype)
        share = there / max(1.0, there.sum())
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        loss, to_states = 0.0, np.empty_like(states)
        for t in range(length):
            y = self._softmax(states[t])
            loss -= float((np.log(y[wanted, np.arange(n)] + 1e-12) * share[t]).sum())
            y[wanted, np.arange(n)] -= 1
            y *= share[t]
            grad["out"] += y @ states[t].reshape(2 * u, n).T
            grad["base"] += y.sum(axis=1, keepdims=True)
            to_states[t] = (p["out"].T @ y).reshape(2, u, n)
        by_symbol = np.zeros((2, _PAD + 1, 3 * u), states.dtype)
        dh = np.zeros_like(states[0])
        for t in reversed(range(length)):
            back = length - 1 - t
            dh[0] += to_states[t, 0]
            dh[1] += to_states[back, 1]
            dh[0] *= there[t]
            dh[1] *= there[back]
            h, z, r, own, new = kept[t]
            dn = dh * (1 - z) * _slope(new)
            dr = dn * own * _slope(2 * r - 1) / 2
            dz = dh * (h - new) * _slope(2 * z - 1) / 2
            dx = np.concatenate((dz, dr, dn), axis=1)
            da = np.concatenate((dz, dr, dn * r), axis=1)
            grad["inner"] += da @ h.transpose(0, 2, 1)
            grad["rest"] += da[:, 2 * u :].sum(axis=2, keepdims=True)
            dh = dh * z + p["inner"].transpose(0, 2, 1) @ da
            for d, s in ((0, symbols[t]), (1, symbols[back])):
                order = np.argsort(s, kind="stable")
                starts = np.flatnonzero(np.concatenate(([True], s[order][1:] != s[order][:-1])))
                by_symbol[d, s[order][starts]] += np.add.reduceat(dx[d].T[order], starts, axis=0)
        grad["table"] = by_symbol.transpose(0, 2, 1)
        return loss, grad

    def train(self, segments: np.ndarray, wanted: np.ndarray, epochs: int = 6, batch: int = 256, rate: float = 0.02, seed: int = 9) -> list[float]:
        """Adam; returns each epoch's mean loss."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        steps, step, losses = epochs * -(-len(segments) // batch), 0, []
        for _ in range(epochs):
            order, total = rng.permutation(len(segments)), 0.0
            for i in range(0, len(order), batch):
                at = order[i : i + batch]
                loss, grad = self.loss(segments[at], wanted[at])
                total += loss * len(at)
                size = float(np.sqrt(sum((g * g).sum() for g in grad.values())))
                now, step = rate * (1 - step / steps), step + 1
                for k, g in grad.items():
                    g = g * min(1.0, 1 / (size + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.p[k] -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
            losses.append(total / max(1, len(order)))
        return losses


class Model:
    """The languages, in order of their names, and the network, if there is more than one."""

    def __init__(self, texts: list[tuple[bytes, str]], segments: int = SEGMENTS, seed: int = 3):
        self.languages = sorted({lang for _, lang in texts})
        self.network = None
        if len(self.languages) < 2:
            return
        place, rows, wanted = {v: i for i, v in enumerate(self.languages)}, [], []
        for data, lang in texts:
            own = cut(data)
            at = np.unique(np.linspace(0, len(own) - 1, segments).astype(int)) if len(own) else []
            rows.append(own[at])
            wanted += [place[lang]] * len(at)
        self.network = Network(len(self.languages), seed=seed)
        self.network.train(np.concatenate(rows), np.array(wanted, dtype=np.int64))

    def probabilities(self, texts: list[bytes | None], batch: int = BATCH) -> np.ndarray:
        """(texts, languages): the mean over each text's bytes; zeros for an empty one."""
        out = np.zeros((len(texts), len(self.languages)))
        if self.network is None:
            return out + 1
        waiting: list[tuple[int, np.ndarray]] = []

        def read() -> None:
            owner = np.repeat([i for i, _ in waiting], [len(s) for _, s in waiting])
            np.add.at(out, owner, self.network.sums(np.concatenate([s for _, s in waiting])))
            waiting.clear()

        held = 0
        for i, data in enumerate(texts):
            own, start = cut(data or b""), 0
            while start < len(own):
                part = own[start : start + batch - held]
                waiting.append((i, part))
                held, start = held + len(part), start + len(part)
                if held == batch:
                    read()
                    held = 0
        if waiting:
            read()
        return out / np.maximum(1, [len(t or b"") for t in texts])[:, None]


def sample(docs: DataFrame, most: int = SAMPLE, languages: int = LANGUAGES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(text, lang) of at most ``most`` documents outside the held-out fold, as many of each
    language as of any other where there are as many. Those of the least hashes; the
    share of each language that can hold these is read first, so that few rows are ranked."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = named.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (remainder("id", 4) != 2))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    each = max(1, most // max(1, len(counts)))
    spark = docs.sparkSession
    shares = spark.createDataFrame([(r["lang"], min(1.0, (2 * each + 200) / r["count"])) for r in counts], T.StructType([T.StructField("lang", named.schema["lang"].dataType), T.StructField("share", T.DoubleType())]))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    likely = rows.join(F.broadcast(shares), "lang").where(part < F.col("share")).dropDuplicates(["lang", "id", "text"])  # LANGUAGES rows at most
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id", "text"), "id", "text")
    return likely.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each).select("text", F.col("lang").cast("string").alias("lang"))


def fit(docs: DataFrame, most: int = SAMPLE, **names: str) -> Model:
    rows = sorted((r["text"].encode(), r["lang"]) for r in sample(docs, most, **names).toLocalIterator())
    return Model(rows)


def identify(docs: DataFrame, keep: list[str], most: int = SAMPLE, text_col: str = "text", model: Model | None = None, **names: str) -> DataFrame:
    """``keep`` of ``docs`` with the columns ``lang_pred`` and ``lang_score``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model or fit(docs, most, text_col=text_col, **names))
    common.bounded_batches(spark)
    text = F.col(text_col)
    lettered = F.when(text.rlike(LETTER), text.cast("binary"))
    kept = docs.select(*[F.col(c) for c in keep])
    rows = docs.select(*[F.col(c) for c in keep], lettered.alias(common.fresh("text", kept)))

    def run(batches):
        model = shared.value
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            found = model.probabilities(texts) if model.languages else np.zeros((len(texts), 1))
            at = found.argmax(axis=1)
            known = [t is not None and bool(model.languages) for t in texts]
            names = [model.languages[i] if k else UNKNOWN for i, k in zip(at, known, strict=True)]
            scores = np.where(known, np.minimum(found[np.arange(len(at)), at], 1.0), 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*b.schema.names[:-1], "lang_pred", "lang_score"])

    out = [*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]
    return rows.mapInArrow(run, T.StructType(out))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(common.table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
