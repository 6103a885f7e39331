"""Operator 10 - toxicity by Levenshtein automata over a lexicon trie.

The lexicon is learned: words, and stems with several endings, that labelled toxic
documents use and others do not. It is held as a trie. A word of a document is run
against it by intersecting the trie with the word's Levenshtein automaton, whose
states are kept as bit sets, so a misspelled term (one edit from ``SHORT_FROM``
letters on, two from twice ``FUZZY_FROM``) is caught without listing spellings. A stem
of ``FUZZY_FROM`` letters or more ends the walk wherever the word goes on, and the
words that a stem was learned from are in the trie themselves. Terms under
``FUZZY_FROM`` letters have many clean words near them: their misspellings begin with
the same letter or a digit, and are no word of the other labelled documents.

Each hit is then judged by the words around it: quotation marks open before and
closed after it, or reporting verbs, make it a quotation, words of address near it
make it abuse. A logistic model over the hits (exact, stem, misspelled, each direct or
quoted, addressed) gives the score.

Lexicon and model are fitted on at most ``SAMPLE`` labelled documents (a documented
bound), half of them toxic where there are as many, streamed to the driver; labels
with crc32(doc_id) mod 3 = 1 are never used. All documents are scored, whole, in one
pass without a shuffle.

Nulls: a null text scores as empty; a null doc_id is scored and is not held out;
null labels are ignored; several labels of a document count by majority, a tie not at
all. Repeated rows each give a row. Without labels of both kinds the score is the
share of ones (0.5 without any). An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, quality

SAMPLE = 6000
TERMS = 2000
FUZZY_FROM = 6
SHORT_FROM = 4
STEM = 4
CONTEXT = 6
THRESHOLD = 0.7
_WORD = re.compile(r"[^\W_]+")
# Words that report speech and words of address.
REPORTS = frozenset("said says wrote called quote quoted quotes reported according dit écrit appelé cité selon sagte schrieb nannte zitiert laut dijo escribió llamó citó según".split())
ADDRESS = frozenset("you your youre yourself u du dich dir dein deine ihr euch tu te toi ton vous votre tú ti usted ustedes vosotros su".split())
OPENS, CLOSES = "\"“„«‘‹", "\"”“»’›"


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Lexicon:
    """Trie of terms and stems. ``find`` gives (kind, weight): 0 exact, 1 stem,
    2 misspelled; None if no term is near. ``inflected`` are words of stems, held for
    their misspellings; ``clean`` are words that are no misspelling."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float], inflected: dict[str, float] | None = None, clean: set[str] | None = None):
        self.terms, self.stems, self.inflected, self.clean = terms, stems, inflected or {}, clean or set()
        self.root: dict = {}
        # A word ends at the key "", a stem at None.
        for entries, end in ((terms, ""), (self.inflected, ""), ([s for s in stems if len(s) >= FUZZY_FROM], None)):
            for term in entries:
                node = self.root
                for c in term:
                    node = node.setdefault(c, {})
                node[end] = term
        self.stem_lengths = sorted({len(s) for s in stems})
        # Some part of a term is left as it was, one more than there are edits: a word is near only
        # if it begins or ends with such a part, or holds it, and its length is within the edits.
        self.heads: dict[int, dict[str, int]] = {}  # length of the part -> part -> bits of the words' lengths
        self.tails: dict[int, dict[str, int]] = {}
        self.bodies: dict[int, dict[str, int]] = {}
        self.stem_heads: dict[int, set[str]] = {}
        self.stem_bodies: dict[tuple[int, int], set[str]] = {}  # (place, length) -> parts
        for term in (*terms, *self.inflected):
            edits = self.edits(len(term))
            if edits:
                lengths = sum(1 << n for n in range(len(term) - edits, len(term) + edits + 1))
                parts = self._parts(term)
                for index, (_, part) in ((self.heads, parts[0]), (self.tails, parts[-1]), *((self.bodies, p) for p in parts[1:-1])):
                    known = index.setdefault(len(part), {})
                    known[part] = known.get(part, 0) | lengths
        for stem in stems:
            if len(stem) >= FUZZY_FROM:
                edits, parts = self.edits(len(stem)), self._parts(stem)
                self.stem_heads.setdefault(len(parts[0][1]), set()).add(parts[0][1])
                for at, part in parts[1:]:
                    for place in range(at - edits, at + edits + 1):
                        self.stem_bodies.setdefault((place, len(part)), set()).add(part)
        self.known: dict[str, tuple[int, float] | None] = {}

    @classmethod
    def _parts(cls, term: str) -> list[tuple[int, str]]:
        """(place, part): one part more than there are edits."""
        n = cls.edits(len(term)) + 1
        cuts = [len(term) * i // n for i in range(n + 1)]
        return [(a, term[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def find(self, word: str) -> tuple[int, float] | None:
        try:
            return self.known[word]
        except KeyError:
            if len(self.known) >= 1 << 18:
                self.known.clear()
            hit = self.known[word] = self._find(word)
            return hit

    def _find(self, word: str) -> tuple[int, float] | None:
        if word in self.terms:
            return 0, self.terms[word]
        for n in self.stem_lengths:
            if word[:n] in self.stems and len(word) >= n:
                return 1, self.stems[word[:n]]
        if len(word) < SHORT_FROM - 1 or word in self.clean:
            return None
        found = self.misspelled(word)
        return (2, max(found)) if found else None

    def misspelled(self, word: str) -> list[float]:
        """Weights of the terms and stems that ``word`` may be a misspelling of."""
        long_enough = lambda t: len(t) >= FUZZY_FROM or word[0] == t[0] or word[0].isdigit()
        found = []
        if self._near_term(word):
            found = [self.terms.get(t, self.inflected.get(t)) for t in self.intersect(word) if long_enough(t)]
        if len(word) >= FUZZY_FROM - 1 and self._near_stem(word):
            found += [self.stems[s] for s in self.intersect(word, stems=True)]
        return found

    def _near_term(self, word: str) -> bool:
        n = len(word)
        for k, known in self.heads.items():
            if known.get(word[:k], 0) >> n & 1:
                return True
        for k, known in self.tails.items():
            if known.get(word[-k:], 0) >> n & 1:
                return True
        return any(known.get(word[i : i + k], 0) >> n & 1 for k, known in self.bodies.items() for i in range(n - k + 1))

    def _near_stem(self, word: str) -> bool:
        for k, known in self.stem_heads.items():
            if word[:k] in known:
                return True
        for (at, k), known in self.stem_bodies.items():
            if word[at : at + k] in known:
                return True
        return False

    @staticmethod
    def edits(length: int) -> int:
        return 0 if length < SHORT_FROM else 1 if length < 2 * FUZZY_FROM else 2

    def intersect(self, word: str, stems: bool = False) -> list[str]:
        """Terms that the Levenshtein automaton of ``word`` accepts within the edits
        their own length allows; with ``stems``, stems that it accepts after any part of
        the word. Bit i of a set: the first i letters are read."""
        n, most = len(word), 2
        full = (1 << (n + 1)) - 1
        at: dict[str, int] = {}
        for i, c in enumerate(word):
            at[c] = at.get(c, 0) | 1 << i
        start = [1]
        for _ in range(most):
            start.append(start[-1] | start[-1] << 1 & full)
        found, stack = [], [(self.root, start)]
        while stack:
            node, sets = stack.pop()
            for c, below in node.items():
                if not c:
                    at_end = sets[self.edits(len(below))]
                    if stems == (c is None) and (at_end if stems else at_end >> n & 1):
                        found.append(below)
                    continue
                match = at.get(c, 0)
                after = [(sets[0] & match) << 1 & full]
                for k in range(1, most + 1):
                    s = (sets[k] & match) << 1 | sets[k - 1] | sets[k - 1] << 1 | after[k - 1] << 1  # match, skip a term's letter, replace, skip a word's letter
                    after.append(s & full)
                if after[most]:
                    stack.append((below, after))
        return found


FEATURES = 8


def hits(lexicon: Lexicon, text: str | None) -> np.ndarray:
    """Counts and weights of a document's hits."""
    out = np.zeros(FEATURES)
    if not text:
        return out
    low = text.lower()
    every = _WORD.findall(low)
    find, near = lexicon.find, {}
    for w in set(every):
        if (h := find(w)) is not None:
            near[w] = h
    if not near:
        return out
    marks = [m.span() for m in _WORD.finditer(low)]
    for i, w in enumerate(every):
        if (h := near.get(w)) is None:
            continue
        around = every[max(0, i - CONTEXT) : i] + every[i + 1 : i + 1 + CONTEXT]
        before, after = low[marks[max(0, i - CONTEXT)][0] : marks[i][0]], low[marks[i][1] : marks[min(len(marks) - 1, i + CONTEXT)][1]]
        quoted = (any(c in before for c in OPENS) and any(c in after for c in CLOSES)) or not REPORTS.isdisjoint(around)
        out[2 * h[0] + quoted] += 1
        out[6] += not ADDRESS.isdisjoint(around)
        out[7] = max(out[7], h[1] * (0.5 if quoted else 1))
    return out


def _inputs(x: np.ndarray) -> np.ndarray:
    """Saturating counts: the first hit says most."""
    return np.concatenate((x[:, :7] > 0, np.log1p(x[:, :7]), x[:, 7:]), axis=1).astype(float)


def learn_lexicon(texts: list[str], y: np.ndarray, terms: int = TERMS) -> Lexicon:
    """Terms and stems by the number of different contexts (word before, word after)
    they have in toxic and in other documents; copies of a text add none."""
    vocabulary: dict[str, int] = {}
    parts = []
    for text, label in zip(texts, y, strict=True):
        ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)], dtype=np.uint64)
        padded = np.concatenate(([np.uint64(0)], ids, [np.uint64(0)]))
        context = (padded[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (padded[2:] * np.uint64(0xC2B2AE3D27D4EB4F))
        parts.append(np.unique(np.stack((ids * np.uint64(2) + np.uint64(label), context)), axis=1))
    if not parts or not vocabulary:
        return Lexicon({}, {})
    key = np.unique(np.concatenate(parts, axis=1), axis=1)[0]
    counts = np.bincount(key.astype(np.int64), minlength=2 * len(vocabulary) + 2).reshape(-1, 2).astype(float)
    total = counts.sum(axis=0)
    if total.min() == 0:
        return Lexicon({}, {})
    share = total[1] / total.sum()

    def weight(c) -> float:
        return float(math.log((c[1] + 0.5) / (total[1] + 1)) - math.log((c[0] + 0.5) / (total[0] + 1)))

    def sure(c, tried: int) -> bool:
        """Hardly ever in other documents, and too one-sided for chance among all tried."""
        b, a = c
        if a < 4 or b / total[0] * 50 > a / total[1]:
            return False
        gain = a * math.log(a / (a + b) / share) + (b and b * math.log(b / (a + b) / (1 - share)))
        return gain > math.log(tried) + 4.6

    heads: dict[str, np.ndarray] = {}
    most: dict[str, float] = {}  # contexts of a stem's commonest word
    for w, i in vocabulary.items():
        if counts[i, 1]:
            for k in range(STEM, min(len(w), 12) + 1):
                heads[w[:k]] = heads.get(w[:k], 0) + counts[i]
                most[w[:k]] = max(most.get(w[:k], 0), counts[i, 1])
    for w, i in vocabulary.items():
        if not counts[i, 1]:
            for k in range(STEM, min(len(w), 12) + 1):
                if w[:k] in heads:
                    heads[w[:k]] = heads[w[:k]] + counts[i]
    found = {w: weight(counts[i]) for w, i in vocabulary.items() if len(w) >= 3 and sure(counts[i], len(vocabulary))}
    stems: dict[str, float] = {}
    for s in sorted((s for s, c in heads.items() if sure(c, len(heads)) and most[s] < 0.6 * c[1]), key=lambda s: (len(s), s)):
        if not any(s[:k] in stems for k in range(1, len(s))):
            longer = True
            while longer:  # as far as nearly all its words agree
                longer = next((t for t in (s + c for c in {w[len(s)] for w in heads if w.startswith(s) and len(w) == len(s) + 1}) if heads[t][1] >= 0.95 * heads[s][1]), None)
                s = longer or s
            stems[s] = weight(heads[s])
    of_stem = {w for w in found if any(w.startswith(s) for s in stems)}
    best = sorted((w for w in found if w not in of_stem), key=lambda w: (-found[w], w))[:terms]
    lexicon = Lexicon({w: found[w] for w in best}, stems, {w: found[w] for w in of_stem})
    # Words of other documents that look like misspellings and are no more common in toxic ones.
    for w, i in vocabulary.items():
        if counts[i, 0] and counts[i, 1] / total[1] <= 2 * counts[i, 0] / total[0] and lexicon.find(w) is not None and lexicon.find(w)[0] == 2:
            lexicon.clean.add(w)
    lexicon.known.clear()
    return lexicon


class Model:
    def __init__(self, x: np.ndarray, y: np.ndarray, steps: int = 40, ridge: float = 0.02):
        self.share = float(y.mean()) if len(y) else 0.5
        self.constant = len(np.unique(y)) < 2
        if self.constant:
            return
        z = np.concatenate((_inputs(x), np.ones((len(x), 1))), axis=1)
        weight = np.where(y == 1, 0.5 / self.share, 0.5 / (1 - self.share)) / len(y)
        self.w = np.zeros(z.shape[1])
        penalty = np.full(len(self.w), ridge)
        penalty[-1] = 1e-6
        for _ in range(steps):  # Newton
            p = quality._sigmoid(z @ self.w)
            g = z.T @ ((p - y) * weight) + penalty * self.w / 10
            h = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty / 10)
            self.w -= np.linalg.solve(h, g)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant:
            return np.full(len(x), self.share)
        return quality._sigmoid(np.concatenate((_inputs(x), np.ones((len(x), 1))), axis=1) @ self.w)


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[Lexicon, Model]:
    sample = quality.labelled_sample(docs, labels, "toxic", 3, 1, most)
    rows = sorted(((r["id"], r["text"] or "", r["y"]) for r in sample.toLocalIterator()), key=lambda r: (r[0], r[1]))
    y = np.array([y for _, _, y in rows], dtype=np.int64)
    lexicon = learn_lexicon([t for _, t, _ in rows], y)
    x = np.array([hits(lexicon, t) for _, t, _ in rows]).reshape(len(rows), FEATURES)
    model = Model(x, y)
    lexicon.known.clear()
    return lexicon, model


def score(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    common.bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))

    def run(batches):
        lexicon, model = shared.value
        for b in batches:
            x = np.array([hits(lexicon, t.as_py()) for t in b.column("text")]).reshape(b.num_rows, FEATURES)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(model.scores(x), pa.float64()), pa.array(x[:, :6].sum(axis=1).astype(np.int64))], ["doc_id", "score", "n_hits"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, n_hits long")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", F.coalesce(quality.remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_hits",
    )
