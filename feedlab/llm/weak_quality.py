"""A quality classifier from weak labels.

1. Overlapping heuristic labellers vote good, bad or nothing on every document.
   Only the counts of vote patterns leave the executors (at most 3 to the power
   of the number of labellers, however large the corpus).
2. Expectation-maximisation on the pattern counts estimates the share of good
   documents and, per labeller and class, how often it votes what (Dawid and
   Skene, 1979).  No true label is used.
3. The posteriors of a sample of about ``sample_docs`` documents, drawn by a hash,
   train a hashed linear scorer in one task.
4. Every document is scored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlab.llm.common import map_arrow, materialize, text_bytes
from feedlab.llm.quality_ledger import SYMBOLS, repeated_window_words

BAD, GOOD, ABSTAIN = 0, 1, 2
# The scorer is fitted on about this many documents (all, if there are fewer).
SAMPLE_DOCS = 8_000
FEATURES = 1 << 16
EM_ROUNDS = 100
FIT_STEPS = 120

# --- fixed values: frequent function words of the corpus languages --------------
FUNCTION_WORDS = frozenset(w.encode() for w in """the of and to in a is that for it with as was on be by this are at
from or an have not der die das und ist von zu den mit auf im des ein eine nicht sich dem le la les de des et est un une
que pour dans en du qui sur el los las y es una con por para del se no al""".split())
# ----------------------------------------------------------------------------------

_SYMBOL_BYTES = SYMBOLS.encode()
_SYMBOLS = tuple(bytes([b]) for b in _SYMBOL_BYTES)
_PUNCTUATION = b".,;:!?)'\""


class Measures:
    """What the labellers look at, from the words of one text."""
    __slots__ = ("n", "symbols", "chars", "repeated", "lines", "dup_lines", "upper", "letters", "function", "ended",
                 "distinct", "plain", "mean_length")

    def __init__(self, text: bytes):
        words = text.split()
        self.n = len(words)
        self.chars = sum(map(len, words))
        self.symbols = len(text) - len(text.translate(None, _SYMBOL_BYTES))
        self.repeated = repeated_window_words(words)
        lines = [x for x in text.split(b"\n") if x.split()]
        self.lines, self.dup_lines = len(lines), len(lines) - len(set(lines))
        lower = text.lower()
        self.upper = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        self.letters = len(lower) - len(lower.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
        self.function = sum(map(FUNCTION_WORDS.__contains__, words))
        self.ended = sum(w.endswith((b".", b"!", b"?", b",", b";")) for w in words)
        self.distinct = len(set(words))
        self.plain = sum(w.rstrip(_PUNCTUATION).isalnum() if w.isascii() else not w.endswith(_SYMBOLS) for w in words)
        self.mean_length = self.chars / self.n if self.n else 0.0


def _by_share(part: Callable, whole: Callable, good_to: float, bad_from: float, least: int = 1):
    """Good up to one share, bad from another, nothing between."""
    def vote(m: Measures) -> int:
        w = whole(m)
        if w < least:
            return ABSTAIN
        s = part(m) / w
        return GOOD if s <= good_to else BAD if s >= bad_from else ABSTAIN
    return vote


LABELLERS: dict[str, Callable[[Measures], int]] = {
    "words": lambda m: ABSTAIN if m.n else BAD,
    "plain_words": lambda m: ABSTAIN if m.n < 10 else GOOD if m.plain > 0.85 * m.n else
    BAD if m.plain < 0.7 * m.n else ABSTAIN,
    "symbols": _by_share(lambda m: m.symbols, lambda m: m.chars, 0.01, 0.06),
    "repetition": _by_share(lambda m: m.repeated, lambda m: m.n, 0.1, 0.5, 30),
    "lines": _by_share(lambda m: m.dup_lines, lambda m: m.lines, 0.0, 0.3, 5),
    "capitals": _by_share(lambda m: m.upper, lambda m: m.letters, 0.12, 0.4, 40),
    "function_words": lambda m: ABSTAIN if m.n < 20 else GOOD if m.function > 0.08 * m.n else
    BAD if m.function < 0.01 * m.n else ABSTAIN,
    "sentences": lambda m: ABSTAIN if m.n < 40 else GOOD if 0.02 * m.n <= m.ended <= 0.3 * m.n else
    BAD if not m.ended or m.ended > 0.6 * m.n else ABSTAIN,
    "word_length": lambda m: ABSTAIN if m.n < 5 else GOOD if 3 <= m.mean_length <= 10 else
    BAD if m.mean_length < 2 or m.mean_length > 25 else ABSTAIN,
    "variety": lambda m: ABSTAIN if m.n < 60 else BAD if m.distinct < 0.15 * m.n else
    GOOD if m.distinct > 0.35 * m.n else ABSTAIN,
}


def pattern(m: Measures) -> int:
    """The votes as a number to the base 3, first labeller last."""
    p = 0
    for vote in LABELLERS.values():
        p = 3 * p + vote(m)
    return p


def votes(patterns, n: int = len(LABELLERS)) -> np.ndarray:
    """(patterns, labellers) array of votes."""
    p = np.asarray(patterns, dtype=np.int64)
    return np.stack([p // 3 ** (n - 1 - j) % 3 for j in range(n)], axis=1)


class WeakLabelModel:
    """Class share and labeller behaviour by expectation-maximisation.

    What a labeller votes counts, not that it votes: abstaining says nothing."""

    def __init__(self, good_share: float, table: np.ndarray):
        self.good_share, self.table = good_share, table      # table[labeller, class, vote]

    @classmethod
    def fit(cls, patterns, counts, rounds: int = EM_ROUNDS) -> WeakLabelModel:
        v, c = votes(patterns), np.asarray(counts, dtype=float)
        k = v.shape[1]
        # The start: good documents seldom look bad to a labeller, bad ones do to half of them.
        model = cls(0.8, np.tile(np.array([[0.5, 0.5], [0.02, 0.98]]), (k, 1, 1)))
        for _ in range(rounds):
            p = model._posterior(v)
            share = float((p * c).sum() / c.sum()) if c.sum() else 0.5
            new = np.empty((k, 2, 2))
            for y, weight in ((BAD, (1 - p) * c), (GOOD, p * c)):
                for j in range(k):
                    new[j, y] = np.bincount(v[:, j], weights=weight, minlength=3)[:2] + 0.5
            new /= new.sum(axis=2, keepdims=True)
            moved = np.abs(new - model.table).max()
            model = cls(min(max(share, 1e-6), 1 - 1e-6), new)
            if moved < 1e-9:
                break
        return model

    def _posterior(self, v: np.ndarray) -> np.ndarray:
        logit = np.full(len(v), math.log(self.good_share / (1 - self.good_share)))
        odds = np.log(self.table[:, GOOD] / self.table[:, BAD])
        for j in range(v.shape[1]):
            logit += np.append(odds[j], 0.0)[v[:, j]]
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))

    def posterior(self, patterns) -> np.ndarray:
        """Probability of good, per vote pattern."""
        return self._posterior(votes(patterns))

    def accuracies(self) -> dict[str, float]:
        """Per labeller: how often its vote, when it votes, is right."""
        right = (1 - self.good_share) * self.table[:, BAD, BAD] + self.good_share * self.table[:, GOOD, GOOD]
        return dict(zip(LABELLERS, right.tolist()))


# --- hashed features ------------------------------------------------------------

def _bucket(name: bytes) -> int:
    return xxhash.xxh64_intdigest(name) % FEATURES


_SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256))


class WordFeatures(dict):
    """A word's features: itself and the shape of its last characters."""
    LIMIT = 300_000

    def __missing__(self, word: bytes):
        out = _bucket(b"w" + word.lower()), _bucket(b"s" + word[-4:].translate(_SHAPE))
        if len(self) < self.LIMIT and len(word) < 64:
            self[word] = out
        return out


_STEPS = (0, 0.001, 0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5, 0.7)


def document_features(m: Measures) -> list[int]:
    """The document's shares, in steps."""
    n = max(m.n, 1)
    shares = (("rep", m.repeated / n), ("sym", m.symbols / max(m.chars, 1)), ("dup", m.dup_lines / max(m.lines, 1)),
              ("cap", m.upper / max(m.letters, 1)), ("fun", m.function / n), ("end", m.ended / n), ("var", m.distinct / n))
    return [_bucket(f"d{k}{sum(s > x for x in _STEPS)}".encode()) for k, s in shares] + [
        _bucket(f"dlen{min(int(m.n).bit_length(), 8)}".encode()), _bucket(f"dwl{min(int(m.mean_length), 30)}".encode())]


def _vector(text: bytes, m: Measures, words: WordFeatures):
    """(features, values): words count as shares, document features as ones."""
    idx = document_features(m)
    val = [1.0] * len(idx)
    if m.n:
        pairs = [words[w] for w in text.split()]
        u, c = np.unique(np.array(pairs, dtype=np.int64).ravel(), return_counts=True)
        return np.concatenate([idx, u]), np.concatenate([val, c / m.n])
    return np.array(idx), np.array(val)


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, steps: int = FIT_STEPS,
               rate: float = 0.1, decay: float = 1e-5) -> np.ndarray:
    """Weights (bias last) of a logistic scorer for soft targets."""
    sizes = [len(i) for i, _ in rows]
    idx, val = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    w, first, second = (np.zeros(FEATURES + 1) for _ in range(3))
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=val * w[idx], minlength=len(rows)) + w[-1]
        error = (1 / (1 + np.exp(-z)) - target) / len(rows)
        grad = np.append(np.bincount(idx, weights=val * error[row], minlength=FEATURES), error.sum()) + decay * w
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        w -= rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-9)
    return w


def _patterns(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([pattern(Measures(t.as_py())) for t in b.column(1)], pa.int32())],
            names=["doc_id", "pattern"])


def _fit(model: WeakLabelModel):
    def run(batches):
        words, rows, target = WordFeatures(), [], []
        for b in batches:
            for t in b.column("text"):
                text = t.as_py()
                m = Measures(text)
                rows.append(_vector(text, m, words))
                target.append(pattern(m))
        if rows:
            w = fit_scorer(rows, model.posterior(target))
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(w).astype(np.int32)), pa.array(w[w != 0])],
                                             names=["feature", "weight"])
    return run


def _score(model: WeakLabelModel, weights: np.ndarray):
    class WordWeights(dict):
        def __missing__(self, word: bytes) -> float:
            a, b = features[word]
            out = float(weights[a] + weights[b])
            if len(self) < WordFeatures.LIMIT and len(word) < 64:
                self[word] = out
            return out

    features = WordFeatures()
    features.LIMIT = 0                       # the words' weights are remembered instead

    def run(batches):
        by_word = WordWeights()
        for b in batches:
            scores, patterns = [], []
            for t in b.column(1):
                text = t.as_py()
                m = Measures(text)
                z = weights[-1] + weights[document_features(m)].sum()
                if m.n:
                    z += sum(map(by_word.__getitem__, text.split())) / m.n
                scores.append(1 / (1 + math.exp(-max(min(z, 500), -500))))
                patterns.append(pattern(m))
            post = model.posterior(patterns) if patterns else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(post), pa.array(scores, pa.float64())],
                names=["doc_id", "posterior", "score"])
    return run


def fit_labels(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[WeakLabelModel, int]:
    """The weak-label model of a corpus, from its vote pattern counts, and the
    number of documents."""
    src = docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text).alias("text"))
    ddl = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, pattern int"
    rows = map_arrow(src, _patterns, ddl).groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    if not rows:
        return WeakLabelModel(0.5, np.full((len(LABELLERS), 2, 2), 0.5)), 0
    return WeakLabelModel.fit([r["pattern"] for r in rows], [r["n"] for r in rows]), sum(r["n"] for r in rows)


def hashed_share(rows: DataFrame, share: float) -> DataFrame:
    """About this share of the rows, by a hash of the row's number: equal rows are
    drawn one by one, so copies cannot all enter together."""
    if share >= 1:
        return rows
    return (rows.withColumn("_row", F.monotonically_increasing_id())
            .filter(F.xxhash64("_row") < F.lit(int(share * 2.0 ** 64) - (1 << 63))).drop("_row"))


def score_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, sample_docs: int = SAMPLE_DOCS,
                  threshold: float = 0.5) -> DataFrame:
    """doc_id, posterior (of the labellers), score (of the scorer), kept; one row per row.

    A null text is empty; most labellers abstain on empty and very short texts.
    Null and repeated ids pass through, repeated rows are drawn for the sample and
    scored one by one, very long texts are measured whole, an empty table stays
    empty, and other columns are ignored.
    """
    model, n = fit_labels(docs, doc_id, text)
    src = docs.select(F.col(doc_id).alias("doc_id"), text_bytes(text).alias("text"))
    # drawn where the rows are; only the sample meets in the fitting task, in a
    # fixed order so that the same files give the same weights
    sample = hashed_share(src, sample_docs / n if n else 1.0).select("text")
    sample = sample.repartition(1).sortWithinPartitions("text")
    rows = materialize(map_arrow(sample, _fit(model), "feature int, weight double"), "quality-weights")
    weights = np.zeros(FEATURES + 1)
    for r in rows.collect():                       # at most FEATURES + 1 numbers
        weights[r["feature"]] = r["weight"]
    ddl = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, posterior double, score double"
    return map_arrow(src, _score(model, weights), ddl).withColumn("kept", F.col("score") >= threshold)
