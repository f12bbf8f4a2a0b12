"""Operator 10, a quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on each document. Expectation-
maximisation over the counts of all vote patterns estimates how each labeller votes on
good and on bad documents, without any true label. The posterior of a document's
pattern is its label; posterior labels train a linear scorer over hashed features,
which then scores every document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LONG_WORD, give_back, small_batches

#: Documents the linear scorer is fitted on, drawn by hash; votes are counted over all.
SAMPLE = 8192
SHAPES, CLASSES = 512, 16
DIM = SHAPES + CLASSES * CLASSES + 2
MAX_WORDS = 150_000
WINDOW = 500

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#$%&*@^~=+<>{}[]\\|_`")] = True
_TRIPLES = [bytes([c]) * 3 for c in b"#$%&*@~=+<>|_"]
#: Byte to one of 16 classes: white space, line end, lower, upper, digit, beyond ASCII, and punctuation by kind.
_CLASS = np.full(256, 15, np.uint8)
for _i, _set in enumerate((b" \t", b"\n\r\v\f", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", bytes(range(128, 256)), b".", b",;:", b"!", b"?", b"'\"", b"()", b"|", b"#$%&*@", b"-_/\\")):
    _CLASS[list(_set)] = _i
_CLASS_BYTES = _CLASS.tobytes()


@dataclass
class Text:
    """What labellers look at, from one pass over a text's bytes."""

    raw: bytes
    words: list[bytes]
    counts: np.ndarray

    @classmethod
    def of(cls, text: str) -> Text:
        raw = text.encode("utf-8", "replace")
        return cls(raw, raw.split(), np.bincount(np.frombuffer(raw, np.uint8), minlength=256))

    @property
    def ink(self) -> int:
        return max(1, len(self.raw) - int(self.counts[[9, 10, 11, 12, 13, 32]].sum()))


def _vote(bad: bool, good: bool) -> int:
    return 2 if bad else 1 if good else 0


def _symbols(t: Text) -> int:
    share = t.counts[_SYMBOLS].sum() / t.ink
    return _vote(share > 0.08, share < 0.02)


def _capitals(t: Text) -> int:
    upper, lower = t.counts[65:91].sum(), t.counts[97:123].sum() + t.counts[128:].sum()
    share = upper / max(1, upper + lower)
    return _vote(share > 0.5 and upper > 20, share < 0.15)


def _shouting(t: Text) -> int:
    share = t.counts[33] / max(1, len(t.words))
    return _vote(share > 0.25, share < 0.05)


def _tables(t: Text) -> int:
    share = t.counts[124] / max(1, len(t.words))
    return _vote(share > 0.15, share < 0.01)


def _lines(t: Text) -> int:
    lines = [x for x in t.raw.split(b"\n") if x.strip()]
    if len(lines) < 3:
        return 0
    repeated = 1 - sum(map(len, set(lines))) / sum(map(len, lines))
    return _vote(repeated > 0.5, repeated < 0.1)


def _word_length(t: Text) -> int:
    mean = t.ink / max(1, len(t.words))
    return _vote(mean > 14 or (mean < 2 and len(t.words) > 10), 3 <= mean <= 9)


def _sentences(t: Text) -> int:
    ends = t.counts[46] + t.counts[63]
    if len(t.words) < 30:
        return 0
    return _vote(ends * 150 < len(t.words), 3 <= len(t.words) / max(1, ends) <= 60)


def variety(words: list[bytes]) -> float:
    """Share of distinct words in windows of WINDOW words, over the whole text: so that a
    long text isn't taken for a repetitive one."""
    return sum(len(set(words[i : i + WINDOW])) for i in range(0, len(words), WINDOW)) / len(words)


def _variety(t: Text) -> int:
    if len(t.words) < 50:
        return 0
    share = variety(t.words)
    return _vote(share < 0.15, share > 0.3)


def _digits(t: Text) -> int:
    share = t.counts[48:58].sum() / t.ink
    return _vote(share > 0.3, share < 0.1)


def _runs(t: Text) -> int:
    """Runs of three symbols of a kind, against the number of words."""
    share = sum(t.raw.count(s) for s in _TRIPLES) / max(1, len(t.words))
    return _vote(share > 0.1, share < 0.01)


def _affixed(t: Text) -> int:
    """Words that end in a symbol."""
    last = np.fromiter((w[-1] for w in t.words), np.uint8, len(t.words))
    share = _SYMBOLS[last].mean()
    return _vote(share > 0.2, share < 0.03)


def _echoes(t: Text) -> int:
    """Words that repeat the one before."""
    if len(t.words) < 10:
        return 0
    share = sum(map(eq, t.words, t.words[1:])) / len(t.words)
    return _vote(share > 0.15, share < 0.03)


def _squeezed(t: Text) -> int:
    """How far a text can be compressed."""
    if len(t.raw) < 400:
        return 0
    ratio = len(zlib.compress(t.raw, 1)) / len(t.raw)
    return _vote(ratio < 0.2, ratio > 0.3)


LABELLERS = (_symbols, _capitals, _shouting, _tables, _lines, _word_length, _sentences, _variety, _digits, _runs, _affixed, _echoes, _squeezed)


def votes(text: str | None) -> int:
    """All votes as one number in base 3 (0 none, 1 good, 2 bad); -1 for a text without a word."""
    if not text or not (t := Text.of(text)).words:
        return -1
    out = 0
    for f in LABELLERS:
        out = out * 3 + f(t)
    return out


@F.pandas_udf(T.LongType())
def votes_udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in parts:
        yield pd.Series([votes(t) for t in texts], dtype="int64")
    give_back()


def _digits3(patterns: np.ndarray) -> np.ndarray:
    return np.stack([patterns // 3 ** (len(LABELLERS) - 1 - j) % 3 for j in range(len(LABELLERS))], 1).astype(int)


@dataclass
class LabelModel:
    """A labeller that casts no vote says nothing: only cast votes count for or against a class."""

    prior: float  # share of good documents
    wrong: np.ndarray  # (labeller, class bad/good): share of cast votes that say bad

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that a document with this pattern is good."""
        v = _digits3(np.asarray(patterns))
        log = np.log([1 - self.prior, self.prior])[None, :].repeat(len(v), 0)
        for j in range(v.shape[1]):
            says = np.log(np.stack([np.ones(2), 1 - self.wrong[j], self.wrong[j]]))
            log += says[v[:, j]]
        log -= log.max(1, keepdims=True, initial=-np.inf)
        p = np.exp(log)
        return p[:, 1] / p.sum(1)

    def accuracy(self) -> np.ndarray:
        """Of each labeller: the share of its cast votes that is right."""
        return (1 - self.prior) * self.wrong[:, 0] + self.prior * (1 - self.wrong[:, 1])


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """EM over distinct patterns (at most 3 ** labellers, whatever the input).

    It starts from the share of bad votes. A labeller is held to be no worse than
    chance: it says bad of bad documents at least as often as of good ones.
    """
    v, n = _digits3(patterns), counts.astype(float)
    bad = (v == 2).sum(1)
    q = np.where(bad >= 1, np.where(bad >= 2, 0.1, 0.4), 0.95)
    model = LabelModel(0.9, np.full((v.shape[1], 2), 0.5))
    for _ in range(rounds):
        w = np.stack([(1 - q) * n, q * n])
        model.prior = float(np.clip((w[1].sum() + 1) / (n.sum() + 2), 0.05, 0.98))
        for j in range(v.shape[1]):
            for k in range(2):
                cast = np.bincount(v[:, j], w[k], 3)
                model.wrong[j, k] = (cast[2] + 0.5) / (cast[1] + cast[2] + 1)
            if model.wrong[j, 0] < model.wrong[j, 1]:
                model.wrong[j] = model.wrong[j].mean()
        new = model.posterior(patterns)
        if np.abs(new - q).max(initial=0) < 1e-9:
            break
        q = new
    return model


class _Shapes(dict):
    """Word to the bucket of its shape: runs of a byte class, each once. Bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        c = word.translate(_CLASS_BYTES)
        shape = bytes(x for i, x in enumerate(c) if not i or x != c[i - 1])
        h = zlib.crc32(shape) % SHAPES
        if len(word) <= LONG_WORD:
            self[word] = h
        return h


_shapes = _Shapes()


def forget() -> None:
    """Empty the cache at the end of a task."""
    _shapes.clear()
    give_back()


def features(text: str | None) -> np.ndarray | None:
    """Hashed shares of word shapes and of pairs of byte classes, and the shares of words
    that repeat the one before or any one before in their window; None for a text without a word. A few
    words say little: a short text's features are scaled down."""
    if not text or not (words := (raw := text.encode("utf-8", "replace")).split()):
        return None
    n = len(words)
    shapes = np.bincount(np.fromiter(map(_shapes.__getitem__, words), np.int64, n), minlength=SHAPES)
    c = np.frombuffer(raw.translate(_CLASS_BYTES), np.uint8)
    pairs = np.bincount((c[:-1] << 4) | c[1:], minlength=CLASSES * CLASSES)
    again = (sum(map(eq, words, words[1:])) / n, 1 - variety(words))
    return (np.sqrt(np.concatenate((shapes / n, pairs / max(1, len(c) - 1), again))) * (n / (n + 10))).astype(np.float32)


def fit_scorer(x: np.ndarray, q: np.ndarray, steps: int = 300, rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    """Weights and bias of a logistic regression on soft labels, by full-batch Adam."""
    w = np.zeros(DIM + 1)
    if not len(x):
        return w
    a = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    m = v = np.zeros_like(w)
    for i in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - q) / len(a) + decay * np.append(w[:-1], 0) / len(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-9)
    return w


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, LabelModel]:
    """Scorer and label model. Votes of all documents are counted; of a sample of about
    ``sample`` rows, at most twice that, the features reach the driver."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text").withColumn("_v", votes_udf("text"))
    seen = rows.groupBy("_v").count().filter("_v >= 0").toPandas().sort_values("_v")
    model = fit_labels(seen["_v"].to_numpy(np.int64), seen["count"].to_numpy(np.int64))
    total = int(seen["count"].sum())
    if not total:
        return np.zeros(DIM + 1), model
    draw = F.pmod(F.xxhash64(F.lit(10), "doc_id", "text"), F.lit(1 << 30))

    @F.pandas_udf("v long, x binary")
    def both(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            found = [features(t) for t in texts]
            yield pd.DataFrame({"v": [votes(t) for t in texts], "x": [None if x is None else x.tobytes() for x in found]})
        forget()

    drawn = docs.select("doc_id", "text", draw.alias("_d")).filter(F.col("_d") < int(min(1.0, sample / total) * (1 << 30)))
    got = drawn.select("_d", both(F.col("text")).alias("_b")).filter("_b.v >= 0").select("_d", "_b.v", "_b.x").limit(2 * sample).toPandas()
    got = got.sort_values(["_d", "x"])
    x = np.stack([np.frombuffer(b, np.float32) for b in got["x"]]) if len(got) else np.empty((0, DIM), np.float32)
    return fit_scorer(x, model.posterior(got["v"].to_numpy(np.int64))), model


def scorer(weights: np.ndarray):
    """A column function: text to the probability of good quality, 0 for a text without a word."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            found = (features(t) for t in texts)  # one at a time: a batch of them is large
            yield pd.Series([0.0 if x is None else float(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))) for x in found], dtype="float64")
        forget()

    return score


def classify(docs: DataFrame, sample: int = SAMPLE, least: float = 0.5) -> DataFrame:
    """(doc_id, score, keep) of every row, whole texts; ``keep`` is score >= least.

    Null or empty text, or one without a word: score 0, not kept. Repeated rows score
    alike; other columns are left out; an empty table stays empty.
    """
    weights, _ = train(docs, sample)
    return docs.select("doc_id", scorer(weights)(F.col("text")).alias("score")).withColumn("keep", F.col("score") >= least)


def keep_good(docs: DataFrame, sample: int = SAMPLE, least: float = 0.5) -> DataFrame:
    """The rows that the classifier keeps, with all columns, whatever their names.

    Null or empty texts and texts without a word go. Repeated rows are judged alike; an
    empty table stays empty."""
    weights, _ = train(docs, sample)
    return docs.filter(scorer(weights)(F.col("text")) >= least)
