"""Operator 4, language-model scoring with a hashed maximum-entropy model.

The next token's probability is factored in three: a softmax over classes, a softmax over
the members of the class, and the token's share of its member. A few frequent words are
classes by themselves; the others fall into classes by their ending. Within such a class
its most frequent words are members by themselves, the others are hashed to members, as
are unknown words. A word's class and member together, its leaf, are also the hashed word
that stands in contexts. Features are, for the class, the word before (hashed n-gram), the
class of the word before that (skip) and both (hashed); for the member, the class and the
class with the word before.

All that training needs of the corpus are the counts of (context, outcome), whose number
is bounded. They are added up over all training tokens; each round then takes one Newton
step on all of them, the blocks of contexts on the executors and what blocks share summed
up in order. So the weights depend on the training texts alone, not on their partitions.
Scoring looks tables of log-probabilities up, for batches of documents as numpy arrays.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LONG_WORD, give_back, materialise, release, remainder, small_batches

SMOOTH = 0.1
SINGLES, ENDINGS = 39, 24  # classes: the end, SINGLES words, ENDINGS by ending
ALONE = 1 + SINGLES  # classes of one word; a leaf each
CLASSES = ALONE + ENDINGS
HEADS, MEMBERS = 40, 64  # members of an ending class: HEADS words, the rest hashed
LEAVES = ALONE + ENDINGS * MEMBERS
#: What can stand in a context: a leaf, or the start of the document.
KINDS, SKIPS = LEAVES + 1, CLASSES + 1
SLOTS = 16  # hashed pairs of a word and a skipped class, for each word
#: Words that every task holds; the counts of the others are joined.
FREQUENT = 200_000
ROUNDS, RATE, PRIOR, FARTHEST, PULL = 4, 0.5, 2.0, 1.0, 20.0
BLOCK = 50  # words of context in one row of the counts
SALTS = 64
LOT = 8_000_000
END = b""  # the end token among words: no word is empty

_SLOT = (np.arange(SKIPS) * 40503 >> 4) % SLOTS
#: Class of each leaf; the start's is one of its own.
_CLASS = np.concatenate((np.arange(ALONE), ALONE + np.arange(ENDINGS * MEMBERS) // MEMBERS, [CLASSES])).astype(np.int64)
_MEMBER = np.concatenate((np.zeros(ALONE), np.arange(ENDINGS * MEMBERS) % MEMBERS, [0])).astype(np.int64)
#: Leaves of one word: those have no share to score.
_SINGLE = np.concatenate((np.ones(ALONE, bool), np.arange(ENDINGS * MEMBERS) % MEMBERS < HEADS))
FIRST, SECOND = SKIPS * CLASSES, ENDINGS * MEMBERS  # cells of a word of context: of classes, of members


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


def hashed_leaf(word: bytes) -> int:
    """Leaf of a word that is no class and no head of one."""
    return ALONE + ending(word) * MEMBERS + HEADS + zlib.crc32(word) % (MEMBERS - HEADS)


# The lots are copied out with ``take``: string kernels of pyarrow 23 read a slice of
# large strings at a wrong offset.
def _lots(texts: pa.Array) -> Iterator[tuple[int, int]]:
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = size[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(size, done + LOT, "right")))
        yield at, stop
        at = stop


def tokens(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(codes of all tokens, the distinct words that codes index, where each text ends).

    A-Z in lower case; words between space and 9-13; after each text its end. Null: empty."""
    if texts.offset:  # see _lots
        texts = pc.take(texts, np.arange(len(texts)))
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    for blank in "\n\t\v\f\r":
        if pc.any(pc.match_substring(texts, blank)).as_py():
            texts = pc.replace_substring(texts, blank, " ")
    words = pc.split_pattern(texts, " ")
    ends = words.offsets.to_numpy()[1:].astype(np.int64) - words.offsets[0].as_py()
    coded = words.flatten().dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    distinct = [w.encode() for w in coded.dictionary.to_pylist()]
    if b"" in distinct:  # white space in a row, or at a text's ends, leaves empty strings
        empty = distinct.index(b"")
        there = codes != empty
        ends = np.concatenate(([0], np.cumsum(there)))[ends]
        codes = codes[there]
    else:
        empty = len(distinct)
        distinct.append(END)
    codes = np.insert(codes, ends, empty)  # and the empty string is the end token
    return codes, distinct, ends + np.arange(1, len(ends) + 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[bytes, int] = {}

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "c"])
        total.clear()
        return out

    for batch in batches:
        texts = batch.column("text")
        for a, b in _lots(texts):
            codes, distinct, _ = tokens(pc.take(texts, np.arange(a, b)))
            get = total.get
            for w, n in zip(distinct, np.bincount(codes, minlength=len(distinct)).tolist(), strict=True):
                if n:
                    total[w] = get(w, 0) + n
            long = sum(len(w) for w in distinct if len(w) > LONG_WORD)
            if len(total) > 600_000 or long > LOT // 4:
                yield flush()
    if total:
        yield flush()
    give_back()


@dataclass
class Vocabulary:
    """What each task needs of the counts: at most FREQUENT words and a few numbers."""

    n: int  # training tokens
    v: int  # distinct ones
    words: dict[bytes, int]  # frequent word to its index
    logs: np.ndarray  # log10(count + SMOOTH), by index
    leaves: np.ndarray  # leaf, by index
    log_totals: np.ndarray  # log10 of each hashed leaf's mass; 0 for leaves of one token

    @property
    def log_total(self) -> float:
        return float(np.log10(self.n + SMOOTH * (self.v + 1)))


def count_words(training: DataFrame) -> DataFrame:
    """(word, c) over all rows; partitions count before the shuffle. The end token is the empty word."""
    return training.select("text").mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, frequent: int = FREQUENT) -> Vocabulary:
    """Frequent words are those over a count that at most ``frequent`` exceed, found from
    a histogram of logarithms: a bounded number of rows reaches the driver."""
    level = F.floor(F.log2(F.col("c").cast("double")) * 16).cast("int")
    kind = F.pmod(F.crc32(F.substring("word", -2, 2)), F.lit(ENDINGS)).cast("int")
    part = F.pmod(F.crc32("word"), F.lit(MEMBERS - HEADS)).cast("int")
    stats = counts.groupBy(level.alias("level")).agg(F.count("*").alias("v"), F.sum("c").alias("n")).collect()
    n, v = sum(r["n"] for r in stats), sum(r["v"] for r in stats)
    held, floor = 0, None
    for r in sorted(stats, key=lambda r: -r["level"]):
        if held + r["v"] > frequent:
            break
        held, floor = held + r["v"], r["level"]
    top = [] if floor is None else [(bytes(r["word"]), r["c"]) for r in counts.filter((level >= floor) & (F.length("word") <= LONG_WORD)).collect()]
    if END not in dict(top):  # the end is always held, as often as there are training documents
        top += [(END, r["c"]) for r in counts.filter(F.length("word") == 0).collect()]
    top.sort(key=lambda x: (-x[1], x[0]))
    leaf: dict[bytes, int] = {END: 0}  # of words that are alone in theirs
    heads = [0] * ENDINGS
    for w, _ in top:
        if w == END:
            continue
        if len(leaf) < ALONE:
            leaf[w] = len(leaf)
        elif heads[k := ending(w)] < HEADS:
            leaf[w] = ALONE + k * MEMBERS + heads[k]
            heads[k] += 1
    mass = np.zeros((2, LEAVES))
    if n:
        for r in counts.groupBy(kind.alias("kind"), part.alias("part")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
            mass[:, ALONE + r["kind"] * MEMBERS + HEADS + r["part"]] = r["n"], r["v"]
        for w, c in top:
            if w in leaf:
                mass[:, hashed_leaf(w)] -= c, 1
    totals = np.where(_SINGLE, 0, np.log10(mass[0] + SMOOTH * (mass[1] + 1)))
    leaves = np.array([leaf[w] if w in leaf else hashed_leaf(w) for w, _ in top], np.uint16)
    logs = np.log10(np.array([c for _, c in top], float) + SMOOTH)
    return Vocabulary(n, v, {w: i for i, (w, _) in enumerate(top)}, logs, leaves, totals)


_CODED = "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, totals double, leaves binary, rare array<struct<word:binary,n:int>>"


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Vocabulary = shared.value
        logs, kinds = np.append(own.logs, 0.0), np.append(own.leaves, 0).astype(np.int64)
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column("text")
            for a, b in _lots(texts):
                codes, distinct, ends = tokens(pc.take(texts, np.arange(a, b)))
                index = np.fromiter((own.words.get(w, -1) for w in distinct), np.int64, len(distinct))
                kind = kinds[index]
                for i in np.flatnonzero(index < 0).tolist():
                    kind[i] = hashed_leaf(distinct[i]) if distinct[i] else 0
                known, leaves = index[codes] >= 0, kind[codes].astype(np.uint16)
                log, total = logs[index], own.log_totals[kind]
                if not own.n:  # nothing was learnt: the end is the one unknown token that isn't joined
                    log[distinct.index(END)] = np.log10(SMOOTH)
                starts = np.concatenate(([0], ends[:-1]))
                # A leaf of one token has no share to score: there ``totals`` takes its own log away again.
                sums = [np.add.reduceat(x[codes], starts) for x in (log, np.where(_SINGLE[kind], log, total))]
                doc = np.repeat(np.arange(len(ends)), ends - starts)
                joined = ~known & (codes != distinct.index(END))
                pairs, n = np.unique(doc[joined] * len(distinct) + codes[joined], return_counts=True)
                offsets = np.searchsorted(pairs, np.arange(len(ends) + 1) * len(distinct))
                rare = pa.StructArray.from_arrays([pa.array([distinct[i] for i in (pairs % len(distinct)).tolist()], pa.binary()), pa.array(n.astype(np.int32))], ["word", "n"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rid + np.arange(len(ends))),
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("held_out").slice(a, b - a),
                        pa.array(ends - starts),
                        pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                        *map(pa.array, sums),
                        pa.array([leaves[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), rare),
                    ],
                    [c.split()[0] for c in _CODED.split(", ")],
                )
                rid += len(ends)

    return run


def _contexts(seqs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: the leaf before it, the class before that, its own leaf; and where each document ends."""
    size = np.fromiter((len(s) // 2 for s in seqs), np.int64, len(seqs))
    pad = np.full(2, LEAVES, np.uint16).tobytes()
    line = np.frombuffer(b"".join(x for s in seqs for x in (pad, s)), np.uint16).astype(np.int64)
    at = np.arange(int(size.sum())) + np.repeat((np.arange(len(seqs)) + 1) * 2, size)
    return line[at - 1], _CLASS[line[at - 2]], line[at], np.cumsum(size)


def _cells(before: np.ndarray, skipped: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell of each token's class, cell of its member, which tokens have a member)."""
    kind = _CLASS[leaf]
    first = before * FIRST + skipped * CLASSES + kind
    inner = kind >= ALONE
    second = before * SECOND + (kind - ALONE) * MEMBERS + _MEMBER[leaf]
    return first, second, inner


_COUNTS = "block int, salt int, cells binary, counts binary"
_BLOCKS = -(-KINDS // BLOCK)


def _count_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's cells; those of members come after those of classes."""
    first, second = np.zeros(KINDS * FIRST, np.int32), np.zeros(KINDS * SECOND, np.int32)
    for batch in batches:
        seqs = batch.column("leaves").to_pylist()
        for i in range(0, len(seqs), 400):
            before, skipped, leaf, _ = _contexts(seqs[i : i + 400])
            a, b, inner = _cells(before, skipped, leaf)
            for held, cells in ((first, a), (second, b[inner])):
                at, n = np.unique(cells, return_counts=True)
                held[at] += n.astype(np.int32)
    salt = TaskContext.get().partitionId() % SALTS
    rows = []
    for k in range(_BLOCKS):
        parts = [held[k * BLOCK * width : (k + 1) * BLOCK * width] for held, width in ((first, FIRST), (second, SECOND))]
        dense = np.concatenate(parts)
        at = np.flatnonzero(dense)
        if len(at):
            rows.append((k, salt, at.astype(np.int32).tobytes(), dense[at].astype(np.int64).tobytes()))
    names = ["block", "salt", "cells", "counts"]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], names)
    give_back()


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(BLOCK * (FIRST + SECOND), np.int64)
    for cells, counts in zip(pdf["cells"], pdf["counts"], strict=True):
        total[np.frombuffer(cells, np.int32)] += np.frombuffer(counts, np.int64)
    at = np.flatnonzero(total)
    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "salt": [pdf["salt"].iloc[0]], "cells": [at.astype(np.int32).tobytes()], "counts": [total[at].tobytes()]})


def count_contexts(coded: DataFrame) -> DataFrame:
    """Counts of all (context, outcome) of the rows that aren't held out, a row for each
    block of contexts. Tasks add up first, then salts, then blocks: no row or group grows
    with the corpus beyond the number of cells and of tasks by salt."""
    part = coded.filter(~F.col("held_out")).select("leaves").mapInArrow(_count_contexts, _COUNTS)
    salted = part.groupBy("block", "salt").applyInPandas(_added, _COUNTS)
    return salted.withColumn("salt", F.lit(0)).groupBy("block").applyInPandas(_added, _COUNTS)


@dataclass
class Shared:
    """The weights that all blocks share."""

    bias: np.ndarray  # (classes)
    skip: np.ndarray  # (skipped class, classes)
    kind: np.ndarray  # (ending class, members)


@dataclass
class Own:
    """The weights of some words of context: 13 MB for all of them."""

    word: np.ndarray  # (word before, classes)
    pair: np.ndarray  # (word before, slot of the skipped class, classes)
    inner: np.ndarray  # (word before, ending class, members)

    def bytes(self) -> bytes:
        return np.concatenate([x.ravel() for x in (self.word, self.pair, self.inner)]).astype(np.float32).tobytes()

    @classmethod
    def of(cls, raw: bytes, many: int) -> Own:
        parts = np.split(np.frombuffer(raw, np.float32), np.cumsum([many * CLASSES, many * SLOTS * CLASSES]))
        return cls(*(x.reshape(many, *shape) for x, shape in zip(parts, ((CLASSES,), (SLOTS, CLASSES), (ENDINGS, MEMBERS)), strict=True)))


def logits(own: Own, all_: Shared) -> tuple[np.ndarray, np.ndarray]:
    """(word before, skipped class, class) and (word before, ending class, member)."""
    return all_.bias + all_.skip + own.word[:, None, :] + own.pair[:, _SLOT, :], all_.kind + own.inner


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(-1, keepdims=True)
    return z - np.log(np.exp(z).sum(-1, keepdims=True))


def newton(w: np.ndarray, gradient: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    """Weights after one step: by each weight's own curvature, with a Gaussian prior, and of a
    bounded length; RATE allows for the features of a token that move together."""
    step = RATE * (gradient + PRIOR * w) / (curvature + PRIOR)
    return w - np.clip(step, -FARTHEST, FARTHEST)


def _many(block: int) -> int:
    return min(KINDS, (block + 1) * BLOCK) - block * BLOCK


def _seen(block: int, cells: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Counts of a block: (word before, skipped class, class) and (word before, ending class, member)."""
    many = _many(block)
    dense = np.zeros(many * (FIRST + SECOND))
    dense[np.frombuffer(cells, np.int32)] = np.frombuffer(counts, np.int64)
    return dense[: many * FIRST].reshape(many, SKIPS, CLASSES), dense[many * FIRST :].reshape(many, ENDINGS, MEMBERS)


def _totals(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        out = []
        for row in zip(pdf["block"], pdf["cells"], pdf["counts"], strict=True):
            first, second = _seen(*row)
            out.append((row[0], np.concatenate((first.sum((0, 1)), second.sum(0).ravel())).tobytes()))
        yield pd.DataFrame(out, columns=["block", "common"])


def _summed(rows: pd.DataFrame) -> np.ndarray:
    """The sums of all blocks, in their order."""
    return np.sum([np.frombuffer(x) for x in rows.sort_values("block")["common"]], 0)


def _step(shared):
    """A block with the new weights of its own features, and the gradient and curvature of
    those that blocks share. A block without weights starts from its smoothed shares."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_: Shared = shared.value
        slots = np.eye(SLOTS)[_SLOT]  # (skipped class, slot)
        for pdf in parts:
            out = []
            for block, cells, counts, raw in zip(pdf["block"], pdf["cells"], pdf["counts"], pdf["own"], strict=True):
                seen = _seen(block, cells, counts)
                if raw:
                    own = Own.of(raw, _many(block))
                else:
                    starts = [np.log((n + PULL * np.exp(q)) / (n.sum(-1, keepdims=True) + PULL)) - q for n, q in ((seen[0].sum(1), _log_softmax(all_.bias)), (seen[1], _log_softmax(all_.kind)))]
                    own = Own(starts[0], np.zeros((_many(block), SLOTS, CLASSES)), starts[1])
                slopes = []
                for found, z in zip(seen, logits(own, all_), strict=True):
                    p, n = np.exp(_log_softmax(z)), found.sum(-1, keepdims=True)
                    slopes.append((n * p - found, n * p * (1 - p)))
                (g, h), (g2, h2) = slopes
                new = Own(newton(own.word, g.sum(1), h.sum(1)), newton(own.pair, *(np.einsum("ks,wkc->wsc", slots, x) for x in (g, h))), newton(own.inner, g2, h2))
                common = np.concatenate([x.sum(0).ravel() for x in (g, h, g2, h2)])
                out.append((block, cells, counts, new.bytes(), common.tobytes()))
            yield pd.DataFrame(out, columns=["block", "cells", "counts", "own", "common"])

    return run


def train(counts: DataFrame, rounds: int = ROUNDS) -> tuple[Shared, Own]:
    """Weights from the table of ``count_contexts``. Each round reads all of it and writes it
    with the blocks' new weights; what blocks share, some 100 KB a block, reaches the driver."""
    spark = counts.sparkSession
    first = counts.mapInPandas(_totals, "block int, common binary").toPandas()
    everywhere = Own(np.zeros((KINDS, CLASSES), np.float32), np.zeros((KINDS, SLOTS, CLASSES), np.float32), np.zeros((KINDS, ENDINGS, MEMBERS), np.float32))
    all_ = Shared(np.zeros(CLASSES), np.zeros((SKIPS, CLASSES)), np.zeros((ENDINGS, MEMBERS)))
    if not len(first):
        return all_, everywhere
    total = _summed(first)
    all_.bias = np.log((total[:CLASSES] + 1) / (total[:CLASSES].sum() + CLASSES))
    members = total[CLASSES:].reshape(ENDINGS, MEMBERS)
    all_.kind = np.log((members + 1) / (members.sum(1, keepdims=True) + MEMBERS))
    state, at = counts.select("block", "cells", "counts", F.lit(b"").alias("own")), None
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(all_)
        old, (state, new) = at, materialise(state.select("block", "cells", "counts", "own").mapInPandas(_step(shared), "block int, cells binary, counts binary, own binary, common binary"), "weights")
        g, h, g2, h2 = np.split(_summed(state.select("block", "common").toPandas()), np.cumsum([FIRST, FIRST, SECOND]))
        g, h = (x.reshape(SKIPS, CLASSES) for x in (g, h))
        g2, h2 = (x.reshape(ENDINGS, MEMBERS) for x in (g2, h2))
        all_ = Shared(newton(all_.bias, g.sum(0), h.sum(0)), newton(all_.skip, g, h), newton(all_.kind, g2, h2))
        shared.destroy()
        if old:
            release(spark, old)
        at = new
    if rounds:
        for block, raw in state.select("block", "own").toPandas().itertuples(index=False):
            own, of = Own.of(raw, _many(block)), slice(block * BLOCK, block * BLOCK + _many(block))
            everywhere.word[of], everywhere.pair[of], everywhere.inner[of] = own.word, own.pair, own.inner
        release(spark, at)
    return all_, everywhere


def tables(all_: Shared, own: Own) -> tuple[np.ndarray, np.ndarray]:
    """Natural logs of the probability of each cell: of classes and of members."""
    out: tuple[list, list] = ([], [])
    for k in range(0, KINDS, BLOCK):
        part = Own(own.word[k : k + BLOCK], own.pair[k : k + BLOCK], own.inner[k : k + BLOCK])
        for held, z in zip(out, logits(part, all_), strict=True):
            held.append(_log_softmax(z).astype(np.float32).ravel())
    return np.concatenate(out[0]), np.concatenate(out[1])


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = tables(*shared.value)
        for batch in batches:
            seqs = batch.column("leaves").to_pylist()
            out = []
            for i in range(0, len(seqs), 400):
                before, skipped, leaf, ends = _contexts(seqs[i : i + 400])
                a, b, inner = _cells(before, skipped, leaf)
                own = first[a].astype(np.float64)
                own[inner] += second[b[inner]]
                out.append(np.add.reduceat(own, np.concatenate(([0], ends[:-1]))) / np.log(10))
            names = ["rid", "doc_id", "held_out", "n_tokens", "n_known", "logs", "totals"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(np.concatenate(out) if out else np.empty(0))], [*names, "class_score"])
        give_back()

    return run


def score(docs: DataFrame, frequent: int = FREQUENT, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Learns from rows whose crc32 of doc_id modulo 10 is not 0 (null id: the empty text,
    so held out). Null text: empty, one end token. Repeated rows count and score each.
    With nothing to learn from, every token is unknown. Other columns are left out; an
    empty table stays empty. Whole texts; no count or document is left out. However the
    table is partitioned, scores agree up to rounding.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (remainder("doc_id", 10) == 0).alias("held_out"))
    counts, _ = materialise(count_words(rows.filter(~F.col("held_out"))), "counts")
    vocab = vocabulary(counts, frequent)
    shared = spark.sparkContext.broadcast(vocab)
    coded, _ = materialise(rows.select("doc_id", "text", "held_out").mapInArrow(_encode(shared), _CODED), "coded")
    contexts, at = materialise(count_contexts(coded), "contexts")
    weights = train(contexts, rounds)
    release(spark, at)
    rare = coded.select("rid", F.explode("rare").alias("r")).select("rid", F.col("r.word").alias("word"), F.col("r.n").alias("n"))
    # Many rows hold one rare word at most a few times; the frequent ones never get here.
    found = rare.join(counts, "word", "left").select("rid", "n", F.coalesce("c", F.lit(0)).alias("c"))
    per_doc = found.groupBy("rid").agg(F.sum(F.col("n") * F.log10(F.col("c") + SMOOTH)).alias("rare_logs"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"))
    scored = coded.select("rid", "doc_id", "held_out", "n_tokens", "n_known", "logs", "totals", "leaves").mapInArrow(
        _score(spark.sparkContext.broadcast(weights)), "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, totals double, class_score double"
    )
    out = scored.join(per_doc, "rid", "left")
    all_logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"),
        (all_logs - F.col("n_tokens") * vocab.log_total).alias("base_score"),
        (F.col("class_score") + all_logs - F.col("totals")).alias("score"),
    )
