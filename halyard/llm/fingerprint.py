"""Operator 7, document fingerprints: a threshold-scaled sketch.

A text's fingerprint keeps every hash of its five-word shingles below a fixed fraction of
the hash space, the same for all texts. Sketches are uniform samples of the shingle sets,
so resemblance and containment can be estimated between texts of very unequal length, and
the sketch of a union is the union of the sketches.

The error follows from the fraction: of n shingles some n / SCALE are kept, so a
resemblance J is estimated to about ``sqrt(J (1 - J) SCALE / n)``: 0.11 for 150 words at
J = 0.8, 0.03 for 2,000. A text of few shingles may keep none; it keeps its smallest hash
instead, which tells equal short texts from others and is an estimate of 0 or 1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LONG_WORD, ascii_words, give_back, small_batches

SHINGLE, SCALE = 5, 8
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
MAX_WORDS = 150_000


class _WordHashes(dict):
    """Word to 64-bit hash; bounded: emptied when it holds MAX_WORDS."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= LONG_WORD:
            self[word] = h
        return h


_words = _WordHashes()


def forget() -> None:
    """Empty the cache at the end of a task."""
    _words.clear()
    give_back()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _ODD[1]
    h = (h ^ (h >> np.uint64(27))) * _ODD[2]
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer words make one shingle, no word none."""
    words = ascii_words(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(min(k, len(h))):
        out = out * _ODD[0] + h[j : j + n]
    return np.unique(_mix(out + np.uint64(min(k, len(h)))))


def below(kept: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The part of a sketch under the threshold: all but a stand-in."""
    return kept[: np.searchsorted(kept, np.uint64(2**64 // scale - 1), "right")]


def sketch(hashes: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Of sorted distinct hashes all below the fixed fraction; where there is none, the smallest."""
    kept = below(hashes, scale)
    return kept if len(kept) else hashes[:1]


def encode(kept: np.ndarray) -> str:
    """Hexadecimal: the kept hashes in order, 16 digits each; empty for a text without a word."""
    return kept.astype(">u8").tobytes().hex()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of the union of two shingle sets."""
    return sketch(np.union1d(a, b), scale)


def compare(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> tuple[float, float, float]:
    """Estimates (resemblance, share of a's shingles in b, share of b's in a), 0 to 1.

    Two texts without a word are alike (1); one and another are not (0). Where neither has a
    hash below the threshold, their smallest hashes agree (1) or not (0)."""
    x, y = below(a, scale), below(b, scale)
    if not len(x) and not len(y):
        alike = float(np.array_equal(a, b))
        return alike, alike, alike
    at = np.searchsorted(y, x)
    hit = np.zeros(len(x), bool)
    if len(y):
        inside = at < len(y)
        hit[inside] = y[at[inside]] == x[inside]
    both = int(hit.sum())
    return both / (len(x) + len(y) - both), both / len(x) if len(x) else 0.0, both / len(y) if len(y) else 0.0


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, contained_edited double, contained_next double"


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by bucket and descending id; a bucket's last row is the first of the
    next bucket, there only to be a neighbour (``own`` false). One row is carried."""
    last: tuple | None = None

    def row(cur, nxt):
        doc_id, text, s = cur
        _, other, s2 = nxt
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        e = sketch(shingle_hashes(edited))
        a, b = compare(s, e), compare(s, s2)
        return doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), encode(s), encode(e), a[0], b[0], max(a[1:]), max(b[1:])

    for pdf in batches:
        out = []
        for bucket, own, doc_id, text in zip(pdf["_bucket"], pdf["_own"], pdf["doc_id"], pdf["text"], strict=True):
            cur = (None if pd.isna(doc_id) else int(doc_id), text, sketch(shingle_hashes(text)))
            if last is not None and last[0] == bucket:
                out.append(row(last[1], cur))
            last = (bucket, cur) if own else None
        # pyarrow keeps null ids whole; a float column would not
        yield pd.DataFrame({c: pd.Series(v, dtype="Int64" if c == "doc_id" else None) for c, v in zip(_COLUMNS, zip(*out, strict=True), strict=True)} if out else {c: [] for c in _COLUMNS})
    forget()


_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how alike they and the next text are.

    The next document, in descending doc_id (after the last: the first), is found
    without one global sort: ids are cut into ranges at approximate quantiles, each
    range also gets the first row of the following one, and each is sorted by itself and
    streamed. Null text: empty. Null ids come last; equal ids stand in order of their text.
    One document: it is its own next. An empty table gives an empty result. Other
    columns are left out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    many = buckets or 4 * n
    # Two lists of at most ``many`` numbers reach the driver, whatever the input.
    cuts = ids.select(F.percentile_approx("doc_id", [i / many for i in range(1, many)] or [0.5], 10_000)).first()[0]
    bucket = _bucket(sorted(set(cuts or [])))
    tops = sorted((r["_bucket"], r["doc_id"]) for r in ids.select("doc_id", bucket.alias("_bucket")).groupBy("_bucket").agg(F.max("doc_id").alias("doc_id")).collect())
    heads = spark.createDataFrame([(top, tops[i - 1][0]) for i, (_, top) in enumerate(tops)], "_head long, _also int")
    also = own.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("_head")), "left")
    copies = F.array(F.struct(bucket.alias("b"), F.lit(True).alias("own")), F.struct(F.col("_also").alias("b"), F.lit(False).alias("own")))
    rows = also.select("doc_id", "text", F.explode(copies).alias("_at")).select("doc_id", "text", F.col("_at.b").alias("_bucket"), F.col("_at.own").alias("_own")).filter("_bucket IS NOT NULL")
    dealt = rows.repartition(n, "_bucket").sortWithinPartitions(F.col("_bucket"), F.col("_own").desc(), F.col("doc_id").desc_nulls_last(), F.col("text"))
    return dealt.mapInPandas(_compared, SCHEMA)


def _bucket(cuts: list[int]):
    """Number of cuts not below the id, as a balanced tree of comparisons: the largest ids are in bucket 0, null in the last."""

    def tree(lo: int, hi: int):
        if lo == hi:
            return F.lit(len(cuts) - lo)
        mid = (lo + hi) // 2
        return F.when(F.col("doc_id") > cuts[mid], tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(tree(0, len(cuts))).cast("int")
