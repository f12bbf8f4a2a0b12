"""Operator 8, SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at Hamming distance ``2r`` or less have a point between them within
``r`` of both, so if each emits its ball of radius ``r`` they meet on a shared variant.

A ball of radius 2 over 64 bits has 2081 variants, too much to shuffle for every
fingerprint. So the bits are cut into two halves: at distance 4 or less one half is at
distance 2 or less, and the halves' balls of radius 1 (33 variants each) meet. Pairs
that share a half's variant are verified on all 64 bits: first each sharer with one
leader of the variant, then, where that leaves the sharers in several components, those
of different components with each other. Nothing is capped and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .common import ascii_words, materialise, release, small_batches

SHINGLE, SEED, RADIUS = 4, 42, 4


def simhash(text: str | None, k: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits: a bit is 1 if set in over half the XXH64 hashes of the k-word shingles,
    repeats included. Fewer words: one shingle of all of them; none: 0."""
    words = ascii_words(text)
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= k:
        hashes = [xxhash.xxh64_intdigest(line, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[:-k].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], seed) for a, b in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=True)]
    return bits_of(np.array(hashes, np.uint64)) % (1 << 64)


def bits_of(hashes: np.ndarray) -> int:
    """64 bits, as a signed number: a bit is 1 if set in over half the hashes."""
    raw = hashes.astype(">u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(raw), 65_536):
        bits = np.unpackbits(raw[i : i + 65_536].view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(raw)).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def fingerprint_udf(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """SimHash as a signed long (its 64 bits unchanged)."""
    for texts in parts:
        yield pd.Series(np.array([simhash(t) for t in texts], np.uint64).view(np.int64))


def _flips(bits: range, radius: int) -> list[int]:
    """Masks of up to ``radius`` flipped bits, as signed 64-bit numbers."""
    masks = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(bits, r)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _ball(fp, masks: list[int]):
    return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: fp.bitwiseXOR(m))


def ball_keys(fp, radius: int = RADIUS):
    """The variants of both halves of a fingerprint column, as an array of longs: any two
    fingerprints within ``radius`` bits share one."""
    half, low = radius // 2, (1 << 32) - 1
    near = -(-half // 2)  # a half at distance <= half has its middle within this
    return F.concat(
        F.transform(_ball(fp, _flips(range(32), near)), lambda v: v.bitwiseAND(F.lit(low).cast("long"))),
        F.transform(_ball(fp, _flips(range(32, 64), near)), lambda v: F.shiftrightunsigned(v, 32).bitwiseOR(F.lit(1 << 32).cast("long"))),
    )


def leaders(met: DataFrame, *carried: str) -> DataFrame:
    """Rows of (key, node, ...) but the leaders, with ``lead``: of each key's sharers the one
    with the most shared keys, as the copies of one original meet around it.

    Leaders come from an aggregate that is combined before its shuffle, and are joined on,
    so that the rows of a hot key can be split over tasks."""
    around = met.withColumn("_around", F.count("*").over(W.partitionBy("node")))
    lead = around.groupBy(F.col("key").alias("_key")).agg(F.max(F.struct("_around", "node", *carried)).alias("lead"))
    return around.join(lead, F.col("key") == F.col("_key")).filter("node != lead.node").drop("_key", "_around")


def open_pairs(met: DataFrame, may) -> DataFrame:
    """Distinct (a, b) of the sharers x and y of a key (key, node, root, ...) that are in
    different components and for which ``may`` holds."""
    whole = W.partitionBy("key")
    split = met.withColumn("_split", F.min("root").over(whole) != F.max("root").over(whole)).filter("_split").drop("_split")
    split, _ = materialise(split, "open")
    met_on = (F.col("x.key") == F.col("y.key")) & (F.col("x.root") < F.col("y.root")) & may
    both = split.alias("x").join(split.alias("y"), met_on)
    return both.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) of distinct nodes of (node, fp), all within ``radius`` bits: enough of them
    that their components are those of all links within ``radius``.

    The sharers of a half's variant meet its leader first. Variants whose sharers are then
    still in several components are gone through pair by pair, between components alone:
    the pairs left out are within one component already. One rule for groups of any size.
    """
    if radius not in (2, 4):
        raise ValueError("radius: 2 or 4")
    ball = nodes.select("node", "fp", F.explode(ball_keys(F.col("fp"), radius)).alias("key"))
    met, at = materialise(ball.withColumn("_n", F.count("*").over(W.partitionBy("key"))).filter("_n > 1").drop("_n"), "met")
    star = leaders(met, "fp").filter(f"bit_count(fp ^ lead.fp) <= {radius}")
    star, _ = materialise(star.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct(), "star")
    own = components(star).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    rooted = met.join(own, F.col("node") == F.col("_node"), "left").select("key", "node", "fp", F.coalesce("_root", "node").alias("root"))
    near = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= radius
    rest, _ = materialise(open_pairs(rooted, near), "rest")
    release(nodes.sparkSession, at)
    return star.unionByName(rest).distinct()


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating star algorithm: ``u`` hands its neighbours (the large
    step: those above it; the small step: those below) over to the smallest of them and itself."""
    if large:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    joined = sides.join(least, F.col("u") == F.col("_u"))
    if large:
        return joined.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
    return joined.select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a != b").union(least.filter("_u != m").select("m", "_u")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of (a, b) can reach, itself included.

    Alternating large and small stars: the number of rounds grows as the logarithm of
    the input. Each round's edges are a table in the shared folder, the one before is
    deleted; the driver sees two numbers a round.
    """
    now, at = materialise(edges.select("a", "b").distinct(), "edges")
    mark = None
    while True:
        got = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(got) == mark or not got[0]:
            break
        mark = tuple(got)
        before = at
        now, at = materialise(_stars(_stars(now, True), False), "edges")
        release(now.sparkSession, before)
    # Settled: each edge leads from a root to one of its nodes.
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(now.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row, over whole texts.

    Null or empty text, or one without words: fingerprint zero, linked like any other.
    component_id: the smallest non-null doc_id reachable (null if all are null).
    Repeated rows are returned each. Other columns are left out.
    """
    small_batches(docs.sparkSession)
    rows, _ = materialise(docs.select("doc_id", fingerprint_udf("text").alias("fp")), "fingerprints")
    nodes = rows.select(F.col("fp").alias("node"), "fp").distinct()
    found = components(links(nodes, radius))
    reps = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    joined = reps.join(found, reps["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = joined.join(smallest, "root").select(F.col("fp").alias("_fp"), "component_id")
    out = rows.join(by_fp, rows["fp"] == by_fp["_fp"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
