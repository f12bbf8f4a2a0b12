"""The corpus pipeline's near-duplicate stage: one document of each group of copies stays.

Copies are texts whose sets of five-word shingles are alike to 0.8 or more. Equal texts are
one node. Nodes meet on keys of two kinds:

- ball hashing (operator 8) on a SimHash of the shingles: halves emit their balls of radius
  1, and each sharer of a half's variant meets the variant's leader. That settles the dense
  groups of very near copies in one pass. Texts alike to 0.8 are some ten bits apart, which
  no small radius reaches, so the rest is left to
- prefix keys: in one order of all shingles, two sets of this similarity share one of their
  first ``n - 0.8 n + 1``, whatever the edit. No pair is missed.

On prefix keys, too, sharers first meet their key's leader. Then every key whose sharers
are still in several components is gone through pair by pair, between components alone.
That is one rule for keys of any size: nothing is capped, and a large group of copies around
one original costs one pair a member. A key of many texts that are all unlike costs their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from . import fingerprint
from .common import boxed, bucketed, materialise, quoted, release, small_batches
from .fingerprint import shingle_hashes
from .simhash import ball_keys, bits_of, components, leaders, open_pairs

#: Resemblance of five-word shingle sets. On the SKETCH smallest hashes an estimate that is
#: CLEAR standard errors off decides a pair; all others are compared on their whole sets.
SIMILARITY, SKETCH, WORDS, CLEAR, RADIUS = 0.8, 256, 5, 5, 4
#: The commonest shingles come last in the order of all shingles. They are counted on one text
#: in ORDERED, and those seen SEEN times there are broadcast, at most COMMON of them: a share of
#: the texts and not a number, so that the same frequency counts as common at every size. They
#: decide speed, not results.
ORDERED, SEEN, COMMON = 8, 4, 200_000
#: Room for rounding in sums and products of whole numbers with the similarity.
ROUNDING = 1e-6


@F.pandas_udf(T.ArrayType(T.LongType()))
def _shingles(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in parts:
        yield pd.Series([shingle_hashes(t, WORDS).view(np.int64) for t in texts])
    fingerprint.forget()


def common_shingles(texts: DataFrame, every: int = ORDERED) -> np.ndarray:
    """The commonest shingles of a sample of (text, node), rarest first."""
    some = texts.filter(F.pmod(F.xxhash64(F.lit(8), "node"), F.lit(every)) == 0).dropDuplicates(["node"])
    counts = some.select(F.explode(_shingles("text")).alias("h")).groupBy("h").count().filter(F.col("count") >= SEEN)
    top = counts.orderBy(F.desc("count"), "h").limit(COMMON).toPandas()
    return top["h"].to_numpy(np.int64)[::-1].view(np.uint64)


def prefix(hashes: np.ndarray, keys: np.ndarray, ranks: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The first shingles of a set, in one order for all texts (``ranks`` of the common
    ``keys``, all others before them by hash): as many as two sets of this resemblance
    can't both do without a common one."""
    at = np.searchsorted(keys, hashes)
    rank = np.zeros(len(hashes), np.int64)
    inside = at < len(keys)
    inside[inside] = keys[at[inside]] == hashes[inside]
    rank[inside] = 1 + ranks[at[inside]]
    most = len(hashes) - int(np.ceil(similarity * len(hashes) - ROUNDING)) + 1
    return hashes[np.argsort(rank, kind="stable")[: most if len(hashes) else 0]]


def _traits(spark, common: np.ndarray, similarity: float):
    """A column function: text to its number of shingles, SimHash, prefix and sketch (32 bits a hash, in order)."""
    order = np.argsort(common)
    shared = spark.sparkContext.broadcast((common[order], order))

    @F.pandas_udf("n int, fp long, prefix array<long>, sketch binary")
    def traits(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        keys, ranks = shared.value
        for texts in parts:
            out = []
            for t in texts:
                h = shingle_hashes(t, WORDS)
                out.append((len(h), bits_of(h), prefix(h, keys, ranks, similarity).view(np.int64), (h[:SKETCH] >> np.uint64(32)).astype(np.uint32).tobytes()))
            yield pd.DataFrame(out, columns=["n", "fp", "prefix", "sketch"])
        fingerprint.forget()

    return traits


def judge(x: bytes, y: bytes, nx: int, ny: int, similarity: float = SIMILARITY) -> int:
    """What two sketches say: 1 alike, 0 not, 2 not clear."""
    if min(nx, ny) < similarity * max(nx, ny) - ROUNDING:
        return 0
    a, b = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
    # Up to the smaller last hash of a cut sketch both are whole.
    ends = [s[-1] for s, n in ((a, nx), (b, ny)) if n > len(s)]
    if ends:
        a, b = (s[: np.searchsorted(s, min(ends), "right")] for s in (a, b))
    # Two hashes of a set may agree in 32 bits: an error of a few in the counts, well within the room.
    both = len(np.intersect1d(a, b))
    union = max(1, len(a) + len(b) - both)
    room = CLEAR * (similarity * (1 - similarity) / union) ** 0.5 if ends else 3 / union
    return 2 if abs(both / union - similarity) <= room else int(both / union > similarity)


def _verdicts(similarity: float):
    @F.pandas_udf("int")
    def verdicts(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for columns in parts:
            yield pd.Series([judge(*row, similarity) for row in zip(*columns, strict=True)], dtype="int32")

    return verdicts


def judged(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """(a, b, says): pairs with what their sketches say, without those that are clearly unlike."""
    x = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("x"), F.col("n").alias("nx"))
    y = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("y"), F.col("n").alias("ny"))
    both = pairs.join(x, "a").join(y, "b")
    return materialise(both.select("a", "b", _verdicts(similarity)("x", "y", "nx", "ny").alias("says")).filter("says > 0"), "judged")[0]


@F.pandas_udf(T.BinaryType())
def _whole(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """All shingle hashes of a text."""
    for texts in parts:
        yield pd.Series([shingle_hashes(t, WORDS).tobytes() for t in texts])
    fingerprint.forget()


def _alike(similarity: float):
    """A column function: whether two whole shingle sets have the similarity."""

    @F.pandas_udf("boolean")
    def alike(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for xs, ys in parts:
            out = []
            for x, y in zip(xs, ys, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(both >= similarity * (len(x) + len(y) - both) - ROUNDING)
            yield pd.Series(out, dtype="bool")

    return alike


def confirmed(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of the pairs that have the similarity; those that sketches leave open are
    compared on the whole sets, for which the texts of their nodes are fetched once."""
    said = judged(pairs, nodes, similarity)
    unclear = said.filter("says = 2")
    wanted = unclear.select(F.explode(F.array("a", "b")).alias("_w")).distinct()
    mine = nodes.join(wanted, F.col("node") == F.col("_w"), "left_semi").select(F.col("node").alias("_node"), F.col("id").alias("_id"))
    # By id and text, so that equal texts are fetched once.
    one = texts.join(mine, (F.col("node") == F.col("_node")) & F.col("id").eqNullSafe(F.col("_id")), "left_semi").dropDuplicates(["node"])
    sets, at = materialise(one.select("node", _whole("text").alias("hashes")), "sets")
    x, y = (sets.select(F.col("node").alias(k), F.col("hashes").alias(h)) for k, h in (("a", "x"), ("b", "y")))
    same = unclear.join(x, "a").join(y, "b").filter(_alike(similarity)("x", "y")).select("a", "b")
    out, _ = materialise(said.filter("says = 1").select("a", "b").unionByName(same), "same")
    release(texts.sparkSession, at)
    return out


def _may_match(similarity: float):
    """Of x and y, met on the first shingle that they share: their sizes and what is left
    of both after this shingle allow the similarity."""
    x, y = (lambda c, s=s: F.col(f"{s}.{c}") for s in "xy")
    sizes = F.greatest(x("n"), y("n")) * F.lit(similarity) <= F.least(x("n"), y("n")) + F.lit(ROUNDING)
    left = F.least(x("n") - x("pos"), y("n") - y("pos")) >= (x("n") + y("n")) * F.lit(similarity / (1 + similarity)) - F.lit(ROUNDING)
    return sizes & left


def with_roots(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the component of their node; a node without links is its own."""
    own = found.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return rows.join(own, F.col("node") == F.col("_node"), "left").withColumn("root", F.coalesce("_root", "node")).drop("_node", "_root")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each group of exact and near copies, with all columns: the smallest doc_id.

    Groups are the components of all pairs of the similarity (see the module). Equal texts
    (by a 64-bit hash) are one node; null counts as empty. Texts without a word have no
    shingles and are copies only of equal ones. A null doc_id comes after all others; of
    repeated rows one stays. An empty table stays empty; columns of any names are kept as they are.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = boxed(docs, id=F.col("doc_id").cast("long"), node=F.xxhash64(text), text=text)
    texts = rows.select("id", "node", "text")
    common = common_shingles(texts)
    # Copies agree in all but their id: the first traits will do for each node.
    traits = texts.select("id", "node", _traits(spark, common, similarity)("text").alias("t")).select("id", "node", "t.*")
    first = [F.first(c).alias(c) for c in ("n", "fp", "prefix", "sketch")]
    nodes, drop = bucketed(traits.groupBy("node").agg(F.min("id").alias("id"), *first), "node")

    ball = nodes.filter("n > 0").select("node", "fp", F.explode(ball_keys(F.col("fp"), RADIUS)).alias("key"))
    lead = F.first(F.struct("node", "fp")).over(W.partitionBy("key").orderBy("node"))
    met = ball.withColumn("lead", lead).filter(f"node != lead.node AND bit_count(fp ^ lead.fp) <= {RADIUS}")
    pairs, at = materialise(met.select(F.col("lead.node").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    # What isn't clear here is met again on prefix keys.
    near = judged(pairs, nodes, similarity).filter("says = 1").select("a", "b")
    release(spark, at)

    keyed = with_roots(nodes, components(near)).select("node", "root", "n", F.posexplode("prefix").alias("pos", "key"))
    whole = W.partitionBy("key")
    met, at = materialise(keyed.withColumn("_split", F.min("root").over(whole) != F.max("root").over(whole)).filter("_split").drop("_split"), "met")
    star, star_at = materialise(leaders(met, "root").filter("root != lead.root").select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")).distinct(), "star")
    near = near.unionByName(confirmed(star, nodes, texts, similarity))
    rest = open_pairs(with_roots(met.drop("root"), components(near)), _may_match(similarity)).join(star, ["a", "b"], "left_anti")
    rest, rest_at = materialise(rest, "rest")
    found = components(near.unionByName(confirmed(rest, nodes, texts, similarity)))
    release(spark, at, star_at, rest_at)

    # Of each group the smallest id (null last), then the smallest node.
    best = F.min(F.struct(F.col("id").isNull().alias("late"), "id", "node")).alias("k")
    kept, _ = materialise(with_roots(nodes.select("node", "id"), found).groupBy("root").agg(best).select(F.col("k.node").alias("_node"), F.col("k.id").alias("_id")), "kept")
    drop()
    # By id and text: a group of equal texts is spread by its ids, and one of them is left.
    chosen = rows.join(kept, (F.col("node") == F.col("_node")) & F.coalesce("id", F.lit(0)).eqNullSafe(F.coalesce("_id", F.lit(0))) & (F.col("id").isNull() == F.col("_id").isNull()), "left_semi")
    same = W.partitionBy("node", F.coalesce("id", F.lit(0))).orderBy(F.xxhash64(*[F.col(f"row.{quoted(c)}") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]))
    return chosen.withColumn("_rank", F.row_number().over(same)).filter("_rank = 1").select("row.*")
