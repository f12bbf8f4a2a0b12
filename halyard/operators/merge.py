"""Upserts, deduplication, change feeds and surrogate keys without a transactional format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from halyard.functions import record_hash


class AmbiguousMerge(ValueError):
    """A batch holds a key more than once."""


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first in ``order``, which should be total."""
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def check_unique(df: DataFrame, keys: list[str]) -> None:
    twice = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise AmbiguousMerge(f"more than one row for {twice[0].asDict()}")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], deleted: str | None = None) -> DataFrame:
    """Target rows replaced by the batch's where the key is in it; new keys added.

    ``deleted``: a boolean column of the batch that takes the key out. One full outer join
    by key, where null is a key like any other; equal reruns give equal tables. The batch must
    hold a key once (see check_unique).
    """
    names = target.columns
    incoming = batch.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_new"), *[F.col(f"`{k}`").alias(f"_nk{i}") for i, k in enumerate(keys)], (F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)).alias("_gone"))
    existing = target.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_old"), *[F.col(f"`{k}`").alias(f"_ok{i}") for i, k in enumerate(keys)])
    on = [F.col(f"_nk{i}").eqNullSafe(F.col(f"_ok{i}")) for i in range(len(keys))]
    joined = existing.join(incoming, on, "full")
    kept = joined.filter(~F.coalesce(F.col("_gone"), F.lit(False)))
    return kept.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")


def merge_actions(target: DataFrame, batch: DataFrame, keys: list[str], compared: list[str]) -> DataFrame:
    """(keys, action): insert, update or unchanged for each key of the batch, by record hash."""
    old = target.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], record_hash(compared).alias("_old"))
    new = batch.select(*keys, record_hash(compared).alias("_new"))
    met = new.join(old, [new[k] == old[f"_k{i}"] for i, k in enumerate(keys)], "left")
    action = F.when(F.col("_old").isNull(), "insert").when(F.col("_old") == F.col("_new"), "unchanged").otherwise("update")
    return met.select(*[new[k] for k in keys], action.alias("action"))


def net_changes(feed: DataFrame, keys: list[str], seq: str, op: str = "op") -> DataFrame:
    """The last change of each key of a change feed; deletes stay, as deletes."""
    return latest(feed, keys, [F.col(seq).desc(), F.col(op).desc()])


def surrogate_keys(new: DataFrame, key: str, out: str, existing: DataFrame | None = None) -> DataFrame:
    """Rows of ``new`` whose key isn't in ``existing``, numbered on from its highest number.

    Without ``existing``, from 1. The numbers are dense, in order of (cell, key), where a
    key's cell is 16 bits of its MD5: ranks within the cells plus the sizes of the cells
    before. No global sort, and keys that look alike don't meet in one task.
    """
    if existing is not None:
        new = new.join(existing.select(F.col(key).alias("_seen")), F.col(key) == F.col("_seen"), "left_anti")
        start = existing.agg(F.max(out)).first()[0] or 0
        start = max(start, 0)
    else:
        start = 0
    cell = new.withColumn("_cell", F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 4))
    sizes = cell.groupBy("_cell").agg(F.count("*").alias("_n"))
    before = sizes.select(F.col("_cell").alias("_c"), F.coalesce(F.sum("_n").over(W.orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    ranked = cell.withColumn("_rank", F.row_number().over(W.partitionBy("_cell").orderBy(key)))
    placed = ranked.join(before, F.col("_cell").eqNullSafe(F.col("_c")))
    return placed.withColumn(out, (F.col("_before") + F.col("_rank") + start).cast("long")).drop("_cell", "_c", "_before", "_rank")


def hash_surrogate(keys: list[str]) -> Column:
    """A surrogate key without a sort: stable over runs and partitions, never negative."""
    return F.xxhash64(*keys).bitwiseAND(F.lit((1 << 63) - 1))
