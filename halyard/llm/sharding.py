"""Operator 6, sharding: a permutation-filled lookup table (native).

Each shard orders the slots of a prime-sized table by its own permutation
``offset + j * skip mod size``; the shards take turns, each claiming its next free
slot, until none is free. A row's slot is a hash of its key, so placement is one
lookup, shards differ by one slot at most, and adding or removing a shard moves
little more than the rows that must move.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import boxed, quoted

SHARDS, SLOTS = 64, 16381  # slots: a prime, over a hundred for each shard
MAX_SLOTS = 1_000_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int) -> list[int]:
    """Owner (index into ``shards``) of each slot. Bounded work on the driver: the
    table's size is a parameter, at most ``MAX_SLOTS``, and not a function of the data."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if not _is_prime(slots) or slots > MAX_SLOTS or slots < len(shards):
        raise ValueError("slots must be a prime, no smaller than the number of shards")
    at, skip = [], []
    for name in shards:
        digest = hashlib.sha256(name.encode()).digest()
        at.append(int.from_bytes(digest[:8], "big") % slots)
        skip.append(int.from_bytes(digest[8:16], "big") % (slots - 1) + 1)
    owner, free = [-1] * slots, slots
    while free:
        for s in range(len(shards)):
            while owner[at[s]] >= 0:
                at[s] = (at[s] + skip[s]) % slots
            owner[at[s]] = s
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: str, slots: int):
    """Slot of a key column: 60 bits of its MD5 modulo the table's size; null is the
    empty text. MD5 so that any engine can place a row."""
    digest = F.md5(F.coalesce(F.col(quoted(key)).cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int")


def table_frame(spark: SparkSession, owner: list[int]) -> DataFrame:
    packed = ",".join(map(str, owner))
    return spark.range(1).select(F.posexplode(F.split(F.lit(packed), ",")).alias("_slot", "_owner")).select("_slot", F.col("_owner").cast("int").alias("_owner"))


def assign_shards(df: DataFrame, key: str, shards: list[str] | None = None, slots: int = SLOTS, slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """Adds ``slot`` and ``shard`` (index of the shard).

    The table is broadcast: at most ``MAX_SLOTS`` pairs of ints, whatever the input.
    Null key: placed as the empty text. Equal keys share a shard. Columns of ``df``
    named as the two new ones are replaced, all others kept, whatever their names; an empty
    table stays empty.
    """
    shards = shards or [f"shard-{i}" for i in range(SHARDS)]
    lookup = table_frame(df.sparkSession, lookup_table(shards, slots))
    kept = df.select(*[F.col(quoted(c)) for c in df.columns if c == key or c not in (slot_col, shard_col)])
    placed = boxed(kept, place=slot_of(key, slots)).join(F.broadcast(lookup), F.col("place") == F.col("_slot"))
    old = [F.col(f"row.{quoted(c)}").alias(c) for c in df.columns if c not in (slot_col, shard_col)]
    return placed.select(*old, F.col("place").alias(slot_col), F.col("_owner").alias(shard_col))


def sharding_sql(shards: int = SHARDS, slots: int = SLOTS) -> str:
    owner = lookup_table([f"shard-{i}" for i in range(shards)], slots)
    return f"""
    WITH t AS (SELECT {owner} AS owner),
    d AS (SELECT doc_id, CAST((('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT) % {slots} AS INTEGER) AS slot FROM documents)
    SELECT doc_id, slot, CAST(owner[slot + 1] AS INTEGER) AS shard FROM d, t
    """
