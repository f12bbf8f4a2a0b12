"""Versioned dimensions (SCD type 2) and point-in-time lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from halyard.functions import record_hash


def build_versions(changes: DataFrame, key: str, at: str, tracked: list[str], order: list[str] | None = None, deleted: str | None = None) -> DataFrame:
    """Versions from a history of rows: a new one where a tracked column changes.

    Adds effective_start_date, effective_end_date (exclusive, null while current),
    is_current and record_hash. ``order`` breaks ties of ``at``. A row whose ``deleted``
    is true ends the version before it and starts none.
    """
    over = W.partitionBy(key).orderBy(F.col(at), *[F.col(c) for c in order or []])
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    hashed = changes.withColumn("record_hash", record_hash([key, *tracked])).withColumn("_state", F.when(gone, F.lit("deleted")).otherwise(F.col("record_hash")))
    before = F.lag("_state").over(over)
    changed = hashed.withColumn("_new", before.isNull() | (before != F.col("_state"))).filter("_new")
    ended = changed.withColumn("effective_end_date", F.lead(at).over(over))
    return (
        ended.filter("_state != 'deleted'")
        .withColumn("effective_start_date", F.col(at))
        .withColumn("is_current", F.col("effective_end_date").isNull())
        .drop("_new", "_state")
    )


def apply_versions(dim: DataFrame, batch: DataFrame, key: str, at: str, tracked: list[str]) -> DataFrame:
    """An SCD2 merge: ``batch`` (one row a key) against ``dim`` (key, tracked, validity, record_hash, ...).

    Unchanged keys keep their version; a changed one ends its current version at the new
    row's time and gets a new one; new keys start theirs. A key whose last version has
    ended (a deletion) starts another with a row from that end on. A batch that was applied
    before, or is no newer than a key's last version, changes nothing.
    """
    new = batch.select(F.col(key).alias("_key"), F.col(at).alias("_at"), record_hash([key, *tracked]).alias("_hash"))
    current = dim.filter("is_current")
    past = dim.filter("NOT is_current")
    met = current.join(new, current[key] == new["_key"], "left")
    outdated = F.coalesce((F.col("_hash") != F.col("record_hash")) & (F.col("_at") > F.col("effective_start_date")), F.lit(False))
    closed = met.withColumn("effective_end_date", F.when(outdated, F.col("_at")).otherwise(F.col("effective_end_date"))).withColumn("is_current", ~outdated).select(*dim.columns)
    newest = F.max(F.struct("effective_start_date", "effective_end_date", "is_current", "record_hash")).alias("_last")
    known = dim.groupBy(F.col(key).alias("_key")).agg(newest).select("_key", F.col("_last.record_hash").alias("_old"), F.col("_last.effective_start_date").alias("_since"), F.when(F.col("_last.is_current"), None).otherwise(F.col("_last.effective_end_date")).alias("_ended"))
    fresh = batch.withColumn("record_hash", record_hash([key, *tracked])).join(known, F.col(key) == F.col("_key"), "left")
    fresh = fresh.filter(F.col("_key").isNull() | F.when(F.col("_ended").isNotNull(), F.col(at) >= F.col("_ended")).otherwise((F.col("_old") != F.col("record_hash")) & (F.col(at) > F.col("_since"))))
    fresh = fresh.withColumn("effective_start_date", F.col(at)).withColumn("effective_end_date", F.lit(None).cast(dim.schema["effective_end_date"].dataType)).withColumn("is_current", F.lit(True))
    return past.unionByName(closed).unionByName(fresh.drop("_key", "_old", "_since", "_ended"), allowMissingColumns=True).select(*dim.columns)


def as_of(facts: DataFrame, dim: DataFrame, key: str, at: str, columns: list[str], dim_key: str | None = None) -> DataFrame:
    """Facts with the columns of the version that was valid at ``at`` (start included, end
    not); nulls where none was. The key is an equality, the validity a condition on it,
    so that the join is hashed or sorted by key and never a nested loop."""
    side = dim.select(F.col(dim_key or key).alias("_k"), F.col("effective_start_date").alias("_from"), F.col("effective_end_date").alias("_to"), *columns)
    valid = (facts[key] == side["_k"]) & (facts[at] >= side["_from"]) & (side["_to"].isNull() | (facts[at] < side["_to"]))
    return facts.join(side, valid, "left").drop("_k", "_from", "_to")


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")
