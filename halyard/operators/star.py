"""Star-schema lookups, unknown members, flags and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

UNKNOWN_KEY = -1
#: A dimension of at most this many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 200_000


def with_unknown(dim: DataFrame, sk: str, key: str, values: dict[str, Column] | None = None) -> DataFrame:
    """``dim`` and its unknown member: surrogate -1, key UNKNOWN (or -1), other columns null or given."""
    given = {sk: F.lit(UNKNOWN_KEY), key: F.lit("UNKNOWN"), **(values or {})}
    if dim.schema[key].dataType.simpleString() != "string":
        given[key] = F.lit(UNKNOWN_KEY)
    member = dim.sparkSession.range(1).select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in dim.schema.fields])
    return member.unionByName(dim)


def lookup(facts: DataFrame, dim: DataFrame, key: str, sk: str, dim_key: str | None = None, rows: int | None = None, out: str | None = None) -> DataFrame:
    """Facts with the dimension's surrogate key, -1 where its key isn't found or null.

    Broadcast only where ``rows``, the dimension's counted size, is within BROADCAST_ROWS;
    else Spark chooses by its own statistics.
    """
    side = dim.filter(F.col(sk) != UNKNOWN_KEY).select(F.col(dim_key or key).alias("_dk"), F.col(sk).alias("_sk"))
    if rows is not None and rows <= BROADCAST_ROWS:
        side = F.broadcast(side)
    joined = facts.join(side, facts[key] == side["_dk"], "left")
    return joined.withColumn(out or sk, F.coalesce(F.col("_sk"), F.lit(UNKNOWN_KEY)).cast("long")).drop("_dk", "_sk")


def readmitted(patient: str, admission: str, discharge: str, key: str, days: int = 30) -> Column:
    """Whether an admission comes at most ``days`` days after the same patient's latest
    earlier discharge. Stays may overlap, so it is the running maximum of discharges."""
    earlier = W.partitionBy(patient).orderBy(admission, key).rowsBetween(W.unboundedPreceding, -1)
    last = F.max(F.col(discharge)).over(earlier)
    within = F.unix_timestamp(F.col(admission).cast("timestamp")) - F.unix_timestamp(last.cast("timestamp"))
    return F.coalesce((within >= 0) & (within <= days * 86400), F.lit(False))


def reconcile(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """(source_rows, target_rows, missing, extra): missing keys are in the source alone, extra ones in the target."""
    a = source.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("s"))
    b = target.groupBy(F.col(key).alias("k2")).agg(F.count("*").alias("t"))
    met = a.join(b, F.col("k") == F.col("k2"), "full")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return met.agg(
        zero("s").alias("source_rows"),
        zero("t").alias("target_rows"),
        zero((F.col("s").isNotNull() & F.col("t").isNull()).cast("long")).alias("missing"),
        zero((F.col("t").isNotNull() & F.col("s").isNull()).cast("long")).alias("extra"),
    )
