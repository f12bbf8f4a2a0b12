"""Loads under a control table: full, by watermark, from a change feed, and backfills."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard import schemas
from halyard.operators.merge import check_unique, net_changes, upsert


@dataclass(frozen=True)
class Source:
    source_name: str
    source_table: str
    destination_table: str
    ingestion_type: str
    watermark_column: str | None
    primary_key: tuple[str, ...]
    threshold: float


def config_frame(spark: SparkSession) -> DataFrame:
    """The control table as it is shipped."""
    from decimal import Decimal

    rows = [(i, s, t, d, k, w, p, "DAILY", True, Decimal(q)) for i, (s, t, d, k, w, p, q) in enumerate(schemas.CONFIG_ROWS, 1)]
    return spark.createDataFrame(rows, schemas.PIPELINE_CONFIG)


def active_sources(config: DataFrame) -> list[Source]:
    """Active rows, in order. A control table is small by nature: it is read by the driver."""
    rows = config.filter("active_flag").orderBy("config_id").collect()
    return [Source(r["source_name"], r["source_table"], r["destination_table"], r["ingestion_type"], r["watermark_column"], tuple(x.strip() for x in r["primary_key_columns"].split(",")), float(r["data_quality_threshold"] or 0)) for r in rows]


def after(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows past the watermark; all of them without one. A null mark column is never past it."""
    return df if mark is None else df.filter(F.col(column) > F.lit(mark))


def between(df: DataFrame, column: str, first, last) -> DataFrame:
    """A backfill's rows, both ends included."""
    return df.filter(F.col(column).between(F.lit(first), F.lit(last)))


def high_water(df: DataFrame, column: str):
    return df.agg(F.max(column)).first()[0]


def load(target: DataFrame | None, incoming: DataFrame, kind: str, keys: list[str], watermark: str | None = None, mark=None, window: tuple | None = None, op: str = "op", delete: str = "D") -> DataFrame:
    """The table after a load.

    Full replaces. Watermark upserts rows past ``mark``. CDC upserts the net change of each
    key and takes deleted keys out. A backfill (``window``) upserts its rows whatever the
    mark. All but Full are idempotent merges by key.
    """
    if kind == "Full":
        return incoming
    if window is not None:
        rows = between(incoming, watermark, *window)
    else:
        rows = after(incoming, watermark, mark) if watermark else incoming
    gone = None
    if op in rows.columns:
        rows = net_changes(rows, keys, watermark, op).withColumn("_gone", F.col(op) == delete).drop(op)
        gone = "_gone"
    else:
        rows = net_changes(rows.withColumn("_op", F.lit("U")), keys, watermark, "_op").drop("_op") if watermark else rows
        check_unique(rows, keys)
    if target is None:
        kept = rows.filter("NOT _gone") if gone else rows
        return kept.drop("_gone")
    return upsert(target, rows, keys, gone)
