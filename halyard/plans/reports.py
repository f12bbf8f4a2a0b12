"""Reports on facts, quality logs and runs. Each is one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def encounters_by(facts: DataFrame, dimension: str) -> DataFrame:
    return facts.groupBy(dimension).agg(F.count("*").alias("encounters"))


def average_stay(facts: DataFrame, by: str, hours: str = "length_of_stay_hours") -> DataFrame:
    """Mean of closed stays, as sum over count so that it doesn't depend on order."""
    return facts.groupBy(by).agg((F.sum(hours).cast("double") / F.count(hours)).alias("avg_los_hours"))


def volume_by_type(facts: DataFrame, kind: str, kinds: dict[str, str]) -> DataFrame:
    """One row: for each name in ``kinds`` how many facts are of that type."""
    return facts.agg(*[F.count_if(F.col(kind) == value).alias(name) for name, value in kinds.items()])


def readmission_rate(facts: DataFrame, by: str, flag: str = "is_readmission_30d") -> DataFrame:
    return facts.groupBy(by).agg((F.count_if(F.col(flag)).cast("double") / F.count("*")).alias("readmission_rate"))


def rejection_rate(audit: DataFrame) -> DataFrame:
    """By source: rejected over read, per cent; null where nothing was read."""
    return audit.groupBy("source_name").agg(F.sum("rows_read").alias("rows_read"), F.sum("rows_rejected").alias("rows_rejected")).withColumn("rejection_pct", F.when(F.col("rows_read") > 0, F.col("rows_rejected") * 100.0 / F.col("rows_read")))


def quarantine_distribution(log: DataFrame) -> DataFrame:
    return log.groupBy("source_name", "resolution_status").agg(F.count("*").alias("records"))


def rule_failures(log: DataFrame) -> DataFrame:
    return log.groupBy("failed_rule").agg(F.count("*").alias("failures"))


def run_status(audit: DataFrame) -> DataFrame:
    by = F.col("execution_status")
    return audit.groupBy("pipeline_name").agg(F.count_if(by == "SUCCESS").alias("succeeded"), F.count_if(by == "FAILED").alias("failed"), F.count("*").alias("runs"))


def _seconds(start: str, end: str):
    return F.unix_timestamp(F.col(end).cast("timestamp")) - F.unix_timestamp(F.col(start).cast("timestamp"))


def run_duration(audit: DataFrame, by: str = "pipeline_name", start: str = "start_timestamp", end: str = "end_timestamp") -> DataFrame:
    s = _seconds(start, end)
    return audit.groupBy(by).agg((F.sum(s).cast("double") / F.count(s)).alias("avg_seconds"), F.max(s).alias("max_seconds"))


def cdc_latency(rows: DataFrame, by: str, changed: str, ingested: str) -> DataFrame:
    """From a change in the source to its ingestion."""
    s = _seconds(changed, ingested)
    return rows.groupBy(by).agg((F.sum(s).cast("double") / F.count(s)).alias("avg_latency_seconds"), F.max(s).alias("max_latency_seconds"))


def sla_breaches(audit: DataFrame, minutes: int = 30, start: str = "start_timestamp", end: str = "end_timestamp") -> DataFrame:
    return audit.filter(_seconds(start, end) > minutes * 60)


def quarantine_alerts(log: DataFrame, most: int = 100, run: str = "pipeline_run_id") -> DataFrame:
    return log.groupBy(run).agg(F.count("*").alias("records")).filter(F.col("records") > most)


def threshold_gate(judged: DataFrame, by: str, ok: str, least: float) -> DataFrame:
    """By dataset: the share of good rows, per cent, and whether it reaches ``least``."""
    share = F.count_if(F.col(ok)) * 100.0 / F.count("*")
    return judged.groupBy(by).agg(share.alias("pass_pct")).withColumn("passed", F.col("pass_pct") >= least)
