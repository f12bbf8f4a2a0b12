"""Bronze: sources as they are, under the control table, with lineage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from halyard.config import Lake, Run
from halyard.plans.audit import SKIPPED, AuditLog
from halyard.sources.files import Table, evolve, read_bundle, read_csv, with_lineage
from halyard.sources.loads import Source, high_water, load


@dataclass(frozen=True)
class Landing:
    """Where the sources' files lie."""

    fhir: str
    ehr: str
    claims: str

    def read(self, spark: SparkSession, source: Source) -> DataFrame | None:
        if source.source_name == "fhir_r4":
            resources = read_bundle(spark, self.fhir)
            if resources is None:
                return None
            mine = resources.filter(F.col("resourceType") == source.source_table)
            return mine.withColumn("meta_lastUpdated", F.col("meta.lastUpdated"))
        if source.source_name == "sql_ehr":
            return read_csv(spark, f"{self.ehr}/{source.source_table}.csv", source.source_table)
        return read_csv(spark, f"{self.claims}/{source.source_table}", source.source_table.removesuffix(".csv"))


def ingest(spark: SparkSession, lake: Lake, landing: Landing, source: Source, run: Run, audit: AuditLog, backfill: tuple | None = None) -> int | None:
    """Load one configured source; the number of rows read, None if it isn't there."""
    with audit.step(run.run_id, f"ingest_{source.destination_table}", source.source_name, "BRONZE") as entry:
        raw = landing.read(spark, source)
        if raw is None:
            entry.status = SKIPPED
            return None
        table = Table(spark, lake.path("bronze", source.destination_table), lake.fmt)
        old = table.read() if table.exists() else None
        column = source.watermark_column if source.ingestion_type != "Full" else None
        mark = high_water(old, column) if old is not None and column and backfill is None else None
        counts = Observation()
        rows = with_lineage(raw, run.run_id, run.as_of).observe(counts, F.count("*").alias("n"), *([F.max(column).alias("mark")] if column else []))
        if old is not None and source.ingestion_type != "Full":
            # Columns that only one side has are null on the other (schema drift).
            rows, old = evolve(old.limit(0), rows), evolve(old, rows.limit(0)).select(*evolve(old.limit(0), rows.limit(0)).columns)
        table.overwrite(load(old, rows, source.ingestion_type, list(source.primary_key), column, mark, backfill))
        got = counts.get
        entry.rows_read = entry.rows_inserted = got["n"]
        entry.watermark_start, entry.watermark_end = mark, got.get("mark")
        return got["n"]
