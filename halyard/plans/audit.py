"""The run log: one row a step, failures included."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from halyard import schemas
from halyard.sources.files import Table

RUNNING, SUCCESS, FAILED, SKIPPED = "RUNNING", "SUCCESS", "FAILED", "SKIPPED"


@dataclass
class Entry:
    run_id: str
    pipeline: str
    source: str
    layer: str
    start: datetime = field(default_factory=lambda: datetime.now(UTC))
    end: datetime | None = None
    rows_read: int = 0
    rows_inserted: int = 0
    rows_updated: int = 0
    rows_deleted: int = 0
    rows_rejected: int = 0
    watermark_start: str | None = None
    watermark_end: str | None = None
    status: str = RUNNING
    error_code: str | None = None
    error_message: str | None = None

    def row(self) -> tuple:
        text = lambda x: None if x is None else str(x)
        return (self.run_id, self.pipeline, self.source, self.layer, self.start, self.end, int(self.rows_read), int(self.rows_inserted), int(self.rows_updated), int(self.rows_deleted), int(self.rows_rejected), text(self.watermark_start), text(self.watermark_end), self.status, self.error_code, self.error_message)


class AuditLog:
    def __init__(self, spark: SparkSession, table: Table):
        self.spark, self.table = spark, table

    def write(self, *entries: Entry) -> None:
        self.table.append(self.spark.createDataFrame([e.row() for e in entries], schemas.AUDIT).coalesce(1))

    @contextmanager
    def step(self, run_id: str, pipeline: str, source: str, layer: str):
        """Logs the step when it ends: SUCCESS, SKIPPED if it says so, FAILED with the error if it raises."""
        entry = Entry(run_id, pipeline, source, layer)
        try:
            yield entry
            if entry.status == RUNNING:
                entry.status = SUCCESS
        except Exception as e:
            entry.status, entry.error_code, entry.error_message = FAILED, type(e).__name__, str(e)[:1000]
            raise
        finally:
            entry.end = datetime.now(UTC)
            self.write(entry)
