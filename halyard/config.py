"""Where tables live, in which format, and what a run is called and when it is."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import SparkSession

LAYERS = ("bronze", "silver", "gold", "metadata")


def new_run_id() -> str:
    return f"run-{uuid.uuid4().hex[:10]}"


@dataclass(frozen=True)
class Lake:
    """A lakehouse root in any store that Spark reads. Nothing is created before a write."""

    root: str
    fmt: str = "parquet"

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{table}"


@dataclass(frozen=True)
class Run:
    """One run: its id and its clock. All stamps of a run come from here, so that a rerun can repeat them."""

    run_id: str = field(default_factory=new_run_id)
    as_of: datetime = field(default_factory=lambda: datetime.now(UTC))


def session(app_name: str = "halyard", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; partitions and memory are the cluster's to set."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only in local mode, where the session may name none (tests), is a local one made; on a
    cluster a missing setting is an error, as a machine's own folder would not be shared.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = os.environ.get("HALYARD_SHARED_DIR") or tempfile.mkdtemp(prefix="halyard-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")
