"""The DAG: Bronze by source, then the two Silver branches side by side, dimensions, facts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from halyard.config import Lake, Run
from halyard.operators import quality
from halyard.plans import bronze, gold, silver
from halyard.plans.audit import AuditLog
from halyard.sources.files import Table
from halyard.sources.loads import active_sources, config_frame


@dataclass
class Result:
    run: Run
    bronze: dict[str, int | None] = field(default_factory=dict)
    silver: dict[str, int | None] = field(default_factory=dict)
    gold: list[str] = field(default_factory=list)


def retried(f, times: int = 3):
    """The result of f; its last error after ``times`` tries."""
    for i in range(times):
        try:
            return f()
        except Exception:
            if i == times - 1:
                raise


def run_medallion(spark: SparkSession, lake: Lake, landing: bronze.Landing, run: Run | None = None, mask: bool = False, config=None, backfill: tuple | None = None) -> Result:
    """One run over all active sources. A step that fails is logged and stops what depends on it."""
    run = run or Run()
    audit = AuditLog(spark, Table(spark, lake.path("metadata", "pipeline_run_audit"), lake.fmt))
    out = Result(run)
    sources = retried(lambda: active_sources(config if config is not None else config_frame(spark)))
    for source in sources:
        window = backfill if source.ingestion_type != "Full" else None
        out.bronze[source.destination_table] = bronze.ingest(spark, lake, landing, source, run, audit, window)
    branches = ([n for n in silver.TABLES if "fhir" in n], [n for n in silver.TABLES if "fhir" not in n])

    def branch(names: list[str]) -> dict[str, int | None]:
        # The audit and quarantine tables are appended to: appends from both branches don't meet.
        return {n: silver.build(spark, lake, n, run, audit, mask) for n in names}

    # The first branch that rejects a row creates the quarantine log; create it beforehand.
    log = Table(spark, lake.path("metadata", "quarantine_records"), lake.fmt)
    if not log.exists():
        from halyard import schemas

        log.overwrite(spark.createDataFrame([], schemas.QUARANTINE))
    with ThreadPoolExecutor(2) as pool:
        for done in pool.map(branch, branches):
            out.silver |= done
    out.gold = gold.build_dimensions(spark, lake, run, audit) + gold.build_facts(spark, lake, run, audit)
    return out


def replay_quarantine(spark: SparkSession, lake: Lake, dataset: str, schema: str, key: str, target: str, run: Run, rules: list[quality.Rule] | None = None, at: str | None = None) -> int:
    """Pending rows of a dataset that pass the rules now go into its Silver table, by key, and are marked REPLAYED.

    A row never replaces one that is as new or newer by ``at`` (the source's update time where
    both have it); without such a time it only adds keys that the table lacks."""
    from pyspark.sql import functions as F

    from halyard.operators.merge import latest, upsert

    log = Table(spark, lake.path("metadata", "quarantine_records"), lake.fmt)
    if not log.exists():
        return 0
    rules = rules if rules is not None else quality.catalog(dataset)

    def replayed(rows):
        return quality.replay(rows.filter(F.col("source_name") == dataset), schema, rules, run.as_of)

    rows, _ = replayed(log.read())
    table = Table(spark, lake.path("silver", target), lake.fmt)
    old = table.read()
    names = [c for c in old.columns if c in rows.columns]
    at = at or next((c for c in ("source_updated_at", "updated_at") if c in names), None)
    order = ([F.col(at).desc_nulls_last()] if at else []) + [F.xxhash64(*rows.columns).asc()]
    rows = latest(rows, [key], order).select(*[F.col(c).cast(old.schema[c].dataType).alias(c) if c in names else F.lit(None).cast(old.schema[c].dataType).alias(c) for c in old.columns])
    held = old.select(F.col(key).alias("_held"), (F.col(at) if at else F.lit(None).cast("timestamp")).alias("_held_at"), F.lit(True).alias("_there"))
    newer = F.col(at) > F.col("_held_at") if at else F.lit(False)
    rows = rows.join(held, rows[key].eqNullSafe(held["_held"]), "left").filter(F.col("_there").isNull() | newer).select(*old.columns)
    n = rows.count()
    table.overwrite(upsert(old, rows, [key]))
    # The statuses are swapped in last: a replay that broke off before can be repeated.
    log.rewrite(lambda all_rows: all_rows.filter(~F.col("source_name").eqNullSafe(dataset)).unionByName(replayed(all_rows)[1]))
    return n
