"""Declarative quality rules, judged in one pass.

Each row is charged to its first failing rule. A rule whose expression is null for a row
has failed it: no row is lost between valid and quarantined. Rules are data; their
expressions are Spark SQL. Rules across rows or tables (unique, referential) are
flags that a join or window adds first, so that the verdict stays one projection.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from halyard import schemas


@dataclass(frozen=True)
class Rule:
    dataset: str
    column: str
    kind: str  # NOT_NULL, RANGE, REGEX, UNIQUE, REFERENTIAL, FRESHNESS
    expr: str
    severity: str = "ERROR"  # CRITICAL, ERROR: quarantine; WARNING: report, keep
    threshold: float = 0.0  # share of failing rows that is tolerated, per cent
    active: bool = True

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"

    @property
    def message(self) -> str:
        return f"Failed expression: {self.expr} (Severity: {self.severity})"


#: The rules of each dataset (column, kind, expression, severity, threshold).
#: ``:as_of`` stands for the run's clock.
CATALOG: dict[str, tuple[tuple[str, str, str, str, float], ...]] = {
    "silver_patients": (
        ("patient_id", "NOT_NULL", "patient_id IS NOT NULL", "CRITICAL", 0.0),
        ("date_of_birth", "NOT_NULL", "date_of_birth IS NOT NULL", "ERROR", 0.0),
    ),
    "silver_encounters": (
        ("encounter_id", "NOT_NULL", "encounter_id IS NOT NULL", "CRITICAL", 0.0),
        ("patient_id", "NOT_NULL", "patient_id IS NOT NULL", "CRITICAL", 0.0),
        ("discharge_timestamp", "RANGE", "discharge_timestamp IS NULL OR discharge_timestamp >= admission_timestamp", "ERROR", 1.0),
    ),
    "silver_observations": (
        ("observation_id", "NOT_NULL", "observation_id IS NOT NULL", "CRITICAL", 0.0),
        ("patient_id", "NOT_NULL", "patient_id IS NOT NULL", "CRITICAL", 0.0),
        ("result_value", "RANGE", "result_value IS NULL OR (result_value >= -500 AND result_value <= 50000)", "ERROR", 2.0),
        ("observation_timestamp", "RANGE", "observation_timestamp <= :as_of", "ERROR", 0.5),
    ),
    "silver_claims": (
        ("claim_id", "NOT_NULL", "claim_id IS NOT NULL", "CRITICAL", 0.0),
        ("claim_amount", "RANGE", "claim_amount >= 0", "ERROR", 1.0),
    ),
    "silver_diagnoses": (("icd10_code", "NOT_NULL", "icd10_code IS NOT NULL", "ERROR", 0.0),),
}


def catalog(dataset: str) -> list[Rule]:
    """The catalog's rules of a dataset; none for an unknown one."""
    return [Rule(dataset, *r) for r in CATALOG.get(dataset, ())]


def rules_from(table: DataFrame, dataset: str) -> list[Rule]:
    """Active rules of a dataset from a rule table, in order of rule_id."""
    rows = table.filter((F.col("dataset_name") == dataset) & F.col("active_flag")).orderBy("rule_id").collect()
    return [Rule(dataset, r["column_name"], r["rule_type"], r["rule_expression"], r["severity"], float(r["failure_threshold"] or 0)) for r in rows]


def _holds(rule: Rule, as_of: datetime | None) -> Column:
    expr = rule.expr
    if ":as_of" in expr:
        if as_of is None:
            raise ValueError(f"rule {rule.name} needs a clock")
        # With its offset: the session's time zone has no say. A clock without one is in UTC.
        clock = as_of.astimezone(UTC) if as_of.tzinfo else as_of
        expr = expr.replace(":as_of", f"timestamp'{clock:%Y-%m-%d %H:%M:%S.%f}+00:00'")
    return F.coalesce(F.expr(expr), F.lit(False))


def verdict(rules: list[Rule], as_of: datetime | None = None) -> Column:
    """Index of the first failing rule that quarantines, else null."""
    out = None
    for i, r in enumerate(rules):
        if r.active and r.severity != "WARNING":
            failed = ~_holds(r, as_of)
            out = F.when(failed, F.lit(i)) if out is None else out.when(failed, F.lit(i))
    return F.lit(None).cast("int") if out is None else out.cast("int")


def warnings(rules: list[Rule], as_of: datetime | None = None) -> Column:
    """Names of the failing rules that only warn."""
    failing = [F.when(~_holds(r, as_of), F.lit(r.name)) for r in rules if r.active and r.severity == "WARNING"]
    return F.array_compact(F.array(*failing)) if failing else F.array().cast("array<string>")


def judge(df: DataFrame, rules: list[Rule], as_of: datetime | None = None) -> DataFrame:
    """``df`` with ``_rule``: the index of the rule that a row is charged to."""
    return df.withColumn("_rule", verdict(rules, as_of))


def _named(rules: list[Rule], f) -> Column:
    names = F.array(*[F.lit(f(r)) for r in rules])
    return F.get(names, F.col("_rule"))


def quarantine_rows(judged: DataFrame, rules: list[Rule], dataset: str, run_id: str, as_of: datetime, id_col: str, ignore_nulls: bool = True) -> DataFrame:
    """The quarantine log's rows. The payload is the input row as JSON, without the columns added here."""
    columns = [c for c in judged.columns if c != "_rule"]
    payload = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": str(ignore_nulls).lower()})
    return judged.filter("_rule IS NOT NULL").select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(dataset).alias("source_name"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("UNKNOWN")).alias("record_identifier"),
        _named(rules, lambda r: r.name).alias("failed_rule"),
        _named(rules, lambda r: r.message).alias("error_message"),
        payload.alias("raw_payload"),
        F.lit(as_of).cast("timestamp").alias("detected_timestamp"),
        F.lit("PENDING").alias("resolution_status"),
    )


@dataclass
class Judged:
    valid: DataFrame
    rejected: DataFrame
    counts: Observation | None  # read and rejected, filled in by the first write of ``judged``
    judged: DataFrame


def validate(df: DataFrame, dataset: str, run_id: str, as_of: datetime, id_col: str = "id", rules: list[Rule] | None = None) -> Judged:
    """Valid rows and quarantine rows. Nothing runs here: both read one judged plan, which
    carries an observation of the row counts, so that counting is no job of its own."""
    rules = catalog(dataset) if rules is None else rules
    counts = Observation(f"quality-{dataset}-{run_id}")
    judged = judge(df, rules, as_of).observe(counts, F.count("*").alias("rows_read"), F.count("_rule").alias("rows_rejected"))
    rejected = quarantine_rows(judged, rules, dataset, run_id, as_of, id_col) if rules else df.sparkSession.createDataFrame([], schemas.QUARANTINE)
    return Judged(judged.filter("_rule IS NULL").drop("_rule"), rejected, counts, judged)


def flag_unique(df: DataFrame, keys: list[str], out: str = "_unique") -> DataFrame:
    """Adds whether a row's key is the only one of its kind."""
    return df.withColumn(out, F.count("*").over(W.partitionBy(*keys)) == 1)


def flag_referential(df: DataFrame, key: str, parent: DataFrame, parent_key: str, out: str = "_exists") -> DataFrame:
    """Adds whether a row's key exists in the parent; a null key doesn't."""
    found = parent.select(F.col(parent_key).alias("_parent")).filter("_parent IS NOT NULL").distinct()
    joined = df.join(found, df[key] == found["_parent"], "left")
    return joined.withColumn(out, F.col("_parent").isNotNull()).drop("_parent")


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    found = parent.select(F.col(parent_key).alias("_parent"))
    return df.join(found, df[key] == found["_parent"], "left_anti")


def freshness(df: DataFrame, column: str, as_of: datetime, most_hours: float) -> DataFrame:
    """(newest, age_hours, fresh) of a dataset; without a row it isn't fresh."""
    newest = F.max(F.col(column).cast("timestamp"))
    age = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("newest")) / 3600
    return df.agg(newest.alias("newest")).select("newest", age.alias("age_hours")).withColumn("fresh", F.coalesce(F.col("age_hours") <= most_hours, F.lit(False)))


def rule_report(df: DataFrame, rules: list[Rule], as_of: datetime | None = None) -> DataFrame:
    """(rule, failed, total, failed_pct, within): each rule against its own threshold, all in one aggregation."""
    sums = [F.sum((~_holds(r, as_of)).cast("long")).alias(f"f{i}") for i, r in enumerate(rules)]
    one = df.agg(F.count("*").alias("total"), *sums)
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.coalesce(F.col(f"f{i}"), F.lit(0)).alias("failed"), F.lit(float(r.threshold)).alias("threshold")) for i, r in enumerate(rules)])
    flat = one.select("total", F.explode(rows).alias("r")).select("r.rule", "r.failed", "total", "r.threshold")
    pct = F.when(F.col("total") > 0, F.col("failed") * 100.0 / F.col("total")).otherwise(F.lit(0.0))
    return flat.withColumn("failed_pct", pct).withColumn("within", F.col("failed_pct") <= F.col("threshold")).drop("threshold")


def replay(quarantine: DataFrame, schema: str, rules: list[Rule], as_of: datetime, run_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Revalidate pending rows under new rules: (rows that pass now, log with their new status).

    A payload that can't be read, or still fails, stays PENDING."""
    pending = F.col("resolution_status") == "PENDING"
    if run_id is not None:
        pending = pending & (F.col("pipeline_run_id") == run_id)
    parsed = quarantine.withColumn("_row", F.from_json("raw_payload", schema, {"mode": "PERMISSIVE"}))
    fields = [f.name for f in parsed.schema["_row"].dataType.fields]
    flat = parsed.select("*", *[F.col(f"_row.`{f}`").alias(f"_f_{f}") for f in fields])
    judged = flat.select(*quarantine.columns, "_row", F.struct(*[F.col(f"_f_{f}").alias(f) for f in fields]).alias("_values"))
    inner = judged.select("*", *[F.col(f"_values.`{f}`").alias(f) for f in fields if f not in quarantine.columns])
    passes = pending & F.col("_row").isNotNull() & verdict(rules, as_of).isNull()
    marked = inner.withColumn("_passes", passes)
    rows = marked.filter("_passes").select("_values.*")
    log = marked.withColumn("resolution_status", F.when(F.col("_passes"), "REPLAYED").otherwise(F.col("resolution_status"))).select(*quarantine.columns)
    return rows, log
