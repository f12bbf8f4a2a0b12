"""Gold: the star schema. Dimensions keep their surrogate keys over reruns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard import functions as H
from halyard import schemas
from halyard.config import Lake, Run
from halyard.operators.merge import hash_surrogate, latest, surrogate_keys, upsert
from halyard.operators.star import UNKNOWN_KEY, lookup, readmitted, with_unknown
from halyard.operators.versions import apply_versions, as_of
from halyard.plans.audit import AuditLog
from halyard.sources.files import Table


def _silver(spark: SparkSession, lake: Lake, name: str) -> DataFrame | None:
    t = Table(spark, lake.path("silver", name), lake.fmt)
    return t.read() if t.exists() else None


def type1(rows: DataFrame, key: str, sk: str, old: DataFrame | None) -> DataFrame:
    """A dimension that holds the newest attributes: known keys keep their number, new ones are numbered on."""
    rows = rows.filter(F.col(key).isNotNull())
    known = None if old is None else old.filter(F.col(sk) != UNKNOWN_KEY)
    fresh = surrogate_keys(rows, key, sk, known)
    columns = [sk, *rows.columns]
    if known is None:
        return with_unknown(fresh.select(*columns), sk, key)
    numbers = known.select(F.col(key).alias("_key"), F.col(sk))
    updated = rows.join(numbers, F.col(key) == F.col("_key")).select(*columns)
    merged = upsert(known.select(*columns), updated.unionByName(fresh.select(*columns)), [key])
    return with_unknown(merged, sk, key)


def dim_patient(rows: DataFrame, old: DataFrame | None) -> DataFrame:
    """The versioned patient dimension after a batch (patient_id, attributes, updated_at, is_deleted).

    A soft-deleted patient's current version ends at the deletion. Version numbers are kept."""
    unknown = {"effective_start_date": F.lit("1900-01-01").cast("timestamp"), "is_current": F.lit(True), "record_hash": F.lit("UNKNOWN")}
    batch = latest(rows.filter(F.col("patient_id").isNotNull()), ["patient_id"], [F.col("updated_at").desc_nulls_last(), H.record_hash(rows.columns).asc()])
    tracked, attributes = list(schemas.PATIENT_TRACKED), list(schemas.PATIENT_ATTRIBUTES)
    gone = batch.filter(F.coalesce("is_deleted", F.lit(False))).select(F.col("patient_id").alias("_gone"), F.col("updated_at").alias("_gone_at"))
    alive = batch.filter(~F.coalesce("is_deleted", F.lit(False))).select("patient_id", *attributes, "updated_at")
    columns = ["patient_id", *attributes, "effective_start_date", "effective_end_date", "is_current", "record_hash"]
    if old is None:
        hashed = alive.withColumns({"effective_start_date": F.col("updated_at"), "effective_end_date": F.lit(None).cast("timestamp"), "is_current": F.lit(True), "record_hash": H.record_hash(["patient_id", *tracked])})
        versions, known = hashed.select(*columns), None
    else:
        known = old.filter(F.col("patient_sk") != UNKNOWN_KEY)
        versions = apply_versions(known.select(*columns), alive, "patient_id", "updated_at", tracked)
    # A deletion that is older than the version says nothing about it.
    ends = F.col("is_current") & F.coalesce(F.col("_gone_at") >= F.col("effective_start_date"), F.lit(False))
    versions = versions.join(gone, F.col("patient_id") == F.col("_gone"), "left").withColumn("effective_end_date", F.when(ends, F.col("_gone_at")).otherwise(F.col("effective_end_date"))).withColumn("is_current", F.col("is_current") & ~ends).select(*columns)
    # A version is known by its patient and start.
    version = F.concat_ws("|", "patient_id", F.date_format("effective_start_date", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    keyed = versions.withColumn("_version", version)
    if known is None:
        numbered = surrogate_keys(keyed, "_version", "patient_sk")
    else:
        numbers = known.select(version.alias("_version"), "patient_sk")
        fresh = surrogate_keys(keyed, "_version", "patient_sk", numbers)
        numbered = keyed.join(numbers, "_version").unionByName(fresh)
    return with_unknown(numbered.select("patient_sk", *columns), "patient_sk", "patient_id", unknown)


def dimension_rows(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Rows of each dimension that Silver can fill: the newest one of each business key."""
    found: dict[str, DataFrame] = {}

    def take(name: str, df: DataFrame | None, order: list, **renamed):
        if df is None:
            return
        key, ddl = schemas.DIMENSIONS[name]
        attributes = [c.strip().split(" ") for c in ddl.split(",")]
        rows = latest(df.filter(F.col(key).isNotNull()), [key], order)
        found[name] = rows.select(key, *[(renamed.get(a) if a in renamed else F.col(a) if a in df.columns else F.lit(None)).cast(t).alias(a) for a, t in attributes])

    newest = [F.col("updated_at").desc_nulls_last()]
    take("dim_provider", _silver(spark, lake, "silver_providers"), [*newest, F.col("record_hash")])
    take("dim_facility", _silver(spark, lake, "silver_facilities"), [F.col("record_hash")])
    take("dim_diagnosis", _silver(spark, lake, "silver_diagnoses"), [*newest, F.col("record_hash")])
    take("dim_medication", _silver(spark, lake, "silver_medications"), [*newest, F.col("record_hash")])
    encounters = _silver(spark, lake, "silver_encounters")
    take("dim_department", encounters, [F.col("record_hash")], department_name=F.col("department_id"))
    return found


def stamped(rows: DataFrame, old: DataFrame | None, key: str, run: Run) -> DataFrame:
    """Adds created_at: the run that brought a key first; a rerun keeps it."""
    now = rows.withColumn("created_at", F.lit(run.as_of).cast("timestamp"))
    if old is None:
        return now
    since = old.select(F.col(key).alias("_key"), F.col("created_at").alias("_since"))
    return now.join(since, F.col(key) == F.col("_key"), "left").withColumn("created_at", F.coalesce("_since", "created_at")).drop("_key", "_since")


def build_dimensions(spark: SparkSession, lake: Lake, run: Run, audit: AuditLog) -> list[str]:
    written = []

    def write(name: str, make, sk: str | None = None) -> None:
        with audit.step(run.run_id, f"build_{name}", "silver", "GOLD") as entry:
            table = Table(spark, lake.path("gold", name), lake.fmt)
            old = table.read() if table.exists() else None
            rows = make(old)
            table.overwrite(stamped(rows, old, sk, run) if sk else rows)
            entry.rows_inserted = table.read().count()
            written.append(name)

    patients = _silver(spark, lake, "silver_patients")
    if patients is not None:
        write("dim_patient", lambda old: dim_patient(patients, old), "patient_sk")
    for name, rows in dimension_rows(spark, lake).items():
        key = schemas.DIMENSIONS[name][0]
        sk = f"{name.removeprefix('dim_')}_sk"
        write(name, lambda old, rows=rows, key=key, sk=sk: type1(rows, key, sk, old), sk)
    write("dim_date", lambda _: H.date_dimension(spark, "2000-01-01", "2035-12-31"))
    return written


def fact_rows(spark: SparkSession, lake: Lake) -> dict[str, tuple[str, DataFrame]]:
    """Fact table: (business key, rows), as far as Silver has the sources."""

    def gold(name: str) -> DataFrame | None:
        t = Table(spark, lake.path("gold", name), lake.fmt)
        return t.read() if t.exists() else None

    dims = {n: gold(n) for n in ("dim_patient", "dim_provider", "dim_facility", "dim_department", "dim_diagnosis", "dim_medication")}
    # Dimension sizes are counted, so that only one that is small is broadcast.
    sizes = {n: d.count() for n, d in dims.items() if d is not None}

    def sk(facts: DataFrame, dim: str, key: str) -> DataFrame:
        name = f"{dim.removeprefix('dim_')}_sk"
        return facts.withColumn(name, F.lit(UNKNOWN_KEY).cast("long")) if dims[dim] is None else lookup(facts, dims[dim], key, name, rows=sizes[dim])

    def patient(facts: DataFrame, at: str) -> DataFrame:
        if dims["dim_patient"] is None:
            return facts.withColumn("patient_sk", F.lit(UNKNOWN_KEY).cast("long"))
        found = as_of(facts.withColumn("_at", F.col(at).cast("timestamp")), dims["dim_patient"].filter(F.col("patient_sk") != UNKNOWN_KEY), "patient_id", "_at", ["patient_sk"])
        return found.withColumn("patient_sk", F.coalesce("patient_sk", F.lit(UNKNOWN_KEY)).cast("long")).drop("_at")

    out: dict[str, tuple[str, DataFrame]] = {}
    silver = {n: _silver(spark, lake, n) for n in ("silver_encounters", "silver_lab_results", "silver_fhir_observations", "silver_medications", "silver_diagnoses", "silver_claims")}
    encounters = silver["silver_encounters"]
    if encounters is not None:
        e = patient(encounters, "admission_timestamp")
        for dim, key in (("dim_provider", "provider_id"), ("dim_facility", "facility_id"), ("dim_department", "department_id")):
            e = sk(e, dim, key)
        flag = readmitted("patient_id", "admission_timestamp", "discharge_timestamp", "encounter_id")
        out["fact_encounter"] = ("encounter_id", e.withColumn("is_readmission_30d", flag).select(
            "encounter_id", "patient_sk", "provider_sk", "facility_sk", "department_sk",
            H.date_key("admission_timestamp").alias("admission_date_key"), H.date_key("discharge_timestamp").alias("discharge_date_key"),
            "encounter_type", H.los_hours("admission_timestamp", "discharge_timestamp").alias("length_of_stay_hours"), "discharge_disposition", "is_readmission_30d"))
    observed = []
    if (labs := silver["silver_lab_results"]) is not None:
        observed.append(labs.select(F.col("lab_result_id").alias("observation_id"), "patient_id", "encounter_id", F.col("result_timestamp").alias("_at"), "loinc_code", "test_name", F.col("result_value").cast("decimal(18,4)").alias("result_value"), "result_unit", "abnormal_flag", H.turnaround_minutes("order_timestamp", "result_timestamp").alias("turnaround_time_minutes")))
    if (fhir := silver["silver_fhir_observations"]) is not None:
        observed.append(fhir.select("observation_id", "patient_id", "encounter_id", F.col("observation_timestamp").alias("_at"), "loinc_code", "test_name", H.to_decimal("result_value", 18, 4).alias("result_value"), "result_unit", F.lit(None).cast("string").alias("abnormal_flag"), F.lit(None).cast("int").alias("turnaround_time_minutes")))
    if observed:
        o = observed[0] if len(observed) == 1 else observed[0].unionByName(observed[1])
        out["fact_observation"] = ("observation_id", patient(o.withColumnRenamed("_at", "observed_at"), "observed_at").select("observation_id", "patient_sk", "encounter_id", H.date_key("observed_at").alias("observation_date_key"), "loinc_code", "test_name", "result_value", "result_unit", "abnormal_flag", "turnaround_time_minutes"))
    if (orders := silver["silver_medications"]) is not None:
        if encounters is not None:  # an order's provider is its encounter's
            by = encounters.select(F.col("encounter_id").alias("_e"), "provider_id")
            orders = orders.join(by, F.col("encounter_id") == F.col("_e"), "left").drop("_e")
        else:
            orders = orders.withColumn("provider_id", F.lit(None).cast("string"))
        m = sk(sk(patient(orders, "order_timestamp"), "dim_provider", "provider_id"), "dim_medication", "rxnorm_code")
        out["fact_medication_order"] = ("medication_order_id", m.select("medication_order_id", "patient_sk", "provider_sk", "medication_sk", "encounter_id", H.date_key("order_timestamp").alias("order_date_key"), "dosage", "route", "order_status"))
    if (diagnoses := silver["silver_diagnoses"]) is not None:
        d = sk(patient(diagnoses, "diagnosis_timestamp"), "dim_diagnosis", "icd10_code")
        out["fact_diagnosis"] = ("diagnosis_id", d.select("diagnosis_id", "patient_sk", "diagnosis_sk", "encounter_id", H.date_key("diagnosis_timestamp").alias("diagnosis_date_key"), "diagnosis_type"))
    if (claims := silver["silver_claims"]) is not None:
        c = sk(patient(claims, "service_date"), "dim_facility", "facility_id")
        out["fact_claim"] = ("claim_id", c.select("claim_id", "patient_sk", "facility_sk", H.date_key("service_date").alias("service_date_key"), "claim_amount", "paid_amount", "claim_status", "insurance_type"))
    return out


#: The names of the facts' own numbers.
FACT_IDS = {"fact_encounter": "encounter_fact_id", "fact_observation": "observation_fact_id", "fact_medication_order": "medication_fact_id", "fact_diagnosis": "diagnosis_fact_id", "fact_claim": "claim_fact_id"}


def build_facts(spark: SparkSession, lake: Lake, run: Run, audit: AuditLog) -> list[str]:
    """Merge each fact by its business key: a rerun changes nothing."""
    written = []
    for name, (key, rows) in fact_rows(spark, lake).items():
        with audit.step(run.run_id, f"build_{name}", "silver", "GOLD") as entry:
            table = Table(spark, lake.path("gold", name), lake.fmt)
            old = table.read() if table.exists() else None
            # A fact's own number is a hash of its business key: no sort, the same in every run.
            rows = latest(rows, [key], [F.xxhash64(*rows.columns).asc()])
            rows = stamped(rows.select(hash_surrogate([key]).alias(FACT_IDS[name]), *rows.columns), old, key, run)
            table.overwrite(rows if old is None else upsert(old, rows, [key]))
            entry.rows_inserted = table.read().count()
            written.append(name)
    return written
