"""Silver: flat, typed, hashed and judged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard import functions as H
from halyard import schemas
from halyard.config import Lake, Run
from halyard.operators import quality
from halyard.plans.audit import SKIPPED, AuditLog
from halyard.sources.files import Table, _columns


def _coding(c: str, field: str):
    return H.first_of(F.col(c).getField("coding")).getField(field)


def flatten_patients(resources: DataFrame, mask: bool = False) -> DataFrame:
    name, address = H.first_of("name"), H.first_of("address")
    first = H.first_of(name.getField("given"))
    return resources.filter(F.col("resourceType") == "Patient").select(
        F.col("id").alias("patient_id"),
        (H.mask_name(first) if mask else first).alias("first_name"),
        (H.mask_name(name.getField("family")) if mask else name.getField("family")).alias("last_name"),
        H.to_date("birthDate").alias("date_of_birth"),
        "gender",
        H.first_of(address.getField("line")).alias("address_street"),
        address.getField("city").alias("city"),
        address.getField("state").alias("state"),
        address.getField("postalCode").alias("postal_code"),
        F.lit("Commercial").alias("insurance_type"),
        H.to_timestamp("meta.lastUpdated").alias("source_updated_at"),
    )


def flatten_observations(resources: DataFrame) -> DataFrame:
    return resources.filter(F.col("resourceType") == "Observation").select(
        F.col("id").alias("observation_id"),
        H.strip_reference("subject.reference", "Patient").alias("patient_id"),
        H.strip_reference("encounter.reference", "Encounter").alias("encounter_id"),
        _coding("code", "code").alias("loinc_code"),
        _coding("code", "display").alias("test_name"),
        H.to_double("valueQuantity.value").alias("result_value"),
        F.col("valueQuantity.unit").alias("result_unit"),
        H.to_timestamp("effectiveDateTime").alias("observation_timestamp"),
        F.col("status").alias("observation_status"),
    )


#: What an encounter's class code says.
ENCOUNTER_CLASSES = {"IMP": "Inpatient", "AMB": "Outpatient", "EMER": "Emergency"}


def flatten_encounters(resources: DataFrame) -> DataFrame:
    kind = F.col("class.code")
    names = F.create_map(*[F.lit(x) for pair in ENCOUNTER_CLASSES.items() for x in pair])
    return resources.filter(F.col("resourceType") == "Encounter").select(
        F.col("id").alias("encounter_id"),
        H.strip_reference("subject.reference", "Patient").alias("patient_id"),
        F.coalesce(F.try_element_at(names, kind), kind).alias("encounter_type"),
        H.to_timestamp("period.start").alias("admission_timestamp"),
        H.to_timestamp("period.end").alias("discharge_timestamp"),
        F.col("status").alias("encounter_status"),
    )


def flatten_conditions(resources: DataFrame) -> DataFrame:
    return resources.filter(F.col("resourceType") == "Condition").select(
        F.col("id").alias("diagnosis_id"),
        H.strip_reference("encounter.reference", "Encounter").alias("encounter_id"),
        H.strip_reference("subject.reference", "Patient").alias("patient_id"),
        _coding("code", "code").alias("icd10_code"),
        _coding("code", "display").alias("diagnosis_description"),
        _coding("clinicalStatus", "code").alias("clinical_status"),
        H.to_timestamp("onsetDateTime").alias("diagnosis_timestamp"),
    )


def flatten_medication_requests(resources: DataFrame) -> DataFrame:
    return resources.filter(F.col("resourceType") == "MedicationRequest").select(
        F.col("id").alias("medication_order_id"),
        H.strip_reference("encounter.reference", "Encounter").alias("encounter_id"),
        H.strip_reference("subject.reference", "Patient").alias("patient_id"),
        _coding("medicationCodeableConcept", "code").alias("rxnorm_code"),
        _coding("medicationCodeableConcept", "display").alias("medication_name"),
        F.col("status").alias("order_status"),
        H.to_timestamp("authoredOn").alias("order_timestamp"),
    )


def typed(raw: DataFrame, entity: str) -> DataFrame:
    """A text table cast to its declared types, bad cells null; other columns are left out."""
    casts = {"date": H.to_date, "timestamp": H.to_timestamp, "boolean": H.to_bool, "double": H.to_double}
    out = []
    for column in _columns(schemas.SOURCES[entity]):
        name, kind = column.strip().split(" ", 1)
        if kind.startswith("decimal"):
            out.append(F.col(name).cast("string").try_cast(kind).alias(name))
        else:
            out.append((casts[kind](name) if kind in casts else F.col(name)).alias(name))
    return raw.select(*out)


#: Silver table: (Bronze table, how it is made, quality dataset, id column, hashed columns).
TABLES = {
    "silver_fhir_patients": ("bronze_fhir_patient", flatten_patients, "silver_patients", "patient_id", ("patient_id", *schemas.PATIENT_TRACKED)),
    "silver_fhir_observations": ("bronze_fhir_observation", flatten_observations, "silver_observations", "observation_id", schemas.OBSERVATION_HASHED),
    "silver_fhir_conditions": ("bronze_fhir_condition", flatten_conditions, "silver_diagnoses", "diagnosis_id", ("diagnosis_id", "icd10_code")),
    "silver_fhir_medication_requests": ("bronze_fhir_medication_request", flatten_medication_requests, "", "medication_order_id", ("medication_order_id", "rxnorm_code")),
    "silver_patients": ("bronze_ehr_patients", "patients", "silver_patients", "patient_id", ("patient_id", *schemas.PATIENT_TRACKED)),
    "silver_providers": ("bronze_ehr_providers", "providers", "", "provider_id", ("provider_id", "npi")),
    "silver_encounters": ("bronze_ehr_encounters", "encounters", "silver_encounters", "encounter_id", ("encounter_id", "admission_timestamp", "discharge_timestamp")),
    "silver_diagnoses": ("bronze_ehr_diagnoses", "diagnoses", "silver_diagnoses", "diagnosis_id", ("diagnosis_id", "icd10_code")),
    "silver_lab_results": ("bronze_ehr_lab_results", "lab_results", "", "lab_result_id", ("lab_result_id", "result_value")),
    "silver_medications": ("bronze_ehr_medications", "medications", "", "medication_order_id", ("medication_order_id", "order_status")),
    "silver_claims": ("bronze_claims", "insurance_claims", "silver_claims", "claim_id", ("claim_id", "claim_amount", "claim_status")),
    "silver_facilities": ("bronze_facilities", "facility_info", "", "facility_id", ("facility_id", "facility_name")),
}


def build(spark: SparkSession, lake: Lake, name: str, run: Run, audit: AuditLog, mask: bool = False, rules: list[quality.Rule] | None = None) -> int | None:
    """Write one Silver table and its quarantine rows; the rows kept, None if Bronze has no such table."""
    source, make, dataset, key, hashed = TABLES[name]
    with audit.step(run.run_id, f"process_{name}", source, "SILVER") as entry:
        bronze = Table(spark, lake.path("bronze", source), lake.fmt)
        if not bronze.exists():
            entry.status = SKIPPED
            return None
        raw = bronze.read()
        flat = typed(raw, make) if isinstance(make, str) else (make(raw, mask) if make is flatten_patients else make(raw))
        flat = flat.withColumn("record_hash", H.record_hash(hashed))
        judged = quality.validate(flat, dataset, run.run_id, run.as_of, key, rules)
        # Judged once: the valid rows are written and the counts come with them.
        Table(spark, lake.path("silver", name), lake.fmt).overwrite(judged.valid)
        counts = judged.counts.get
        entry.rows_read, entry.rows_rejected = counts["rows_read"], counts["rows_rejected"]
        entry.rows_inserted = entry.rows_read - entry.rows_rejected
        if entry.rows_rejected:
            log = Table(spark, lake.path("metadata", "quarantine_records"), lake.fmt)
            rejected = judged.rejected.withColumn("source_name", F.lit(dataset or name))
            if log.exists():
                # A rerun doesn't log a row again: run, dataset, id and rule are its key.
                keys = ["pipeline_run_id", "source_name", "record_identifier", "failed_rule"]
                rejected = rejected.join(log.read().filter(F.col("pipeline_run_id") == run.run_id).select(*keys), keys, "left_anti").select(*rejected.columns)
            log.append(rejected)
        return entry.rows_inserted
