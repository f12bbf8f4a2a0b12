from datetime import UTC, datetime, timedelta
from decimal import Decimal

import pytest
from landing import patients, write_csv, write_landing
from pyspark.sql import functions as F

from halyard.config import Lake, Run
from halyard.operators import quality
from halyard.operators.star import reconcile
from halyard.plans import pipeline, reports
from halyard.plans.bronze import Landing
from halyard.sources.files import Table

NOW = datetime(2024, 6, 1, tzinfo=UTC)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    write_landing(root / "in")
    lake = Lake(str(root / "out"))
    lake_in = Landing(str(root / "in/fhir/bundle.json"), str(root / "in/ehr"), str(root / "in/claims"))
    first = pipeline.run_medallion(spark, lake, lake_in, Run("run-1", NOW))
    return root, lake, lake_in, first


def read(spark, lake, layer, name):
    return Table(spark, lake.path(layer, name)).read()


def test_end_to_end(spark, lake):
    root, lake, landing, first = lake
    assert first.bronze["bronze_ehr_patients"] == 20 and first.bronze["bronze_fhir_medication_request"] == 0
    assert first.silver["silver_patients"] == 18 and first.silver["silver_claims"] == 3
    assert first.silver["silver_fhir_patients"] == 3 and first.silver["silver_fhir_observations"] == 4
    assert first.silver["silver_encounters"] == 28 and first.silver["silver_diagnoses"] == 29
    # Read = valid + quarantined, for every dataset.
    audit = read(spark, lake, "metadata", "pipeline_run_audit")
    silver = audit.filter("layer = 'SILVER' AND execution_status = 'SUCCESS'")
    assert silver.filter("rows_read != rows_inserted + rows_rejected").isEmpty()
    log = read(spark, lake, "metadata", "quarantine_records")
    assert log.count() == silver.agg(F.sum("rows_rejected")).first()[0]
    failed = {(r.source_name, r.record_identifier): r.failed_rule for r in log.collect()}
    assert failed["silver_claims", "C3"] == "RANGE:claim_amount"  # a null amount isn't lost
    assert failed["silver_encounters", "E002"] == "NOT_NULL:patient_id"
    assert failed["silver_fhir_patients" if ("silver_fhir_patients", "fp2") in failed else "silver_patients", "fp2"] == "NOT_NULL:date_of_birth"
    patient = {r.patient_id: r for r in read(spark, lake, "silver", "silver_fhir_patients").collect()}
    assert patient["fp0"].first_name == "Giv" and patient["fp1"].first_name is None and patient["fp1"].city is None


def test_gold(spark, lake):
    root, lake, landing, _ = lake
    dim = read(spark, lake, "gold", "dim_patient")
    unknown = dim.filter("patient_sk = -1").first()
    assert unknown.patient_id == "UNKNOWN" and unknown.record_hash == "UNKNOWN" and unknown.effective_start_date == datetime(1900, 1, 1)
    encounters = {r.encounter_id: r for r in read(spark, lake, "gold", "fact_encounter").collect()}
    assert encounters["E003"].patient_sk == -1  # before the first version
    assert encounters["E004"].patient_sk > 0 and encounters["E004"].provider_sk > 0 and encounters["E004"].department_sk > 0
    assert encounters["E001"].length_of_stay_hours is None and encounters["E001"].discharge_date_key is None
    claims = {r.claim_id: r for r in read(spark, lake, "gold", "fact_claim").collect()}
    assert claims["C1"].patient_sk == -1 and claims["C0"].patient_sk > 0 and claims["C4"].claim_amount == Decimal("7.01")
    observed = {r.observation_id: r for r in read(spark, lake, "gold", "fact_observation").collect()}
    assert observed["L001"].turnaround_time_minutes == 95 and observed["fo0-0"].abnormal_flag is None and observed["L000"].result_value is None
    assert {r.created_at for r in observed.values()} == {NOW.replace(tzinfo=None)} and min(r.observation_fact_id for r in observed.values()) > 0
    orders = read(spark, lake, "gold", "fact_medication_order")
    assert orders.filter("provider_sk > 0 AND medication_sk > 0").count() >= 28
    assert tuple(reconcile(read(spark, lake, "silver", "silver_claims"), read(spark, lake, "gold", "fact_claim"), "claim_id").first()) == (3, 3, 0, 0)
    assert read(spark, lake, "gold", "dim_date").count() == 13149


def test_rerun_is_idempotent_and_changes_make_versions(spark, lake):
    root, lake, landing, _ = lake
    names = ["dim_patient", "dim_provider", "fact_encounter", "fact_claim", "fact_observation"]
    before = {n: read(spark, lake, "gold", n).collect() for n in names}
    pipeline.run_medallion(spark, lake, landing, Run("run-2", NOW + timedelta(days=1)))
    for n in names:
        assert sorted(map(str, read(spark, lake, "gold", n).collect())) == sorted(map(str, before[n])), n
    changed = patients()
    changed[5]["address_street"], changed[5]["updated_at"] = "new street", "2024-03-01 00:00:00"
    changed[6]["city"], changed[6]["updated_at"] = "Dallas", "2024-03-01 00:00:00"  # not tracked
    changed[7]["is_deleted"], changed[7]["updated_at"] = 1, "2024-03-01 00:00:00"
    write_csv(root / "in/ehr/patients.csv", "patients", [{**p, "extra": 1} for p in changed], ["extra"])
    pipeline.run_medallion(spark, lake, landing, Run("run-3", NOW))
    dim = read(spark, lake, "gold", "dim_patient")
    rows = sorted((r.effective_start_date, r.effective_end_date, r.is_current, r.address_street) for r in dim.filter("patient_id = 'P005'").collect())
    at = datetime(2024, 3, 1)
    assert rows == [(datetime(2024, 1, 1), at, False, "5 Mill Lane"), (at, None, True, "new street")]
    assert dim.filter("patient_id = 'P006'").count() == 1
    gone = dim.filter("patient_id = 'P007'").collect()
    assert len(gone) == 1 and not gone[0].is_current and gone[0].effective_end_date == at
    old = {r.patient_id: r.patient_sk for r in before["dim_patient"]}
    now = {r.patient_id: r.patient_sk for r in dim.filter("effective_start_date < '2024-02-01'").collect()}
    assert old == now and dim.groupBy("patient_sk").count().filter("count > 1").isEmpty()
    assert "extra" in read(spark, lake, "bronze", "bronze_ehr_patients").columns


def test_replay_and_reports(spark, lake):
    root, lake, landing, _ = lake
    looser = [quality.Rule("silver_claims", "claim_amount", "RANGE", "claim_amount >= -10")]
    schema = "claim_id string, patient_id string, facility_id string, service_date date, claim_amount decimal(18,2), paid_amount decimal(18,2), claim_status string, insurance_type string, record_hash string"
    for want in (1, 0):
        assert pipeline.replay_quarantine(spark, lake, "silver_claims", schema, "claim_id", "silver_claims", Run("replay", NOW), looser) == want
    assert read(spark, lake, "silver", "silver_claims").count() == 4
    log = read(spark, lake, "metadata", "quarantine_records")
    assert {r.resolution_status for r in log.filter("record_identifier = 'C2'").collect()} == {"REPLAYED"}
    audit = read(spark, lake, "metadata", "pipeline_run_audit")
    assert {r.pipeline_name for r in reports.run_status(audit).filter("failed > 0").collect()} == set()
    assert reports.rejection_rate(audit).count() > 3 and reports.quarantine_alerts(log, 100).isEmpty()
    assert reports.sla_breaches(audit, 30).isEmpty() and reports.run_duration(audit).count() > 10
    assert reports.quarantine_distribution(log).filter("resolution_status = 'PENDING'").count() >= 3
    facts = read(spark, lake, "gold", "fact_encounter")
    assert reports.encounters_by(facts, "department_sk").agg(F.sum("encounters")).first()[0] == 28
    assert reports.average_stay(facts, "encounter_type").count() == 3 and reports.readmission_rate(facts, "encounter_type").count() == 3
    assert reports.threshold_gate(audit.withColumn("ok", F.col("rows_rejected") == 0), "layer", "ok", 50).count() == 3


def test_missing_sources_are_skipped(spark, tmp_path):
    lake = Lake(str(tmp_path / "out"))
    got = pipeline.run_medallion(spark, lake, Landing(str(tmp_path / "no.json"), str(tmp_path / "a"), str(tmp_path / "b")), Run("r", NOW))
    assert set(got.bronze.values()) == {None} and set(got.silver.values()) == {None} and got.gold == ["dim_date"]
    statuses = {r.execution_status for r in read(spark, lake, "metadata", "pipeline_run_audit").filter("layer != 'GOLD'").collect()}
    assert statuses == {"SKIPPED"}
