from pyspark.sql import functions as F

from halyard import schemas
from halyard.config import Lake, Run, session
from halyard.plans import pipeline, silver
from halyard.plans.bronze import Landing
from halyard.sources import synthetic as S
from halyard.sources.files import Table, _columns, read_bundle


def names(entity):
    return [c.strip().split(" ")[0] for c in _columns(schemas.SOURCES[entity])]


def test_shapes_and_seeds(spark):
    visits = S.encounters(spark, 40)
    made = {"patients": S.patients(spark, 40), "providers": S.providers(spark, 5), "encounters": visits, "diagnoses": S.diagnoses(visits), "lab_results": S.lab_results(visits), "medications": S.medications(visits), "insurance_claims": S.claims(spark, 60), "facility_info": S.facilities(spark)}
    for entity, df in made.items():
        assert df.columns == names(entity), entity
        key = df.columns[0]
        assert df.select(key).distinct().count() == df.count() > 0
        assert df.exceptAll(df.repartition(3)).isEmpty()
    again = S.patients(spark, 40, seed=43)
    assert not again.exceptAll(made["patients"]).isEmpty()
    n = visits.groupBy("patient_id").count().agg(F.min("count"), F.max("count")).first()
    assert (n[0], n[1]) == (1, 3) and visits.filter("discharge_timestamp <= admission_timestamp").isEmpty()


def test_bundles_flatten(spark, tmp_path):
    path = str(tmp_path / "bundles")
    S.fhir_bundle(spark, 6, 3).write.json(path)
    resources = read_bundle(spark, path, multiline=False)
    kinds = {r.resourceType: r["count"] for r in resources.groupBy("resourceType").count().collect()}
    assert kinds["Patient"] == 6 and kinds["Observation"] == 3 * kinds["Encounter"] == 3 * kinds["Condition"]
    seen = silver.flatten_observations(resources)
    assert seen.filter("patient_id IS NULL OR encounter_id IS NULL OR result_value IS NULL OR observation_timestamp IS NULL OR loinc_code IS NULL").isEmpty()
    assert seen.join(silver.flatten_patients(resources), "patient_id", "left_anti").isEmpty()
    assert set(r.encounter_type for r in silver.flatten_encounters(resources).collect()) <= {"Inpatient", "Outpatient", "Emergency"}
    assert silver.flatten_conditions(resources).filter("icd10_code IS NULL OR clinical_status != 'active'").isEmpty()
    assert silver.flatten_medication_requests(resources).count() == 0


def test_medallion_over_generated_sources(spark, tmp_path):
    visits = S.encounters(spark, 30)
    for name, df in {"patients": S.patients(spark, 30), "providers": S.providers(spark, 50), "encounters": visits, "diagnoses": S.diagnoses(visits), "lab_results": S.lab_results(visits), "medications": S.medications(visits)}.items():
        df.coalesce(1).write.option("header", True).csv(str(tmp_path / f"ehr/{name}.csv"))
    S.claims(spark, 200, patients_n=150).write.option("header", True).csv(str(tmp_path / "claims/insurance_claims.csv"))
    S.facilities(spark).write.option("header", True).csv(str(tmp_path / "claims/facility_info.csv"))
    lake = Lake(str(tmp_path / "lake"))
    pipeline.run_medallion(spark, lake, Landing(str(tmp_path / "none"), str(tmp_path / "ehr"), str(tmp_path / "claims")), Run("r"))
    claims = Table(spark, lake.path("gold", "fact_claim")).read()
    # Most claims name a patient that isn't there, or come before the first version.
    assert claims.count() == 200 and claims.filter("patient_sk = -1").count() > 100


def test_session_is_in_utc(spark):
    assert session().conf.get("spark.sql.session.timeZone") == "UTC"
