"""Schemas of sources, metadata and the star schema, as DDL strings."""

from __future__ import annotations

#: Relational and flat-file sources. Every column is read as text and typed in Silver,
#: so that one bad cell quarantines a row and not a file.
SOURCES: dict[str, str] = {
    "patients": "patient_id string, first_name string, last_name string, date_of_birth date, gender string, ssn_hash string, address_street string, city string, state string, postal_code string, phone_number string, insurance_type string, created_at timestamp, updated_at timestamp, is_deleted boolean",
    "providers": "provider_id string, npi string, first_name string, last_name string, specialty string, department_id string, facility_id string, created_at timestamp, updated_at timestamp",
    "encounters": "encounter_id string, patient_id string, provider_id string, facility_id string, encounter_type string, admission_timestamp timestamp, discharge_timestamp timestamp, discharge_disposition string, department_id string, created_at timestamp, updated_at timestamp",
    "diagnoses": "diagnosis_id string, encounter_id string, patient_id string, icd10_code string, diagnosis_description string, diagnosis_type string, diagnosis_timestamp timestamp, created_at timestamp, updated_at timestamp",
    "lab_results": "lab_result_id string, encounter_id string, patient_id string, loinc_code string, test_name string, result_value decimal(18,4), result_unit string, reference_range string, abnormal_flag string, result_status string, order_timestamp timestamp, result_timestamp timestamp, created_at timestamp, updated_at timestamp",
    "medications": "medication_order_id string, encounter_id string, patient_id string, rxnorm_code string, medication_name string, dosage string, route string, frequency string, order_status string, order_timestamp timestamp, created_at timestamp, updated_at timestamp",
    "insurance_claims": "claim_id string, patient_id string, facility_id string, service_date date, claim_amount decimal(18,2), paid_amount decimal(18,2), claim_status string, insurance_type string",
    "facility_info": "facility_id string, facility_name string, facility_type string, address string, city string, state string, postal_code string",
}

_CODING = "array<struct<system:string,code:string,display:string>>"
#: One resource of any type: the union of the fields that the flatteners read.
FHIR_RESOURCE = (
    "struct<resourceType:string,id:string,meta:struct<lastUpdated:string>,identifier:array<struct<system:string,value:string>>,"
    "name:array<struct<use:string,family:string,given:array<string>>>,gender:string,birthDate:string,"
    "address:array<struct<line:array<string>,city:string,state:string,postalCode:string>>,status:string,"
    "`class`:struct<system:string,code:string>,subject:struct<reference:string>,encounter:struct<reference:string>,"
    f"period:struct<start:string,`end`:string>,code:struct<coding:{_CODING},text:string>,effectiveDateTime:string,"
    f"valueQuantity:struct<value:string,unit:string,system:string>,clinicalStatus:struct<coding:{_CODING}>,onsetDateTime:string,"
    f"intent:string,medicationCodeableConcept:struct<coding:{_CODING},text:string>,authoredOn:string>"
)
FHIR_BUNDLE = f"resourceType string, type string, entry array<struct<resource:{FHIR_RESOURCE}>>"

PIPELINE_CONFIG = "config_id int, source_name string, source_table string, destination_table string, ingestion_type string, watermark_column string, primary_key_columns string, load_frequency string, active_flag boolean, data_quality_threshold decimal(5,2)"
QUALITY_RULE = "rule_id int, dataset_name string, column_name string, rule_type string, rule_expression string, severity string, failure_threshold decimal(5,2), active_flag boolean"
QUARANTINE = "pipeline_run_id string, source_name string, record_identifier string, failed_rule string, error_message string, raw_payload string, detected_timestamp timestamp, resolution_status string"
AUDIT = "pipeline_run_id string, pipeline_name string, source_name string, layer string, start_timestamp timestamp, end_timestamp timestamp, rows_read long, rows_inserted long, rows_updated long, rows_deleted long, rows_rejected long, watermark_start string, watermark_end string, execution_status string, error_code string, error_message string"

#: The control table's active sources
#: (source, table, destination, load type, watermark column, key, quality threshold).
CONFIG_ROWS = (
    ("sql_ehr", "patients", "bronze_ehr_patients", "CDC", "updated_at", "patient_id", "98.00"),
    ("sql_ehr", "encounters", "bronze_ehr_encounters", "CDC", "updated_at", "encounter_id", "98.00"),
    ("sql_ehr", "providers", "bronze_ehr_providers", "Watermark", "updated_at", "provider_id", "99.00"),
    ("sql_ehr", "diagnoses", "bronze_ehr_diagnoses", "CDC", "updated_at", "diagnosis_id", "95.00"),
    ("sql_ehr", "lab_results", "bronze_ehr_lab_results", "CDC", "updated_at", "lab_result_id", "95.00"),
    ("sql_ehr", "medications", "bronze_ehr_medications", "CDC", "updated_at", "medication_order_id", "95.00"),
    ("fhir_r4", "Observation", "bronze_fhir_observation", "Watermark", "meta_lastUpdated", "id", "95.00"),
    ("fhir_r4", "Patient", "bronze_fhir_patient", "Watermark", "meta_lastUpdated", "id", "98.00"),
    ("fhir_r4", "Condition", "bronze_fhir_condition", "Watermark", "meta_lastUpdated", "id", "95.00"),
    ("fhir_r4", "MedicationRequest", "bronze_fhir_medication_request", "Watermark", "meta_lastUpdated", "id", "95.00"),
    ("claims_csv", "insurance_claims.csv", "bronze_claims", "Full", None, "claim_id", "95.00"),
    ("claims_csv", "facility_info.csv", "bronze_facilities", "Full", None, "facility_id", "99.00"),
)

#: Dimensions: business key and attributes. ``dim_patient`` is versioned, ``dim_date`` is generated.
DIMENSIONS: dict[str, tuple[str, str]] = {
    "dim_provider": ("provider_id", "npi string, first_name string, last_name string, specialty string, department_id string, facility_id string"),
    "dim_facility": ("facility_id", "facility_name string, facility_type string, address string, city string, state string, postal_code string"),
    "dim_diagnosis": ("icd10_code", "diagnosis_description string, category string"),
    "dim_medication": ("rxnorm_code", "medication_name string, drug_class string"),
    "dim_department": ("department_id", "department_name string"),
}
PATIENT_ATTRIBUTES = ("first_name", "last_name", "date_of_birth", "gender", "address_street", "city", "state", "postal_code", "phone_number", "insurance_type")
#: A patient's version changes with these.
PATIENT_TRACKED = ("first_name", "last_name", "date_of_birth", "address_street", "insurance_type")
OBSERVATION_HASHED = ("observation_id", "patient_id", "loinc_code", "result_value", "observation_timestamp")
