"""A small landing zone with a fixed seed and the faults that the tests look for."""

import csv
import json
import random
from datetime import datetime, timedelta

from halyard import schemas
from halyard.sources.files import _columns


def names(entity):
    return [c.strip().split(" ")[0] for c in _columns(schemas.SOURCES[entity])]


def write_csv(path, entity, rows, extra=()):
    with open(path, "w", newline="") as f:
        w = csv.DictWriter(f, [*names(entity), *extra])
        w.writeheader()
        w.writerows(rows)


def ts(d):
    return d.strftime("%Y-%m-%d %H:%M:%S")


def patients(n=20, at=datetime(2024, 1, 1)):
    out = []
    for i in range(n):
        out.append({"patient_id": f"P{i:03d}", "first_name": f"F{i}", "last_name": f"L{i}", "date_of_birth": f"19{50 + i}-03-04", "gender": "female", "address_street": f"{i} Mill Lane", "city": "Austin", "state": "TX", "postal_code": "73301", "insurance_type": "Medicare", "created_at": ts(at), "updated_at": ts(at), "is_deleted": 0})
    out[1]["date_of_birth"] = ""  # missing
    out[2]["date_of_birth"] = "1999-02-31"  # unparsable
    return out


def write_landing(root):
    rnd = random.Random(11)
    for d in ("fhir", "ehr", "claims"):
        (root / d).mkdir(parents=True, exist_ok=True)
    start = datetime(2024, 1, 10)
    write_csv(root / "ehr/patients.csv", "patients", patients())
    write_csv(root / "ehr/providers.csv", "providers", [{"provider_id": f"D{i}", "npi": f"99{i}", "first_name": "A", "last_name": f"B{i}", "specialty": "Cardiology", "department_id": f"DEP{i % 2}", "facility_id": "F1", "created_at": ts(start), "updated_at": ts(start)} for i in range(3)])
    enc, diag, labs, meds = [], [], [], []
    for i in range(30):
        a = start + timedelta(days=rnd.randint(0, 60), hours=rnd.randint(0, 20))
        b = a + timedelta(hours=rnd.randint(2, 72))
        e = {"encounter_id": f"E{i:03d}", "patient_id": f"P{i % 20:03d}", "provider_id": f"D{i % 3}", "facility_id": "F1", "encounter_type": ("Inpatient", "Outpatient", "Emergency")[i % 3], "admission_timestamp": ts(a), "discharge_timestamp": ts(b), "discharge_disposition": "Home", "department_id": f"DEP{i % 2}", "created_at": ts(a), "updated_at": ts(a)}
        enc.append(e)
        diag.append({"diagnosis_id": f"G{i:03d}", "encounter_id": e["encounter_id"], "patient_id": e["patient_id"], "icd10_code": "E11.9" if i else "", "diagnosis_description": "Diabetes", "diagnosis_type": "Primary", "diagnosis_timestamp": ts(a), "created_at": ts(a), "updated_at": ts(a)})
        labs.append({"lab_result_id": f"L{i:03d}", "encounter_id": e["encounter_id"], "patient_id": e["patient_id"], "loinc_code": "2345-7", "test_name": "Glucose", "result_value": "5.25" if i else "high", "result_unit": "mmol/L", "abnormal_flag": "N", "result_status": "final", "order_timestamp": ts(a), "result_timestamp": ts(a + timedelta(minutes=95)), "created_at": ts(a), "updated_at": ts(a)})
        meds.append({"medication_order_id": f"M{i:03d}", "encounter_id": e["encounter_id"], "patient_id": e["patient_id"], "rxnorm_code": "314076", "medication_name": "Lisinopril", "dosage": "10 mg", "route": "oral", "frequency": "daily", "order_status": "active", "order_timestamp": ts(a), "created_at": ts(a), "updated_at": ts(a)})
    enc[0]["discharge_timestamp"] = ts(start - timedelta(days=9))  # before admission
    enc[1]["discharge_timestamp"] = ""  # open
    enc[2]["patient_id"] = ""
    enc[3]["admission_timestamp"] = "2023-12-01 00:00:00"  # before the patient's first version
    write_csv(root / "ehr/encounters.csv", "encounters", enc)
    write_csv(root / "ehr/diagnoses.csv", "diagnoses", diag)
    write_csv(root / "ehr/lab_results.csv", "lab_results", labs)
    write_csv(root / "ehr/medications.csv", "medications", meds)
    amounts = ["100.50", "0", "-3", "", "7.005"]
    write_csv(root / "claims/insurance_claims.csv", "insurance_claims", [{"claim_id": f"C{i}", "patient_id": "P005" if i != 1 else "NOBODY", "facility_id": "F1", "service_date": "2024-02-01", "claim_amount": a, "paid_amount": "1", "claim_status": "paid", "insurance_type": "Medicare"} for i, a in enumerate(amounts)])
    write_csv(root / "claims/facility_info.csv", "facility_info", [{"facility_id": "F1", "facility_name": "Main", "facility_type": "Hospital", "address": "1 St", "city": "Austin", "state": "TX", "postal_code": "1"}])
    entries = []
    for i in range(4):
        p = {"resourceType": "Patient", "id": f"fp{i}", "meta": {"lastUpdated": f"2024-01-0{i + 1}T00:00:00Z"}, "name": [{"use": "official", "family": "Fam", "given": ["Giv", "Second"]}], "gender": "male", "birthDate": "1980-01-01", "address": [{"line": ["1 Elm"], "city": "Boston", "state": "MA", "postalCode": "02101"}]}
        if i == 1:
            p["name"] = []
            del p["address"]
        if i == 2:
            p["birthDate"] = "not a date"
        entries.append(p)
        entries.append({"resourceType": "Encounter", "id": f"fe{i}", "meta": {"lastUpdated": "2024-01-05T00:00:00Z"}, "status": "finished", "class": {"system": "s", "code": ("IMP", "AMB", "EMER", "HH")[i]}, "subject": {"reference": f"Patient/fp{i}"}, "period": {"start": "2024-01-05T00:00:00Z", "end": "2024-01-06T00:00:00Z"}})
        for j, v in enumerate((5, 50000.5)):
            entries.append({"resourceType": "Observation", "id": f"fo{i}-{j}", "meta": {"lastUpdated": "2024-01-05T00:00:00Z"}, "status": "final", "code": {"coding": [{"system": "http://loinc.org", "code": "2345-7", "display": "Glucose"}], "text": "Glucose"}, "subject": {"reference": f"Patient/fp{i}"}, "encounter": {"reference": f"Encounter/fe{i}"}, "effectiveDateTime": "2024-01-05T00:30:00Z", "valueQuantity": {"value": v, "unit": "mmol/L", "system": "u"}})
        entries.append({"resourceType": "Condition", "id": f"fc{i}", "meta": {"lastUpdated": "2024-01-05T00:00:00Z"}, "clinicalStatus": {"coding": [{"system": "s", "code": "active"}]}, "code": {"coding": [{"system": "http://hl7.org/fhir/sid/icd-10-cm", "code": "E11.9", "display": "Diabetes"}]}, "subject": {"reference": f"Patient/fp{i}"}, "encounter": {"reference": f"Encounter/fe{i}"}, "onsetDateTime": "2024-01-05T00:00:00Z"})
    (root / "fhir/bundle.json").write_text(json.dumps({"resourceType": "Bundle", "type": "transaction", "entry": [{"resource": r} for r in entries]}, indent=1))
