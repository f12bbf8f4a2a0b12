import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from halyard import functions as H


def one(df):
    return df.first()


def test_record_hash_and_its_known_collisions(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a||b", "c"), (4, "a", "b||c")], "id long, a string, b string")
    got = {r.id: r.h for r in df.select("id", H.record_hash(["a", "b"]).alias("h")).collect()}
    assert got[1] == got[2] == hashlib.sha256(b"||x").hexdigest()
    assert got[3] == got[4] == hashlib.sha256(b"a||b||c").hexdigest()


def test_masks(spark):
    df = spark.createDataFrame([("Ann",), ("",), (None,)], "n string")
    rows = df.select(H.mask_name("n").alias("m"), H.mask_ssn("n").alias("s")).collect()
    assert [r.m for r in rows] == ["A***", "***", None]
    assert rows[1].s == rows[2].s == hashlib.sha256(b"").hexdigest()


def test_casts_give_null_for_bad_values(spark):
    df = spark.createDataFrame([("2024-02-30", "x", "1e3", "12.345", "1"), ("2024-02-29", "2024-01-01T10:00:00Z", "nope", "z", "maybe")], "d string, t string, n string, m string, b string")
    a, b = df.select(H.to_date("d").cast("string"), H.to_timestamp("t").cast("string"), H.to_double("n"), H.to_decimal("m"), H.to_bool("b")).collect()
    assert tuple(a) == (None, None, 1000.0, Decimal("12.35"), True)
    assert tuple(b) == ("2024-02-29", "2024-01-01 10:00:00", None, None, None)


def test_first_of_and_references(spark):
    df = spark.createDataFrame([([], "Patient/p1"), (None, "Patient/Patient/x"), (["a", "b"], None)], "xs array<string>, r string")
    assert [tuple(r) for r in df.select(H.first_of("xs"), H.strip_reference("r", "Patient")).collect()] == [(None, "p1"), (None, "x"), ("a", None)]


def test_code_systems(spark):
    df = spark.createDataFrame([("2345-7", "loinc", "http://loinc.org"), ("x", "loinc", None), ("E11.9", "icd10", None), ("860975", "rxnorm", None), (None, "loinc", None)], "c string, s string, a string")
    for system, want in (("loinc", [True, False, False, False, False]), ("icd10", [False, False, True, False, False]), ("rxnorm", [False, False, False, True, False])):
        assert [r[0] for r in df.select(H.code_system_valid("c", system)).collect()] == want
    assert [r[0] for r in df.select(H.code_system_valid("c", "loinc", "a")).collect()] == [True, False, False, False, False]


def test_calendar(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 10:00:00' a, timestamp'2024-01-02 11:30:59' b, CAST(NULL AS timestamp) c")
    assert tuple(one(df.select(H.date_key("a"), H.los_hours("a", "b"), H.los_hours("a", "c"), H.turnaround_minutes("a", "b"), H.date_key("c")))) == (20240101, Decimal("25.52"), None, 1530, None)
    days = H.date_dimension(spark, "2023-12-30", "2024-01-02").orderBy("date_key").collect()
    assert [(r.day_of_week, r.is_weekend, r.week_of_year, r.day_name) for r in days] == [(7, True, 52, "Saturday"), (1, True, 52, "Sunday"), (2, False, 1, "Monday"), (3, False, 1, "Tuesday")]


def test_default_text(spark):
    df = spark.createDataFrame([(None,), ("x",)], "a string")
    assert [r[0] for r in df.select(H.default_text("a")).collect()] == ["UNKNOWN", "x"]
    assert df.select(H.default_text(F.col("a"), "")).first()[0] == ""
