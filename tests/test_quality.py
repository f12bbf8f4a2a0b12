import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from halyard.operators import quality as Q

NOW = datetime(2024, 6, 1, tzinfo=UTC)


def claims(spark, rows):
    return spark.createDataFrame(rows, "claim_id string, claim_amount double")


@pytest.mark.parametrize("with_bad_row", [True, False])
def test_unknown_verdict_is_a_rejection(spark, with_bad_row):
    rows = [("a", 1.0), ("b", None)] + ([("c", -1.0)] if with_bad_row else [])
    got = Q.validate(claims(spark, rows), "silver_claims", "r", NOW, "claim_id")
    assert [r.claim_id for r in got.valid.collect()] == ["a"]
    assert sorted(r.record_identifier for r in got.rejected.collect()) == (["b", "c"] if with_bad_row else ["b"])


def test_first_failing_rule_payload_and_counts(spark):
    got = Q.validate(claims(spark, [(None, -5.0), ("x", -5.0), ("y", 0.0)]), "silver_claims", "run-1", NOW, "claim_id")
    assert [r.claim_id for r in got.valid.collect()] == ["y"]
    rows = {r.record_identifier: r for r in got.rejected.collect()}
    assert rows["UNKNOWN"].failed_rule == "NOT_NULL:claim_id" and rows["x"].failed_rule == "RANGE:claim_amount"
    assert json.loads(rows["x"].raw_payload) == {"claim_id": "x", "claim_amount": -5.0}
    assert json.loads(rows["UNKNOWN"].raw_payload) == {"claim_amount": -5.0}
    assert rows["x"].error_message == "Failed expression: claim_amount >= 0 (Severity: ERROR)"
    assert rows["x"].resolution_status == "PENDING" and got.counts.get == {"rows_read": 3, "rows_rejected": 2}


def test_unknown_dataset_and_empty_table_pass(spark):
    df = claims(spark, [("a", -1.0)])
    got = Q.validate(df, "nothing", "r", NOW, "claim_id")
    assert got.valid.count() == 1 and got.rejected.count() == 0
    got = Q.validate(df.limit(0), "silver_claims", "r", NOW, "claim_id")
    assert got.valid.count() == 0 and got.rejected.count() == 0


@pytest.mark.parametrize(("value", "ok"), [(-500.0, True), (-500.01, False), (50000.0, True), (50000.01, False), (None, True)])
def test_range_boundaries(spark, value, ok):
    df = spark.createDataFrame([("o", "p", value, datetime(2024, 1, 1))], "observation_id string, patient_id string, result_value double, observation_timestamp timestamp")
    assert Q.validate(df, "silver_observations", "r", NOW, "observation_id").valid.count() == int(ok)


def test_cross_column_and_future(spark):
    at = datetime(2024, 1, 1, 12)
    rows = [("before", datetime(2024, 1, 1), at), ("equal", at, at), ("open", None, at), ("no start", at, None), ("both", None, None)]
    df = spark.createDataFrame([(k, "p", d, a) for k, d, a in rows], "encounter_id string, patient_id string, discharge_timestamp timestamp, admission_timestamp timestamp")
    kept = {r.encounter_id for r in Q.validate(df, "silver_encounters", "r", NOW, "encounter_id").valid.collect()}
    assert kept == {"equal", "open", "both"}
    with pytest.raises(ValueError, match="clock"):
        Q.judge(df, [Q.Rule("x", "y", "RANGE", "admission_timestamp <= :as_of")])


def test_warnings_keep_rows(spark):
    rules = [Q.Rule("c", "claim_amount", "RANGE", "claim_amount >= 0", "WARNING")]
    df = claims(spark, [("a", -1.0)])
    assert Q.validate(df, "c", "r", NOW, "claim_id", rules).valid.count() == 1
    assert df.select(Q.warnings(rules).alias("w")).first().w == ["RANGE:claim_amount"]
    off = [Q.Rule("c", "claim_amount", "RANGE", "claim_amount >= 0", active=False)]
    assert Q.validate(df, "c", "r", NOW, "claim_id", off).valid.count() == 1


def test_flags_reports_and_freshness(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 9), (None, 1)], "k int, p int")
    assert sorted(r._unique for r in Q.flag_unique(df, ["k"]).collect()) == [False, False, True, True]
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    assert sorted((r.p, r._exists) for r in Q.flag_referential(df, "p", parent, "id").collect()) == [(1, True), (1, True), (2, True), (9, False)]
    assert [r.p for r in Q.orphans(df, "p", parent, "id").collect()] == [9]
    report = {r.rule: r for r in Q.rule_report(df, [Q.Rule("d", "k", "NOT_NULL", "k IS NOT NULL", threshold=30.0), Q.Rule("d", "p", "RANGE", "p < 5", threshold=1.0)]).collect()}
    assert report["NOT_NULL:k"].within and not report["RANGE:p"].within and report["RANGE:p"].failed_pct == 25.0
    times = spark.createDataFrame([(datetime(2024, 5, 31, 20),)], "ts timestamp")
    assert Q.freshness(times, "ts", NOW, 6).first().fresh and not Q.freshness(times, "ts", NOW, 3).first().fresh
    assert not Q.freshness(times.limit(0), "ts", NOW, 3).first().fresh


def test_replay(spark):
    got = Q.validate(claims(spark, [("a", -1.0), ("b", -900.0), ("c", 3.0)]), "silver_claims", "r", NOW, "claim_id")
    log = got.rejected.unionByName(got.rejected.limit(1).withColumn("raw_payload", F.lit("{broken")).withColumn("record_identifier", F.lit("bad")))
    looser = [Q.Rule("silver_claims", "claim_amount", "RANGE", "claim_amount >= -10")]
    rows, marked = Q.replay(log, "claim_id string, claim_amount double", looser, NOW)
    assert [(r.claim_id, r.claim_amount) for r in rows.collect()] == [("a", -1.0)]
    assert {r.record_identifier: r.resolution_status for r in marked.collect()} == {"a": "REPLAYED", "b": "PENDING", "bad": "PENDING"}


def test_rules_from_a_table(spark):
    df = spark.createDataFrame([(2, "d", "b", "RANGE", "b > 0", "ERROR", 1.0, True), (1, "d", "a", "NOT_NULL", "a IS NOT NULL", "CRITICAL", None, True), (3, "d", "c", "RANGE", "c > 0", "ERROR", 1.0, False)], "rule_id int, dataset_name string, column_name string, rule_type string, rule_expression string, severity string, failure_threshold double, active_flag boolean")
    assert [r.name for r in Q.rules_from(df, "d")] == ["NOT_NULL:a", "RANGE:b"]
    assert Q.rules_from(df, "other") == []


def test_the_clock_does_not_depend_on_the_session_zone(spark):
    from datetime import UTC, datetime, timedelta, timezone

    from halyard.operators import quality as Q

    clock = datetime(2024, 1, 5, 12, tzinfo=UTC)
    rule = Q.Rule("d", "at", "RANGE", "at <= :as_of", "ERROR", 0.0)
    rows = spark.createDataFrame([(1, clock - timedelta(hours=2)), (2, clock + timedelta(hours=2))], "id int, at timestamp")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/Los_Angeles", "UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for as_of in (clock, clock.replace(tzinfo=None), clock.astimezone(timezone(timedelta(hours=5)))):
                assert [r.id for r in Q.judge(rows, [rule], as_of).filter("_rule IS NULL").collect()] == [1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
