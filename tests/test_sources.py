import json
import uuid
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from halyard.config import Lake, Run
from halyard.plans.audit import AuditLog
from halyard.sources import files, loads


def test_csv_is_text_in_declared_order_and_drift_is_kept(spark, tmp_path):
    (tmp_path / "f.csv").write_text("facility_name,facility_id,surprise\nMain,F1,7\n")
    df = files.read_csv(spark, str(tmp_path / "f.csv"), "facility_info")
    assert df.columns == ["facility_id", "facility_name", "facility_type", "address", "city", "state", "postal_code", "surprise"]
    assert set(t for _, t in df.dtypes) == {"string"} and df.first().facility_type is None and df.first().surprise == "7"
    assert files.read_csv(spark, str(tmp_path / "missing.csv"), "facility_info") is None


def test_bundle_unnest(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps({"entry": [{"resource": {"resourceType": "Patient", "id": "1"}}, {"resource": {"resourceType": "Observation", "id": "2", "valueQuantity": {"value": 5}}}]}, indent=2))
    got = files.read_bundle(spark, str(tmp_path / "b.json"))
    assert {r.id: r.resourceType for r in got.collect()} == {"1": "Patient", "2": "Observation"}
    (tmp_path / "e.json").write_text("{}")
    assert files.read_bundle(spark, str(tmp_path / "e.json")).count() == 0
    assert files.unnest(spark.range(3)).count() == 0
    assert files.read_bundle(spark, str(tmp_path / "none.json")) is None


def test_table_versions(spark, tmp_path):
    t = files.Table(spark, str(tmp_path / "t"))
    assert not t.exists()
    with pytest.raises(FileNotFoundError):
        t.read()
    t.append(spark.range(3))
    t.overwrite(t.read().withColumn("x", F.col("id") * 2))  # reads what it replaces
    assert sorted(r.x for r in t.read().collect()) == [0, 2, 4]
    before = t.version()
    with pytest.raises(Exception, match="boom|Divide|DIVIDE|user"):
        t.overwrite(t.read().withColumn("x", F.raise_error(F.lit("boom"))))
    assert t.version() == before and t.read().count() == 3
    t.append(spark.range(3, 5).withColumn("x", F.lit(9).cast("long")).withColumn("y", F.lit("new")))
    assert t.read().count() == 5 and "y" in t.read().columns
    t.vacuum(1)
    assert t.read().count() == 5


def test_evolve(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "z")], "x int, y string")
    assert sorted(map(tuple, files.evolve(a, b).collect()), key=str) == [(1, None), (2, "z")]
    with pytest.raises(AnalysisException, match="x"):
        files.evolve(a, spark.createDataFrame([("q",)], "x string"))


def test_config_and_loads(spark):
    config = loads.config_frame(spark)
    assert len(loads.active_sources(config)) == 12
    assert len(loads.active_sources(config.withColumn("active_flag", F.col("config_id") > 2))) == 10
    rows = lambda xs: spark.createDataFrame([(k, v, datetime(2024, 1, d)) for k, v, d in xs], "k int, v string, at timestamp")
    values = lambda df: sorted((r.k, r.v) for r in df.collect())
    old = rows([(1, "a", 1), (2, "b", 2)])
    new = rows([(1, "late", 1), (2, "B", 3), (3, "c", 4), (3, "cc", 5)])
    assert values(loads.load(old, new, "Full", ["k"])) == values(new)
    assert values(loads.load(old, new, "Watermark", ["k"], "at", loads.high_water(old, "at"))) == [(1, "a"), (2, "B"), (3, "cc")]
    assert values(loads.load(None, new, "Watermark", ["k"], "at")) == [(1, "late"), (2, "B"), (3, "cc")]
    window = (datetime(2024, 1, 1), datetime(2024, 1, 3))
    once = loads.load(old, new, "Watermark", ["k"], "at", window=window)
    assert values(once) == [(1, "late"), (2, "B")] == values(loads.load(once, new, "Watermark", ["k"], "at", window=window))
    feed = rows([(1, "x", 5), (2, "gone", 6), (4, "n", 6)]).withColumn("op", F.when(F.col("k") == 2, "D").otherwise("U"))
    assert values(loads.load(old, feed, "CDC", ["k"], "at")) == [(1, "x"), (4, "n")]
    assert values(loads.load(None, feed, "CDC", ["k"], "at")) == [(1, "x"), (4, "n")]


def test_audit_logs_failures(spark, tmp_path):
    lake, run = Lake(str(tmp_path)), Run()
    table = files.Table(spark, lake.path("metadata", "pipeline_run_audit"))
    log = AuditLog(spark, table)
    with log.step(run.run_id, "ok", "s", "BRONZE") as e:
        e.rows_read = 5
    with pytest.raises(ZeroDivisionError), log.step(run.run_id, "bad", "s", "SILVER"):
        1 / 0  # noqa: B018
    rows = {r.pipeline_name: r for r in table.read().collect()}
    assert rows["ok"].execution_status == "SUCCESS" and rows["ok"].rows_read == 5
    assert rows["bad"].execution_status == "FAILED" and rows["bad"].error_code == "ZeroDivisionError"
    with pytest.raises(ValueError):
        lake.path("platinum", "x")


def test_two_writers_of_one_version(spark, tmp_path):
    import pytest

    from halyard.sources.files import Table

    frame = lambda v: spark.createDataFrame([(v,)], "v int")
    path = str(tmp_path / "t")
    Table(spark, path).overwrite(frame(1))
    a, b = Table(spark, path), Table(spark, path)
    a.read(), b.read()
    a.overwrite(frame(2))
    with pytest.raises(RuntimeError):
        b.overwrite(frame(3))
    c, d = Table(spark, path), Table(spark, path)
    taken = d._numbers()
    c.overwrite(frame(4))
    d._numbers = lambda: taken  # it looked before the other wrote
    d._latest = lambda: None
    with pytest.raises(RuntimeError):
        d.overwrite(frame(5))
    assert [r.v for r in Table(spark, path).read().collect()] == [4]
    b.read()
    b.overwrite(frame(6))
    assert Table(spark, path).read().first().v == 6


def test_rewrite_keeps_rows_that_are_appended_meanwhile(spark, tmp_path):
    from halyard.sources.files import Table

    path = str(tmp_path / "log")
    log, other = Table(spark, path), Table(spark, path)
    log.overwrite(spark.createDataFrame([(1,)], "v int"))
    added = []

    def change(rows):
        if not added:  # another process appends while the new version is made
            added.append(1)
            spark.createDataFrame([(2,)], "v int").write.mode("append").parquet(f"{path}/{other.version()}")
        return rows.selectExpr("v * 10 AS v")

    log.rewrite(change)
    assert sorted(r.v for r in other.read().collect()) == [10, 20]


def test_database_source_and_sink(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    files.write_jdbc(spark.range(100).selectExpr("id", "id % 7 AS k"), url, "facts", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    files.write_jdbc(spark.range(100, 110).selectExpr("id", "id % 7 AS k"), url, "facts")
    whole = files.read_jdbc(spark, url, "facts")
    assert sorted(map(tuple, whole.collect())) == [(i, i % 7) for i in range(110)]
    parts = files.read_jdbc(spark, url, "facts", "id", (0, 110), 4)
    assert parts.rdd.getNumPartitions() == 4 and parts.count() == 110
    assert "PushedFilters: [*IsNotNull(k), *EqualTo(k,3)]" in whole.filter("k = 3")._jdf.queryExecution().executedPlan().toString()
    files.write_jdbc(spark.range(2).selectExpr("id", "id AS k"), url, "facts", mode="overwrite")
    assert files.read_jdbc(spark, url, "facts").count() == 2
