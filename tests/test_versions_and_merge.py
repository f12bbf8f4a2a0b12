from datetime import datetime

import pytest
from pyspark.sql import functions as F

from halyard.operators import merge as M
from halyard.operators import star as S
from halyard.operators import versions as V


def day(n, hour=0):
    return datetime(2024, 1, n, hour)


HISTORY = "patient_id string, street string, insurance string, city string, updated_at timestamp, is_deleted boolean"


def test_versions_follow_tracked_columns(spark):
    rows = [
        ("p", "a", "x", "c1", day(1), False),
        ("p", "a", "x", "c2", day(2), False),  # an untracked change: no version
        ("p", "b", "x", "c2", day(3), False),
        ("p", "a", "x", "c2", day(4), False),  # back again: a version
        ("p", "a", "x", "c2", day(5), True),  # deleted
        ("q", None, "x", "c", day(1), None),
    ]
    got = V.build_versions(spark.createDataFrame(rows, HISTORY), "patient_id", "updated_at", ["street", "insurance"], deleted="is_deleted")
    assert sorted((r.patient_id, r.effective_start_date.day, r.effective_end_date and r.effective_end_date.day, r.is_current) for r in got.collect()) == [("p", 1, 3, False), ("p", 3, 4, False), ("p", 4, 5, False), ("q", 1, None, True)]


def test_applying_a_batch_twice_changes_nothing(spark):
    first = spark.createDataFrame([("p", "a", "x", "c", day(1), False), ("q", "a", "x", "c", day(1), False)], HISTORY)
    dim = V.build_versions(first, "patient_id", "updated_at", ["street", "insurance"]).drop("updated_at", "is_deleted")
    batch = spark.createDataFrame([("p", "b", "x", "c", day(5), False), ("q", "a", "x", "elsewhere", day(5), False), ("n", "z", "x", "c", day(5), False)], HISTORY)
    once = V.apply_versions(dim, batch, "patient_id", "updated_at", ["street", "insurance"])
    rows = sorted((r.patient_id, r.street, r.is_current) for r in once.collect())
    assert rows == [("n", "z", True), ("p", "a", False), ("p", "b", True), ("q", "a", True)]
    twice = V.apply_versions(once, batch, "patient_id", "updated_at", ["street", "insurance"])
    assert twice.exceptAll(once).isEmpty() and once.exceptAll(twice).isEmpty()


def test_point_in_time_is_half_open(spark):
    history = spark.createDataFrame([("p", "a", "x", "c", day(2), False), ("p", "b", "x", "c", day(4), False)], HISTORY)
    dim = V.build_versions(history, "patient_id", "updated_at", ["street", "insurance"])
    facts = spark.createDataFrame([(1, "p", day(1)), (2, "p", day(2)), (3, "p", day(4)), (4, "p", day(3, 23)), (5, "z", day(3)), (6, None, day(3))], "id int, patient_id string, at timestamp")
    joined = V.as_of(facts, dim, "patient_id", "at", ["street"])
    assert {r.id: r.street for r in joined.collect()} == {1: None, 2: "a", 3: "b", 4: "a", 5: None, 6: None}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_upsert_and_actions(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(2, "B", False), (3, "c", True), (4, None, False)], "k int, v string, gone boolean")
    got = M.upsert(old, new, ["k"], "gone")
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "a"), (2, "B"), (4, None)]
    again = M.upsert(got, new, ["k"], "gone")
    assert again.exceptAll(got).isEmpty() and got.exceptAll(again).isEmpty()
    assert {r.k: r.action for r in M.merge_actions(old, new, ["k"], ["v"]).collect()} == {2: "update", 3: "update", 4: "insert"}
    with pytest.raises(M.AmbiguousMerge):
        M.check_unique(new.union(new), ["k"])


def test_net_changes_and_latest(spark):
    feed = spark.createDataFrame([(1, "I", 1), (1, "U", 3), (1, "U", 2), (2, "I", 1), (2, "D", 5), (2, "D", 5)], "k int, op string, seq int")
    assert sorted((r.k, r.op, r.seq) for r in M.net_changes(feed, ["k"], "seq").collect()) == [(1, "U", 3), (2, "D", 5)]


@pytest.mark.parametrize("kind", ["string", "long"])
def test_surrogate_keys_are_dense_and_stable(spark, kind):
    keys = [f"k{i:05d}" for i in range(500)] if kind == "string" else [i * 977 - 60_000 for i in range(500)]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], f"k {kind}")
    first = M.surrogate_keys(df, "k", "sk")
    assert sorted(r.sk for r in first.collect()) == list(range(1, 501)) and first.select("k").distinct().count() == 500
    assert first.exceptAll(M.surrogate_keys(df.repartition(3), "k", "sk")).isEmpty()
    more = spark.createDataFrame([(k,) for k in (["a", keys[0], "z"] if kind == "string" else [-(10**9), keys[0], 10**12])], f"k {kind}")
    assert sorted(r.sk for r in M.surrogate_keys(more, "k", "sk", first).collect()) == [501, 502]


def test_lookup_and_unknown_member(spark):
    dim = S.with_unknown(spark.createDataFrame([(1, "a"), (2, "b")], "sk long, key string"), "sk", "key")
    assert sorted((r.sk, r.key) for r in dim.collect()) == [(-1, "UNKNOWN"), (1, "a"), (2, "b")]
    facts = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None), (4, "UNKNOWN")], "id int, key string")
    assert {r.id: r.sk for r in S.lookup(facts, dim, "key", "sk", rows=3).collect()} == {1: 1, 2: -1, 3: -1, 4: -1}


def test_readmission_window(spark):
    base = [("p", "e1", day(1), day(2))]
    rows = base + [("p29", "a", day(1), day(1)), ("p29", "b", datetime(2024, 1, 30), None), ("p30", "a", day(1), day(1)), ("p30", "b", datetime(2024, 1, 31), None), ("p31", "a", day(1), day(1)), ("p31", "b", datetime(2024, 2, 1), None), ("o", "long", day(1), day(20)), ("o", "short", day(3), day(4)), ("o", "next", datetime(2024, 2, 15), None), ("t", "x", day(5), day(5)), ("t", "y", day(5), None)]
    df = spark.createDataFrame(rows, "patient string, id string, admission timestamp, discharge timestamp")
    got = {(r.patient, r.id): r.f for r in df.withColumn("f", S.readmitted("patient", "admission", "discharge", "id")).collect()}
    # "next" comes 26 days after the long stay, though 42 after the short one that began later.
    assert [k for k, f in sorted(got.items()) if f] == [("o", "next"), ("p29", "b"), ("p30", "b"), ("t", "y")]


def test_reconcile(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert tuple(S.reconcile(a, b, "k").first()) == (3, 2, 1, 1)
    assert tuple(S.reconcile(a.limit(0), b.limit(0), "k").first()) == (0, 0, 0, 0)


def test_hash_surrogate_is_never_negative(spark):
    assert spark.range(1000).filter(M.hash_surrogate(["id"]) < 0).isEmpty()
    assert spark.range(5).select(M.hash_surrogate(["id"]).alias("h")).agg(F.countDistinct("h")).first()[0] == 5


def test_a_batch_from_before_a_deletion_changes_nothing(spark):
    from halyard import schemas
    from halyard.plans.gold import dim_patient

    attributes = list(schemas.PATIENT_ATTRIBUTES)

    def batch(at, deleted, street="a"):
        values = {c: "x" for c in attributes} | {"patient_id": "p", "address_street": street, "updated_at": at, "is_deleted": deleted}
        ddl = ", ".join(["patient_id string", *[f"{c} {'date' if c == 'date_of_birth' else 'string'}" for c in attributes], "updated_at timestamp", "is_deleted boolean"])
        values |= {"date_of_birth": at.date()} if "date_of_birth" in attributes else {}
        return spark.createDataFrame([tuple(values[c.split()[0]] for c in ddl.split(", "))], ddl)

    def fresh(df):
        return spark.createDataFrame(df.collect(), df.schema)

    def seen(df):
        return sorted((r.effective_start_date.day, r.effective_end_date and r.effective_end_date.day, r.is_current) for r in df.collect() if r.patient_id == "p")

    first = batch(day(1), False)
    dim = fresh(dim_patient(first, None))
    dim = fresh(dim_patient(batch(day(10), True), dim))
    assert seen(dim) == [(1, 10, False)]
    dim = fresh(dim_patient(first, dim))  # the first batch again
    assert seen(dim) == [(1, 10, False)]
    dim = fresh(dim_patient(batch(day(5), False, "late"), dim))  # a change from before the deletion
    assert seen(dim) == [(1, 10, False)]
    dim = fresh(dim_patient(batch(day(20), False), dim))  # back, unchanged
    assert seen(dim) == [(1, 10, False), (20, None, True)]
    dim = fresh(dim_patient(batch(day(10), True), dim))  # the old deletion again
    assert seen(dim) == [(1, 10, False), (20, None, True)]
    keys = [r.patient_sk for r in dim.collect()]
    assert len(keys) == len(set(keys))


def test_null_keys_are_merged_like_others(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    new = spark.createDataFrame([(None, "A")], "k int, v string")
    once = M.upsert(old, new, ["k"])
    assert sorted(map(tuple, once.collect()), key=str) == [(1, "b"), (None, "A")]
    assert sorted(map(tuple, M.upsert(once, new, ["k"]).collect()), key=str) == [(1, "b"), (None, "A")]
