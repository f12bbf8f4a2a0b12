import os

import duckdb
import pytest

from halyard import queries as Q


@pytest.fixture(scope="module")
def oracle(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(sf_dir):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    return c


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return list(pdf.columns), sorted(str([None if x is None or x != x else str(x) for x in r]) for r in pdf.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query_equals_its_sql(spark, sf_dir, oracle, name):
    assert name in Q.ORACLES
    got, want = rows(Q.QUERIES[name](spark, sf_dir).toPandas()), rows(oracle.execute(Q.ORACLES[name]).df())
    assert got == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["scd2_point_in_time", "star_lookup", "merge_upsert", "dq_referential"])
def test_no_nested_loops(spark, sf_dir, name):
    plan = Q.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_pushdown(spark, sf_dir):
    plan = Q.QUERIES["dq_non_negative"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan
    plan = Q.QUERIES["star_lookup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in plan
