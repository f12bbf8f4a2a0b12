"""The operators as queries over the driver's tables, each with SQL that says the same.

A customer stands for a patient, a supplier for a provider, nations and regions for
facilities, orders for encounters, line items for observations and claims, parts for
coded references, and events for a change feed with JSON payloads.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import suppress
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard import functions as H
from halyard import schemas
from halyard.config import Lake, Run, shared_dir
from halyard.operators import merge, quality, star, versions
from halyard.plans import gold, reports, silver
from halyard.plans.audit import SKIPPED, AuditLog
from halyard.sources import files, loads, synthetic
from halyard.streaming import ingest

AS_OF = datetime(2024, 2, 1, tzinfo=UTC)
RUN = "run-0000000001"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str):
    return F.col(c).cast("decimal(18,2)")


# ---- scalar functions ---------------------------------------------------------------


@query("SELECT c_custkey, sha256(concat_ws('||', coalesce(CAST(c_custkey AS VARCHAR), ''), coalesce(c_name, ''), coalesce(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), ''), coalesce(c_mktsegment, ''))) AS record_hash FROM customer")
def record_hash(spark, d):
    return t(spark, d, "customer").select("c_custkey", H.record_hash(["c_custkey", "c_name", money("c_acctbal"), "c_mktsegment"]).alias("record_hash"))


@query("SELECT c_custkey, sha256(coalesce(CAST(nullif(c_custkey % 7, 0) AS VARCHAR), '')) AS ssn_hash FROM customer")
def mask_ssn(spark, d):
    return t(spark, d, "customer").select("c_custkey", H.mask_ssn(F.nullif(F.col("c_custkey") % 7, F.lit(0))).alias("ssn_hash"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE substr(c_name, 1, 1) || '***' END AS masked FROM customer")
def mask_name(spark, d):
    return t(spark, d, "customer").select("c_custkey", H.mask_name(F.when(F.col("c_custkey") % 11 != 0, F.col("c_name"))).alias("masked"))


@query("SELECT o_orderkey, replace('Customer/' || CAST(o_custkey AS VARCHAR) || '/Customer/x', 'Customer/', '') AS customer_id FROM orders")
def ref_strip(spark, d):
    ref = F.concat(F.lit("Customer/"), F.col("o_custkey").cast("string"), F.lit("/Customer/x"))
    return t(spark, d, "orders").select("o_orderkey", H.strip_reference(ref, "Customer").alias("customer_id"))


@query("SELECT c_custkey, coalesce(CAST(nullif(c_mktsegment, 'BUILDING') AS VARCHAR), 'UNKNOWN') AS segment FROM customer")
def null_default(spark, d):
    return t(spark, d, "customer").select("c_custkey", H.default_text(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))).alias("segment"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
  TRY_CAST(CASE WHEN l_linenumber % 3 = 0 THEN 'bad' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS DOUBLE) AS qty,
  TRY_CAST(CASE WHEN l_linenumber % 2 = 0 THEN 'n/a' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS DECIMAL(18,4))::DOUBLE AS price,
  TRY_CAST(CASE WHEN l_linenumber % 4 = 0 THEN '2024-13-45' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS DATE)::VARCHAR AS shipped FROM lineitem""")
def safe_cast(spark, d):
    n = F.col("l_linenumber")
    return t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        H.to_double(F.when(n % 3 == 0, F.lit("bad")).otherwise(F.col("l_quantity").cast("long").cast("string"))).alias("qty"),
        H.to_decimal(F.when(n % 2 == 0, F.lit("n/a")).otherwise(money("l_extendedprice").cast("string")), 18, 4).cast("double").alias("price"),
        H.to_date(F.when(n % 4 == 0, F.lit("2024-13-45")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))).cast("string").alias("shipped"),
    )


@query("SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key FROM orders")
def date_key(spark, d):
    return t(spark, d, "orders").select("o_orderkey", H.date_key("o_orderdate").alias("order_date_key"))


_STAYS = """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_orderdate, CASE WHEN l.l_linenumber % 5 = 0 THEN NULL ELSE l.l_shipdate END AS ended
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


def _stays(spark, d):
    line = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_linenumber") % 5 != 0, F.col("l_shipdate")).alias("ended"))
    return line.join(t(spark, d, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(epoch(ended) - epoch(o_orderdate) AS DECIMAL(18,2)) / 3600 AS DECIMAL(10,2))::DOUBLE AS los_hours FROM ({_STAYS})")
def los_hours(spark, d):
    return _stays(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", H.los_hours("o_orderdate", "ended").cast("double").alias("los_hours"))


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, CAST(trunc((epoch(ended) - epoch(o_orderdate)) / 60) AS DOUBLE) AS turnaround_minutes FROM ({_STAYS})")
def turnaround(spark, d):
    return _stays(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", H.turnaround_minutes("o_orderdate", "ended").cast("double").alias("turnaround_minutes"))


# ---- nested data --------------------------------------------------------------------


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark, d):
    return t(spark, d, "events").select("event_id", F.from_json("props", "k long").getField("k").alias("k"))


@query("SELECT vec_id, embedding[1] AS first, CAST(NULL AS FLOAT) AS beyond FROM embeddings")
def array_get(spark, d):
    return t(spark, d, "embeddings").select("vec_id", H.first_of("embedding").alias("first"), F.get("embedding", 100_000).alias("beyond"))


@query("SELECT vec_id, unnest(embedding) AS x FROM embeddings WHERE len(embedding) > 0")
def explode_array(spark, d):
    return t(spark, d, "embeddings").select("vec_id", F.explode("embedding").alias("x"))


@query("SELECT c_custkey AS patient_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name, 'Commercial' AS insurance_type, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance FROM customer")
def project_flatten(spark, d):
    """A nested resource, built from the flat row, is unnested and projected again."""
    c = t(spark, d, "customer")
    resource = F.struct(F.col("c_custkey").alias("id"), F.array(F.struct(F.split("c_name", "#").alias("parts"))).alias("name"), F.struct(money("c_acctbal").cast("double").alias("value")).alias("balance"))
    flat = files.unnest(c.select(F.array(F.struct(resource.alias("resource"))).alias("entry")))
    parts = H.first_of("name").getField("parts")
    return flat.select(F.col("id").alias("patient_id"), F.get(parts, 0).alias("first_name"), F.coalesce(F.get(parts, 1), F.lit("")).alias("last_name"), F.lit("Commercial").alias("insurance_type"), F.col("balance.value").alias("balance"))


@query("SELECT event_id, event_type FROM events WHERE event_type = (SELECT min(event_type) FROM events)")
def filter_type(spark, d):
    e = t(spark, d, "events").select("event_id", "event_type")
    kind = e.agg(F.min("event_type").alias("kind"))
    return e.join(F.broadcast(kind), F.col("event_type") == F.col("kind")).select("event_id", "event_type")


@query(f"SELECT event_id, user_id, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp, '{RUN}' AS pipeline_run_id FROM events")
def bronze_lineage(spark, d):
    rows = files.with_lineage(t(spark, d, "events").select("event_id", "user_id"), RUN, AS_OF)
    return rows.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


# ---- quality rules ------------------------------------------------------------------


def _status(df: DataFrame, rules: list[quality.Rule], key: str) -> DataFrame:
    return quality.judge(df, rules, AS_OF).select(key, F.col("_rule").isNull().alias("valid"))


@query("SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') IS NOT NULL AS valid FROM customer")
def dq_not_null(spark, d):
    c = t(spark, d, "customer").withColumn("segment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    return _status(c, [quality.Rule("customers", "segment", "NOT_NULL", "segment IS NOT NULL")], "c_custkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, (q IS NULL OR (q >= 5 AND q <= 45)) AS valid FROM (SELECT *, nullif(l_quantity, 10) AS q FROM lineitem)")
def dq_range(spark, d):
    rows = t(spark, d, "lineitem").withColumn("q", F.nullif(F.col("l_quantity"), F.lit(10.0)))
    rule = quality.Rule("items", "q", "RANGE", "q IS NULL OR (q >= 5 AND q <= 45)")
    return quality.judge(rows, [rule]).select("l_orderkey", "l_linenumber", "l_partkey", F.col("_rule").isNull().alias("valid"))


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END >= 0, false) AS valid FROM customer")
def dq_non_negative(spark, d):
    """A null amount makes the rule unknown: the row is rejected, never lost."""
    c = t(spark, d, "customer").withColumn("amount", F.when(F.col("c_custkey") % 13 != 0, F.col("c_acctbal")))
    return _status(c, [quality.Rule("claims", "amount", "RANGE", "amount >= 0")], "c_custkey")


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, (ended IS NULL OR coalesce(ended >= o_orderdate, false)) AS valid FROM ({_STAYS})")
def dq_cross_column(spark, d):
    rule = quality.Rule("stays", "ended", "RANGE", "ended IS NULL OR ended >= o_orderdate")
    return quality.judge(_stays(spark, d), [rule]).select("l_orderkey", "l_linenumber", "l_partkey", F.col("_rule").isNull().alias("valid"))


@query("SELECT event_id, coalesce(ts <= TIMESTAMP '2024-01-15 00:00:00', false) AS valid FROM events")
def dq_not_future(spark, d):
    e = t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    judged = quality.judge(e, [quality.Rule("events", "ts", "RANGE", "ts <= :as_of")], datetime(2024, 1, 15, tzinfo=UTC))
    return judged.select("event_id", F.col("_rule").isNull().alias("valid"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def dq_referential(spark, d):
    parents = t(spark, d, "customer").filter("c_acctbal >= 0")
    return quality.orphans(t(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", parents, "c_custkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, (count(*) OVER (PARTITION BY l_orderkey, l_linenumber)) = 1 AS valid FROM lineitem")
def dq_unique(spark, d):
    rows = quality.flag_unique(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"])
    rule = quality.Rule("items", "l_linenumber", "UNIQUE", "_unique")
    return quality.judge(rows, [rule]).select("l_orderkey", "l_linenumber", "l_partkey", F.col("_rule").isNull().alias("valid"))


@query("SELECT p_partkey, regexp_matches(p_brand, '^Brand#[1-3][0-9]*$') AS valid FROM part")
def dq_regex(spark, d):
    return _status(t(spark, d, "part"), [quality.Rule("parts", "p_brand", "REGEX", "p_brand RLIKE '^Brand#[1-3][0-9]*$'")], "p_partkey")


@query("SELECT newest, age_hours, age_hours <= 72 AS fresh FROM (SELECT max(ts) AS newest, (epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(max(ts)))) / 3600 AS age_hours FROM events)")
def dq_freshness(spark, d):
    got = quality.freshness(t(spark, d, "events"), "ts", AS_OF, 72)
    return got.withColumn("newest", F.col("newest").cast("timestamp_ntz"))


#: Rules for the queries on customers; their order decides what a row is charged to.
_RULES = [
    quality.Rule("customers", "c_mktsegment", "NOT_NULL", "segment IS NOT NULL", "CRITICAL"),
    quality.Rule("customers", "c_acctbal", "RANGE", "c_acctbal >= 0", "ERROR", 5.0),
    quality.Rule("customers", "c_nationkey", "RANGE", "c_nationkey < 20", "ERROR", 10.0),
    quality.Rule("customers", "c_name", "REGEX", "c_custkey % 10 <> 0", "WARNING", 20.0),
]
_FIRST = "CASE WHEN NOT coalesce(nullif(c_mktsegment, 'BUILDING') IS NOT NULL, false) THEN 'NOT_NULL:c_mktsegment' WHEN NOT coalesce(c_acctbal >= 0, false) THEN 'RANGE:c_acctbal' WHEN NOT coalesce(c_nationkey < 20, false) THEN 'RANGE:c_nationkey' END"
_LOG = f"SELECT '{RUN}' AS pipeline_run_id, CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE 'odd' END AS source_name, CAST(c_custkey AS VARCHAR) AS record_identifier, {_FIRST} AS failed_rule, 'PENDING' AS resolution_status FROM customer WHERE {_FIRST} IS NOT NULL"


def _customers(spark, d):
    return t(spark, d, "customer").withColumn("segment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))


def _log(spark, d):
    judged = quality.judge(_customers(spark, d), _RULES)
    log = quality.quarantine_rows(judged, _RULES, "customers", RUN, AS_OF, "c_custkey")
    return log.withColumn("source_name", F.when(F.col("record_identifier").cast("long") % 2 == 0, "even").otherwise("odd"))


@query(f"SELECT c_custkey, {_FIRST} AS failed_rule FROM customer")
def dq_first_failing(spark, d):
    judged = quality.judge(_customers(spark, d), _RULES)
    return judged.select("c_custkey", quality._named(_RULES, lambda r: r.name).alias("failed_rule"))


@query(f"SELECT c_custkey, {_FIRST} IS NULL AS kept, c_custkey % 10 = 0 AS warned FROM customer")
def dq_severity(spark, d):
    """A warning is reported and its row kept."""
    c = _customers(spark, d).withColumn("_warnings", quality.warnings(_RULES))
    return quality.judge(c, _RULES).select("c_custkey", F.col("_rule").isNull().alias("kept"), (F.size("_warnings") > 0).alias("warned"))


@query("""WITH f AS (SELECT count(*) AS total, sum(CASE WHEN nullif(c_mktsegment, 'BUILDING') IS NULL THEN 1 ELSE 0 END) AS a, sum(CASE WHEN c_acctbal >= 0 THEN 0 ELSE 1 END) AS b, sum(CASE WHEN c_nationkey < 20 THEN 0 ELSE 1 END) AS c, sum(CASE WHEN c_custkey % 10 <> 0 THEN 0 ELSE 1 END) AS w FROM customer),
  r AS (SELECT 'NOT_NULL:c_mktsegment' AS rule, a AS failed, total, 0.0 AS threshold FROM f UNION ALL SELECT 'RANGE:c_acctbal', b, total, 5.0 FROM f UNION ALL SELECT 'RANGE:c_nationkey', c, total, 10.0 FROM f UNION ALL SELECT 'REGEX:c_name', w, total, 20.0 FROM f)
  SELECT rule, CAST(failed AS BIGINT) AS failed, CAST(total AS BIGINT) AS total, CAST(failed AS DOUBLE) * 100.0 / total AS failed_pct, CAST(failed AS DOUBLE) * 100.0 / total <= threshold AS within FROM r""")
def dq_threshold(spark, d):
    r = quality.rule_report(_customers(spark, d), _RULES)
    pct = F.col("failed").cast("double") * 100.0 / F.col("total")
    return r.select("rule", "failed", "total", pct.alias("failed_pct"), "within")


@query(f"""SELECT '{RUN}' AS pipeline_run_id, 'customers' AS source_name, CAST(c_custkey AS VARCHAR) AS record_identifier, {_FIRST} AS failed_rule,
  to_json({{'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey, 'c_mktsegment': c_mktsegment, 'segment': nullif(c_mktsegment, 'BUILDING')}})::VARCHAR AS raw_payload, 'PENDING' AS resolution_status
  FROM customer WHERE {_FIRST} IS NOT NULL""")
def quarantine_payload(spark, d):
    rules = _RULES[:3]
    judged = quality.judge(_customers(spark, d), rules).drop("c_acctbal")
    rows = quality.quarantine_rows(judged, rules, "customers", RUN, AS_OF, "c_custkey", ignore_nulls=False)
    return rows.select("pipeline_run_id", "source_name", "record_identifier", "failed_rule", "raw_payload", "resolution_status")


@query(f"SELECT source_name, resolution_status, count(*) AS records FROM ({_LOG}) GROUP BY ALL")
def quarantine_distribution(spark, d):
    return reports.quarantine_distribution(_log(spark, d))


@query(f"SELECT failed_rule, count(*) AS failures FROM ({_LOG}) GROUP BY failed_rule")
def rule_failures(spark, d):
    return reports.rule_failures(_log(spark, d))


@query(f"""SELECT CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE 'odd' END AS source_name, count(*) AS rows_read, CAST(sum(CASE WHEN {_FIRST} IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_rejected,
  CAST(sum(CASE WHEN {_FIRST} IS NOT NULL THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*) AS rejection_pct FROM customer GROUP BY 1""")
def rejection_rate(spark, d):
    judged = quality.judge(_customers(spark, d), _RULES).withColumn("source_name", F.when(F.col("c_custkey") % 2 == 0, "even").otherwise("odd"))
    audit = judged.select("source_name", F.lit(1).cast("long").alias("rows_read"), F.col("_rule").isNotNull().cast("long").alias("rows_rejected"))
    return reports.rejection_rate(audit).withColumn("rejection_pct", F.col("rows_rejected").cast("double") * 100.0 / F.col("rows_read"))


@query(f"SELECT source_name, count(*) AS records FROM ({_LOG}) GROUP BY source_name HAVING count(*) > 100")
def quarantine_alert(spark, d):
    return reports.quarantine_alerts(_log(spark, d), 100, "source_name")


@query(f"""SELECT CAST(c_custkey AS VARCHAR) AS record_identifier, {_FIRST} AS failed_rule,
  CASE WHEN nullif(c_mktsegment, 'BUILDING') IS NOT NULL AND c_acctbal >= -500 THEN 'REPLAYED' ELSE 'PENDING' END AS resolution_status FROM customer WHERE {_FIRST} IS NOT NULL""")
def quarantine_replay(spark, d):
    """Quarantined rows are read back from their payload and judged by looser rules."""
    looser = [_RULES[0], quality.Rule("customers", "c_acctbal", "RANGE", "c_acctbal >= -500")]
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string, segment string"
    _, log = quality.replay(_log(spark, d), schema, looser, AS_OF)
    return log.select("record_identifier", "failed_rule", "resolution_status")


# ---- star schema --------------------------------------------------------------------

_DIM = "SELECT c_custkey, CAST(row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 4), c_custkey) AS BIGINT) AS customer_sk FROM customer WHERE c_acctbal >= 0"


def _dim(spark, d):
    good = t(spark, d, "customer").filter("c_acctbal >= 0").select("c_custkey", "c_mktsegment")
    return merge.surrogate_keys(good, "c_custkey", "customer_sk")


@query(f"SELECT o.o_orderkey, c.customer_sk FROM orders o JOIN ({_DIM}) c ON o.o_custkey = c.c_custkey")
def star_lookup(spark, d):
    found = star.lookup(t(spark, d, "orders").select("o_orderkey", "o_custkey"), _dim(spark, d), "o_custkey", "customer_sk", "c_custkey")
    return found.filter(F.col("customer_sk") != star.UNKNOWN_KEY).select("o_orderkey", "customer_sk")


@query(f"SELECT o.o_orderkey, coalesce(c.customer_sk, -1) AS customer_sk FROM orders o LEFT JOIN ({_DIM}) c ON o.o_custkey = c.c_custkey")
def late_arriving_dim(spark, d):
    found = star.lookup(t(spark, d, "orders").select("o_orderkey", "o_custkey"), _dim(spark, d), "o_custkey", "customer_sk", "c_custkey")
    return found.select("o_orderkey", "customer_sk")


@query("SELECT CAST(-1 AS BIGINT) AS s_suppkey, 'UNKNOWN' AS s_name UNION ALL SELECT s_suppkey, s_name FROM supplier")
def unknown_member_union(spark, d):
    return star.with_unknown(t(spark, d, "supplier").select("s_suppkey", "s_name"), "s_suppkey", "s_name")


@query("SELECT p_partkey, CAST(row_number() OVER (ORDER BY substr(md5(CAST(p_partkey AS VARCHAR)), 1, 4), p_partkey) AS BIGINT) + 100 AS part_sk FROM part WHERE p_size >= 15")
def surrogate_key(spark, d):
    """Parts that are known already (the small ones) keep their numbers, up to 100; the others are numbered on."""
    part = t(spark, d, "part").select("p_partkey", "p_size")
    seen = part.filter("p_size < 15").select("p_partkey", F.lit(100).cast("long").alias("part_sk"))
    return merge.surrogate_keys(part.select("p_partkey"), "p_partkey", "part_sk", seen).select("p_partkey", "part_sk")


_DATES = """SELECT CAST(strftime(x, '%Y%m%d') AS INTEGER) AS date_key, CAST(CAST(x AS DATE) AS VARCHAR) AS full_date, CAST(dayofweek(x) + 1 AS INTEGER) AS day_of_week, dayname(x) AS day_name, CAST(day(x) AS INTEGER) AS day_of_month,
  CAST(dayofyear(x) AS INTEGER) AS day_of_year, CAST(weekofyear(x) AS INTEGER) AS week_of_year, CAST(month(x) AS INTEGER) AS month_number, monthname(x) AS month_name, CAST(quarter(x) AS INTEGER) AS quarter, CAST(year(x) AS INTEGER) AS year, dayofweek(x) IN (0, 6) AS is_weekend
  FROM generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 DAY) AS g(x)"""


@query(_DATES.format(first="2023-12-15", last="2025-01-15"))
def date_dim(spark, d):
    return H.date_dimension(spark, "2023-12-15", "2025-01-15").withColumn("full_date", F.col("full_date").cast("string"))


@query(f"WITH d AS ({_DATES.format(first='1990-01-01', last='2026-12-31')}) SELECT d.year, d.quarter, d.is_weekend, count(*) AS orders FROM orders o JOIN d ON CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) = d.date_key GROUP BY ALL")
def date_dim_join(spark, d):
    days = F.broadcast(H.date_dimension(spark, "1990-01-01", "2026-12-31").select("date_key", "year", "quarter", "is_weekend"))  # 13,514 rows, fixed
    keyed = t(spark, d, "orders").select(H.date_key("o_orderdate").alias("date_key"))
    return keyed.join(days, "date_key").groupBy("year", "quarter", "is_weekend").agg(F.count("*").alias("orders"))


# ---- versions, merges and feeds -------------------------------------------------------

_VERSIONS = """SELECT user_id, event_type, ts AS effective_start_date, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS effective_end_date
  FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE before IS NULL OR before <> event_type"""


def _versions(spark, d):
    e = t(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return versions.build_versions(e, "user_id", "ts", ["event_type"], ["event_id"])


@query(f"SELECT *, effective_end_date IS NULL AS is_current FROM ({_VERSIONS})")
def scd2_build(spark, d):
    return _versions(spark, d).select("user_id", "event_type", "effective_start_date", "effective_end_date", "is_current")


@query(f"SELECT user_id, event_type, effective_start_date FROM ({_VERSIONS}) WHERE effective_end_date IS NULL")
def scd2_current(spark, d):
    return versions.current(_versions(spark, d)).select("user_id", "event_type", "effective_start_date")


@query(f"WITH v AS ({_VERSIONS}) SELECT e.event_id, v.event_type AS state, v.effective_start_date FROM events e LEFT JOIN v ON e.user_id = v.user_id AND e.ts + INTERVAL 6 HOUR >= v.effective_start_date AND (v.effective_end_date IS NULL OR e.ts + INTERVAL 6 HOUR < v.effective_end_date)")
def scd2_point_in_time(spark, d):
    later = t(spark, d, "events").select("event_id", "user_id", (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("at"))
    dim = _versions(spark, d).select("user_id", F.col("event_type").alias("state"), F.col("effective_start_date"), "effective_end_date").withColumn("since", F.col("effective_start_date"))
    return versions.as_of(later, dim, "user_id", "at", ["state", "since"]).select("event_id", "state", F.col("since").alias("effective_start_date"))


@query("""WITH old AS (SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS bal FROM customer WHERE c_nationkey < 17),
  new AS (SELECT c_custkey, c_name || '!' AS c_name, CAST(c_acctbal AS DECIMAL(18,2)) + 1 AS bal, c_acctbal < 0 AS gone FROM customer WHERE c_mktsegment <> 'BUILDING')
  SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, CASE WHEN n.c_custkey IS NULL THEN o.c_name ELSE n.c_name END AS c_name, CAST(CASE WHEN n.c_custkey IS NULL THEN o.bal ELSE n.bal END AS DOUBLE) AS bal
  FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey WHERE NOT coalesce(n.gone, false)""")
def merge_upsert(spark, d):
    """Customers of some nations are loaded; a batch changes all but one segment and takes negative balances out."""
    c = t(spark, d, "customer").select("c_custkey", "c_name", money("c_acctbal").alias("bal"), "c_nationkey", "c_mktsegment", "c_acctbal")
    old = c.filter("c_nationkey < 17").select("c_custkey", "c_name", "bal")
    new = c.filter("c_mktsegment <> 'BUILDING'").select("c_custkey", F.concat("c_name", F.lit("!")).alias("c_name"), (F.col("bal") + 1).cast("decimal(18,2)").alias("bal"), (F.col("c_acctbal") < 0).alias("gone"))
    return merge.upsert(old, new, ["c_custkey"], "gone").withColumn("bal", F.col("bal").cast("double"))


@query("SELECT user_id, event_id, event_type AS op FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def cdc_net_changes(spark, d):
    feed = t(spark, d, "events").select("user_id", "event_id", F.col("event_type").alias("op"), F.struct("ts", "event_id").alias("seq"))
    return merge.net_changes(feed, ["user_id"], "seq", "op").select("user_id", "event_id", "op")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1")
def dedup_latest(spark, d):
    order = [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_extendedprice")]
    return merge.latest(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# ---- loads ----------------------------------------------------------------------------


@query("SELECT n_nationkey, n_name FROM nation")
def load_full(spark, d):
    n = t(spark, d, "nation").select("n_nationkey", "n_name")
    return loads.load(n.filter("n_nationkey < 3"), n, "Full", ["n_nationkey"])


_EV = "SELECT event_id, user_id, ts, CAST(value AS DOUBLE) AS value FROM events"


def _events(spark, d):
    return t(spark, d, "events").select("event_id", "user_id", "ts", "value")


@query(f"WITH e AS ({_EV}), old AS (SELECT * FROM e WHERE ts < TIMESTAMP '2024-01-10 00:00:00') SELECT event_id, user_id, ts FROM old UNION ALL SELECT event_id, user_id, ts FROM e WHERE ts > (SELECT max(ts) FROM old)")
def load_watermark(spark, d):
    e = _events(spark, d)
    old = e.filter(F.col("ts") < F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
    return loads.load(old, e, "Watermark", ["event_id"], "ts", loads.high_water(old, "ts")).select("event_id", "user_id", "ts")


@query(f"WITH e AS ({_EV}) SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-12 00:00:00' THEN 'refilled' ELSE 'loaded' END AS state FROM e WHERE ts < TIMESTAMP '2024-01-10 00:00:00' OR (ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-12 00:00:00')")
def load_backfill(spark, d):
    """A backfill overlaps what is loaded: no key comes twice."""
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    e = _events(spark, d)
    old = e.filter(F.col("ts") < at("2024-01-10 00:00:00")).withColumn("state", F.lit("loaded"))
    rows = e.withColumn("state", F.lit("refilled"))
    return loads.load(old, rows, "Watermark", ["event_id"], "ts", window=(at("2024-01-05 00:00:00"), at("2024-01-12 00:00:00"))).select("event_id", "state")


@query("SELECT s_suppkey, s_name, CASE WHEN s_acctbal >= 0 THEN CAST(s_nationkey AS DOUBLE) END AS s_nationkey FROM supplier")
def schema_drift(spark, d):
    """An older batch lacks a column that a newer one has."""
    s = t(spark, d, "supplier")
    older, newer = s.filter("s_acctbal < 0").select("s_suppkey", "s_name"), s.filter("s_acctbal >= 0").select("s_suppkey", "s_name", F.col("s_nationkey").cast("double"))
    return files.evolve(older, newer)


_CONFIG = ", ".join("({}, '{}', '{}', '{}', '{}', {}, '{}')".format(i, s, tb, dest, kind, f"'{w}'" if w else "NULL", k) for i, (s, tb, dest, kind, w, k, _) in enumerate(schemas.CONFIG_ROWS, 1))


@query(f"SELECT source_name, source_table, destination_table, ingestion_type, watermark_column, primary_key_columns FROM (VALUES {_CONFIG}) AS v(config_id, source_name, source_table, destination_table, ingestion_type, watermark_column, primary_key_columns) WHERE config_id <> 10")
def config_lookup(spark, d):
    config = loads.config_frame(spark).withColumn("active_flag", F.col("config_id") != 10)
    return config.filter("active_flag").select("source_name", "source_table", "destination_table", "ingestion_type", "watermark_column", "primary_key_columns")


# ---- analytics --------------------------------------------------------------------------


@query("SELECT n.n_name AS department, count(*) AS encounters FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1")
def encounters_by_dept(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = t(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("department"))
    facts = t(spark, d, "orders").select("o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return reports.encounters_by(facts, "department")


@query(f"SELECT l_linenumber, CAST(sum(h) AS DOUBLE) / count(h) AS avg_los_hours FROM (SELECT l_linenumber, CAST(CAST(epoch(ended) - epoch(o_orderdate) AS DECIMAL(18,2)) / 3600 AS DECIMAL(10,2)) AS h FROM ({_STAYS})) GROUP BY l_linenumber")
def avg_los(spark, d):
    return reports.average_stay(_stays(spark, d).select("l_linenumber", H.los_hours("o_orderdate", "ended").alias("h")), "l_linenumber", "h")


@query("SELECT CAST(count(*) FILTER (o_orderpriority = '1-URGENT') AS BIGINT) AS emergency, CAST(count(*) FILTER (o_orderpriority = '5-LOW') AS BIGINT) AS inpatient FROM orders")
def volume_by_type(spark, d):
    return reports.volume_by_type(t(spark, d, "orders"), "o_orderpriority", {"emergency": "1-URGENT", "inpatient": "5-LOW"})


_READ = """SELECT *, coalesce(epoch(o_orderdate) - epoch(last) BETWEEN 0 AND 30 * 86400, false) AS is_readmission_30d FROM (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate, max(o_orderdate + INTERVAL 1 DAY * (o_orderkey % 9)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM orders)"""


def _readmissions(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    o = o.withColumn("discharged", F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 9).cast("int")))
    return o.withColumn("is_readmission_30d", star.readmitted("o_custkey", "o_orderdate", "discharged", "o_orderkey"))


@query(f"SELECT o_orderkey, is_readmission_30d FROM ({_READ})")
def readmission_flag(spark, d):
    return _readmissions(spark, d).select("o_orderkey", "is_readmission_30d")


@query(f"SELECT o_orderpriority, CAST(count(*) FILTER (is_readmission_30d) AS DOUBLE) / count(*) AS readmission_rate FROM ({_READ}) GROUP BY 1")
def readmission_rate(spark, d):
    return reports.readmission_rate(_readmissions(spark, d), "o_orderpriority")




@query(f"SELECT CAST(l_linenumber AS VARCHAR) AS pipeline_name, CAST(count(*) FILTER (ended >= o_orderdate) AS BIGINT) AS succeeded, CAST(count(*) FILTER (NOT coalesce(ended >= o_orderdate, false)) AS BIGINT) AS failed, count(*) AS runs FROM ({_STAYS}) GROUP BY 1")
def run_status(spark, d):
    ok = F.coalesce(F.col("ended") >= F.col("o_orderdate"), F.lit(False))
    return reports.run_status(_stays(spark, d).select(F.col("l_linenumber").cast("string").alias("pipeline_name"), F.when(ok, "SUCCESS").otherwise("FAILED").alias("execution_status")))


@query(f"SELECT CAST(l_linenumber AS VARCHAR) AS pipeline_name, CAST(sum(CAST(epoch(ended) - epoch(o_orderdate) AS BIGINT)) AS DOUBLE) / count(ended) AS avg_seconds, CAST(max(CAST(epoch(ended) - epoch(o_orderdate) AS BIGINT)) AS DOUBLE) AS max_seconds FROM ({_STAYS}) GROUP BY 1")
def run_duration(spark, d):
    return reports.run_duration(_stays(spark, d).withColumn("pipeline_name", F.col("l_linenumber").cast("string")), "pipeline_name", "o_orderdate", "ended").withColumn("max_seconds", F.col("max_seconds").cast("double"))


@query("SELECT event_type, CAST(sum(CAST(floor(epoch(TIMESTAMP '2024-02-01 00:00:00')) - floor(epoch(ts)) AS BIGINT)) AS DOUBLE) / count(ts) AS avg_latency_seconds, max(CAST(floor(epoch(TIMESTAMP '2024-02-01 00:00:00')) - floor(epoch(ts)) AS BIGINT)) AS max_latency_seconds FROM events GROUP BY 1")
def cdc_latency(spark, d):
    return reports.cdc_latency(files.with_lineage(t(spark, d, "events"), RUN, AS_OF), "event_type", "ts", "ingestion_timestamp")


@query(f"SELECT l_orderkey, l_linenumber, l_partkey FROM ({_STAYS}) WHERE epoch(ended) - epoch(o_orderdate) > 60 * 24 * 60 * 60")
def sla_breach(spark, d):
    return reports.sla_breaches(_stays(spark, d), 60 * 24 * 60, "o_orderdate", "ended").select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT CAST(sum(s) AS BIGINT) AS source_rows, CAST(sum(g) AS BIGINT) AS target_rows, CAST(count(*) FILTER (s > 0 AND g = 0) AS BIGINT) AS missing, CAST(count(*) FILTER (g > 0 AND s = 0) AS BIGINT) AS extra
  FROM (SELECT k, sum(s) AS s, sum(g) AS g FROM (SELECT o_custkey AS k, 1 AS s, 0 AS g FROM orders UNION ALL SELECT c_custkey, 0, 1 FROM customer) GROUP BY k)""")
def reconciliation(spark, d):
    source = t(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    return star.reconcile(source, t(spark, d, "customer").select(F.col("c_custkey").alias("k")), "k")


@query("SELECT 'orders' AS dataset, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customer', count(*) FROM customer")
def row_counts(spark, d):
    counts = [t(spark, d, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("dataset"), "n") for n in ("orders", "lineitem", "customer")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


_FLAGSHIP = """WITH good AS (SELECT c_custkey, c_mktsegment, CAST(row_number() OVER (ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 4), c_custkey) AS BIGINT) AS customer_sk FROM customer WHERE coalesce(c_acctbal >= 0, false))
  SELECT coalesce(g.c_mktsegment, 'UNKNOWN') AS segment, count(*) AS orders, CAST(count(*) FILTER (g.customer_sk IS NULL) AS BIGINT) AS unmatched, CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM orders o LEFT JOIN good g ON o.o_custkey = g.c_custkey GROUP BY 1"""


@query(_FLAGSHIP)
def flagship(spark, d):
    """Validate customers, look their surrogate keys up with an unknown member, report by segment."""
    rule = quality.Rule("customers", "c_acctbal", "RANGE", "c_acctbal >= 0")
    good = quality.judge(t(spark, d, "customer"), [rule]).filter("_rule IS NULL").select("c_custkey", "c_mktsegment")
    dim = merge.surrogate_keys(good, "c_custkey", "customer_sk")
    facts = star.lookup(t(spark, d, "orders").select("o_custkey", "o_totalprice"), dim, "o_custkey", "customer_sk", "c_custkey")
    named = facts.join(dim.select(F.col("customer_sk").alias("_sk"), "c_mktsegment"), F.col("customer_sk") == F.col("_sk"), "left")
    return named.groupBy(H.default_text("c_mktsegment").alias("segment")).agg(F.count("*").alias("orders"), F.count_if(F.col("customer_sk") == star.UNKNOWN_KEY).alias("unmatched"), F.sum(money("o_totalprice")).cast("double").alias("total"))


# ---- streaming --------------------------------------------------------------------------


def _work(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


_EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def stream_upsert(spark, d):
    """Events arrive as a stream of files and are merged by user, the newest kept."""
    at = _work(spark)
    stream = ingest.stream_files(spark, f"{d}/events.parquet", _EVENT).withColumn("seq", F.struct("ts", "event_id"))
    target = files.Table(spark, f"{at}/table")
    ingest.merge_stream(stream, target, ["user_id"], "seq", f"{at}/checkpoint").awaitTermination()
    return target.read().select("user_id", "event_id", "event_type")


@query("SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL HAVING date_trunc('day', min(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR")
def stream_daily_counts(spark, d):
    """Append mode: a day is out when the watermark has passed its end."""
    at = _work(spark)
    counts = ingest.windowed_counts(ingest.stream_files(spark, f"{d}/events.parquet", _EVENT), "ts", "event_type")
    counts.writeStream.format("parquet").option("checkpointLocation", f"{at}/checkpoint").option("path", f"{at}/out").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema("window_start timestamp, event_type string, n long").parquet(f"{at}/out")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


# ---- generated sources ------------------------------------------------------------------


@query("SELECT 'encounters without patient' AS fact, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'patients', 300 UNION ALL SELECT 'left before they came', 0 UNION ALL SELECT 'over three visits', 0")
def generated_sources(spark, d):
    """A seeded sample of the relational sources and what always holds in it."""
    p, e = synthetic.patients(spark, 300), synthetic.encounters(spark, 300)
    orphans = quality.orphans(e, "patient_id", p, "patient_id").agg(F.count("*").alias("n")).select(F.lit("encounters without patient").alias("fact"), "n")
    visits = e.groupBy("patient_id").agg(F.count("*").alias("n"), F.count_if(F.col("discharge_timestamp") <= F.col("admission_timestamp")).alias("bad"))
    one = visits.agg(F.count("*").alias("a"), F.sum("bad").alias("b"), F.count_if(F.col("n") > 3).alias("c"))
    facts = one.select(F.explode(F.array(*[F.struct(F.lit(x).alias("fact"), F.col(c).alias("n")) for x, c in (("patients", "a"), ("left before they came", "b"), ("over three visits", "c"))])).alias("f")).select("f.*")
    return facts.unionByName(orphans)


@query("SELECT 'Condition' AS kind, true AS some UNION ALL SELECT 'Encounter', true UNION ALL SELECT 'Observation', true UNION ALL SELECT 'Patient', true")
def generated_bundle(spark, d):
    resources = files.unnest(synthetic.fhir_bundle(spark, 50, 2))
    return resources.groupBy(F.col("resourceType").alias("kind")).agg((F.count("*") >= 50).alias("some"))


# ---- sinks and the star schema ----------------------------------------------------------


def _lake(spark: SparkSession) -> Lake:
    return Lake(_work(spark))


@query("SELECT CAST(c_custkey AS VARCHAR) AS facility_id, c_name AS facility_name, CAST(NULL AS VARCHAR) AS city, c_mktsegment AS surprise FROM customer")
def csv_scan(spark, d):
    """A CSV file set with a column too few and one too many."""
    at = _work(spark)
    c = t(spark, d, "customer").select(F.col("c_mktsegment").alias("surprise"), F.col("c_name").alias("facility_name"), F.col("c_custkey").alias("facility_id"))
    c.write.option("header", True).csv(at)
    return files.read_csv(spark, at, "facility_info").select("facility_id", "facility_name", "city", "surprise")


@query("""SELECT 'build_a' AS pipeline_name, 'SUCCESS' AS execution_status, CAST(NULL AS VARCHAR) AS error_code, count(*) AS rows_read FROM orders
  UNION ALL SELECT 'build_b', 'SKIPPED', NULL, 0 UNION ALL SELECT 'build_c', 'FAILED', 'ValueError', count(*) FROM customer""")
def audit_sink(spark, d):
    """Three steps of a run, as the audit log holds them."""
    log = AuditLog(spark, files.Table(spark, _lake(spark).path("metadata", "audit")))
    with log.step(RUN, "build_a", "orders", "GOLD") as entry:
        entry.rows_read = t(spark, d, "orders").count()
    with log.step(RUN, "build_b", "none", "GOLD") as entry:
        entry.status = SKIPPED
    with suppress(ValueError), log.step(RUN, "build_c", "customer", "GOLD") as entry:
        entry.rows_read = t(spark, d, "customer").count()
        raise ValueError("stopped")
    return log.table.read().select("pipeline_name", "execution_status", "error_code", "rows_read")


def _claims(spark, d):
    """Orders as claims in text; the cheap ones have negative amounts."""
    text = lambda c: F.col(c).cast("string")
    amount = (money("o_totalprice") - F.lit(50_000).cast("decimal(18,2)")).cast("decimal(18,2)")
    return t(spark, d, "orders").select(text("o_orderkey").alias("claim_id"), text("o_custkey").alias("patient_id"), (F.col("o_orderkey") % 30).cast("string").alias("facility_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("service_date"), amount.cast("string").alias("claim_amount"), F.lit("1.50").alias("paid_amount"), F.col("o_orderstatus").alias("claim_status"), F.lit(None).cast("string").alias("insurance_type"))


def _silver_claims(spark, d) -> Lake:
    lake = _lake(spark)
    files.Table(spark, lake.path("bronze", "bronze_claims")).overwrite(_claims(spark, d))
    silver.build(spark, lake, "silver_claims", Run(RUN, AS_OF), AuditLog(spark, files.Table(spark, lake.path("metadata", "audit"))))
    return lake


_AMOUNT = "CAST(o_totalprice AS DECIMAL(18,2)) - 50000"


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS record_identifier, 'silver_claims' AS source_name, 'RANGE:claim_amount' AS failed_rule, 'PENDING' AS resolution_status FROM orders WHERE {_AMOUNT} < 0")
def quarantine_sink(spark, d):
    """What a Silver build left in the quarantine log."""
    lake = _silver_claims(spark, d)
    return files.Table(spark, lake.path("metadata", "quarantine_records")).read().select("record_identifier", "source_name", "failed_rule", "resolution_status")


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS claim_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS service_date, CAST({_AMOUNT} AS DOUBLE) AS claim_amount FROM orders WHERE {_AMOUNT} >= 0")
def silver_build(spark, d):
    lake = _silver_claims(spark, d)
    return files.Table(spark, lake.path("silver", "silver_claims")).read().select("claim_id", F.col("service_date").cast("string").alias("service_date"), F.col("claim_amount").cast("double").alias("claim_amount"))


#: Days since 1995 on which a customer was last changed: the start of the patient's version.
_SINCE, _SINCE_SQL = "timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 2000 as int))", "TIMESTAMP '1995-01-01 00:00:00' + INTERVAL 1 DAY * (c_custkey % 2000)"


def _silver_rows(spark, d, name: str) -> DataFrame:
    """The driver's tables in the form of a Silver table."""
    s = lambda x: f"cast({x} as string)"
    visit = (f"{s('o_orderkey')} AS encounter_id", f"{s('o_custkey')} AS patient_id", "cast(o_orderdate as timestamp) AS {}", "xxhash64(o_orderkey) AS record_hash", "cast(o_orderdate as timestamp) AS updated_at")
    at = lambda c: [x.format(c) for x in visit]
    rows = {
        "silver_patients": ("customer", [f"{s('c_custkey')} AS patient_id", "c_name AS first_name", *(f"cast(null as {'date' if c == 'date_of_birth' else 'string'}) AS {c}" for c in schemas.PATIENT_ATTRIBUTES if c != "first_name"), f"cast({_SINCE} as timestamp) AS updated_at", "c_acctbal < -900 AS is_deleted"]),
        "silver_providers": ("supplier", [f"{s('s_suppkey')} AS provider_id", "s_name AS last_name", "cast(date'2024-01-01' as timestamp) AS updated_at", "s_name AS record_hash"]),
        "silver_facilities": ("nation", [f"{s('n_nationkey')} AS facility_id", "n_name AS facility_name", "n_name AS record_hash"]),
        "silver_encounters": ("orders", [*at("admission_timestamp"), f"{s('o_orderkey % 13')} AS provider_id", f"{s('o_orderkey % 30')} AS facility_id", "o_orderpriority AS department_id", "o_orderstatus AS encounter_type", "cast(o_orderdate + make_dt_interval(cast(o_orderkey % 9 as int)) as timestamp) AS discharge_timestamp", "cast(null as string) AS discharge_disposition"]),
        "silver_lab_results": ("orders", [*at("order_timestamp"), f"{s('o_orderkey')} AS lab_result_id", "o_orderpriority AS loinc_code", "o_orderstatus AS test_name", "cast(o_totalprice as decimal(18,4)) AS result_value", "'mg' AS result_unit", "'N' AS abnormal_flag", "cast(o_orderdate + make_dt_interval(0, cast(o_orderkey % 40 as int)) as timestamp) AS result_timestamp"]),
        "silver_medications": ("orders", [*at("order_timestamp"), f"{s('o_orderkey')} AS medication_order_id", "o_orderpriority AS rxnorm_code", "lower(o_orderpriority) AS medication_name", "'1' AS dosage", "'oral' AS route", "o_orderstatus AS order_status"]),
        "silver_diagnoses": ("orders", [*at("diagnosis_timestamp"), f"{s('o_orderkey')} AS diagnosis_id", "o_orderpriority AS icd10_code", "lower(o_orderpriority) AS diagnosis_description", "o_orderstatus AS diagnosis_type"]),
    }
    table, columns = rows[name]
    return t(spark, d, table).selectExpr(*columns)


def _gold(spark, d, name: str, *sources: str) -> DataFrame:
    """One table of the star schema, built from the named Silver tables."""
    lake, run = (_silver_claims(spark, d) if "silver_claims" in sources else _lake(spark)), Run(RUN, AS_OF)
    for source in sources:
        if source != "silver_claims":
            files.Table(spark, lake.path("silver", source)).overwrite(_silver_rows(spark, d, source))
    audit = AuditLog(spark, files.Table(spark, lake.path("metadata", "audit")))
    gold.build_dimensions(spark, lake, run, audit)
    if name.startswith("fact_"):
        gold.build_facts(spark, lake, run, audit)
    return files.Table(spark, lake.path("gold", name)).read()


def _numbered(key: str, sk: str, rows: str, more: str = "") -> str:
    """SQL of a dimension: known members by hash cell and key, the unknown one beside them."""
    return f"SELECT {key}, CAST(row_number() OVER (ORDER BY substr(md5({key}), 1, 4), {key}) AS BIGINT) AS {sk}{more} FROM ({rows})"


_PATIENT = _numbered("version", "patient_sk", f"SELECT *, concat_ws('|', patient_id, strftime(since, '%Y-%m-%d %H:%M:%S.%f')) AS version FROM (SELECT CAST(c_custkey AS VARCHAR) AS patient_id, c_name AS first_name, {_SINCE_SQL} AS since FROM customer WHERE c_acctbal >= -900)", ", patient_id, first_name, since")
_PROVIDER = _numbered("provider_id", "provider_sk", "SELECT CAST(s_suppkey AS VARCHAR) AS provider_id, s_name AS last_name FROM supplier", ", last_name")
_FACILITY = _numbered("facility_id", "facility_sk", "SELECT CAST(n_nationkey AS VARCHAR) AS facility_id, n_name AS facility_name FROM nation", ", facility_name")
_PRIORITY = "SELECT DISTINCT o_orderpriority AS {} FROM orders"
_DEPARTMENT, _DIAGNOSIS, _MEDICATION = (_numbered(k, sk, _PRIORITY.format(k)) for k, sk in (("department_id", "department_sk"), ("icd10_code", "diagnosis_sk"), ("rxnorm_code", "medication_sk")))


@query(f"SELECT patient_sk, patient_id, first_name, strftime(since, '%Y-%m-%d') AS started, true AS is_current FROM ({_PATIENT}) UNION ALL SELECT -1, 'UNKNOWN', NULL, '1900-01-01', true")
def gold_patients(spark, d):
    return _gold(spark, d, "dim_patient", "silver_patients").select("patient_sk", "patient_id", "first_name", F.date_format("effective_start_date", "yyyy-MM-dd").alias("started"), "is_current")


@query(f"SELECT provider_sk, provider_id, last_name FROM ({_PROVIDER}) UNION ALL SELECT -1, 'UNKNOWN', NULL")
def gold_providers(spark, d):
    return _gold(spark, d, "dim_provider", "silver_providers").select("provider_sk", "provider_id", "last_name")


@query(f"SELECT facility_sk, facility_id, facility_name FROM ({_FACILITY}) UNION ALL SELECT -1, 'UNKNOWN', NULL")
def gold_facilities(spark, d):
    return _gold(spark, d, "dim_facility", "silver_facilities").select("facility_sk", "facility_id", "facility_name")


@query(f"SELECT diagnosis_sk, icd10_code, lower(icd10_code) AS diagnosis_description FROM ({_DIAGNOSIS}) UNION ALL SELECT -1, 'UNKNOWN', NULL")
def gold_diagnoses(spark, d):
    return _gold(spark, d, "dim_diagnosis", "silver_diagnoses").select("diagnosis_sk", "icd10_code", "diagnosis_description")


@query(f"SELECT medication_sk, rxnorm_code, lower(rxnorm_code) AS medication_name FROM ({_MEDICATION}) UNION ALL SELECT -1, 'UNKNOWN', NULL")
def gold_medications(spark, d):
    return _gold(spark, d, "dim_medication", "silver_medications").select("medication_sk", "rxnorm_code", "medication_name")


@query(f"SELECT department_sk, department_id, department_id AS department_name FROM ({_DEPARTMENT}) UNION ALL SELECT -1, 'UNKNOWN', NULL")
def gold_departments(spark, d):
    return _gold(spark, d, "dim_department", "silver_encounters").select("department_sk", "department_id", "department_name")


def _fact_sql(columns: str, at: str = "o_orderdate", joins: str = "") -> str:
    """SQL of a fact of orders: the patient's version at that time, other members by their keys."""
    return f"SELECT CAST(o_orderkey AS VARCHAR) AS id, coalesce(p.patient_sk, -1) AS patient_sk, CAST(strftime({at}, '%Y%m%d') AS INTEGER) AS date_key, {columns} FROM orders LEFT JOIN ({_PATIENT}) p ON p.patient_id = CAST(o_custkey AS VARCHAR) AND p.since <= {at} {joins}"


_WITH_PROVIDER = f"LEFT JOIN ({_PROVIDER}) r ON r.provider_id = CAST(o_orderkey % 13 AS VARCHAR)"
_WITH_FACILITY = f"LEFT JOIN ({_FACILITY}) f ON f.facility_id = CAST(o_orderkey % 30 AS VARCHAR)"
_VISITS = _READ.replace("o_orderdate, o_orderkey ROWS", "o_orderdate, CAST(o_orderkey AS VARCHAR) ROWS")


@query(_fact_sql(
    "coalesce(provider_sk, -1) AS provider_sk, coalesce(facility_sk, -1) AS facility_sk, department_sk, CAST(o_orderkey % 9 * 24 AS DOUBLE) AS hours, is_readmission_30d",
    joins=f"{_WITH_PROVIDER} {_WITH_FACILITY} JOIN ({_DEPARTMENT}) d ON d.department_id = o_orderpriority JOIN (SELECT o_orderkey AS k, is_readmission_30d FROM ({_VISITS})) v ON v.k = o_orderkey"))
def gold_encounters(spark, d):
    facts = _gold(spark, d, "fact_encounter", "silver_patients", "silver_providers", "silver_facilities", "silver_encounters")
    return facts.select(F.col("encounter_id").alias("id"), "patient_sk", F.col("admission_date_key").alias("date_key"), "provider_sk", "facility_sk", "department_sk", F.col("length_of_stay_hours").cast("double").alias("hours"), "is_readmission_30d")


@query(_fact_sql("CAST(o_totalprice AS DECIMAL(18,4))::DOUBLE AS result_value, CAST(o_orderkey % 40 * 60 AS INTEGER) AS turnaround", "o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 40)"))
def gold_observations(spark, d):
    facts = _gold(spark, d, "fact_observation", "silver_patients", "silver_lab_results")
    return facts.select(F.col("observation_id").alias("id"), "patient_sk", F.col("observation_date_key").alias("date_key"), F.col("result_value").cast("double").alias("result_value"), F.col("turnaround_time_minutes").cast("int").alias("turnaround"))


@query(_fact_sql("coalesce(provider_sk, -1) AS provider_sk, medication_sk, o_orderstatus AS order_status", joins=f"{_WITH_PROVIDER} JOIN ({_MEDICATION}) m ON m.rxnorm_code = o_orderpriority"))
def gold_medication_orders(spark, d):
    """An order's provider is its encounter's."""
    facts = _gold(spark, d, "fact_medication_order", "silver_patients", "silver_providers", "silver_encounters", "silver_medications")
    return facts.select(F.col("medication_order_id").alias("id"), "patient_sk", F.col("order_date_key").alias("date_key"), "provider_sk", "medication_sk", "order_status")


@query(_fact_sql("diagnosis_sk, o_orderstatus AS diagnosis_type", joins=f"JOIN ({_DIAGNOSIS}) g ON g.icd10_code = o_orderpriority"))
def gold_diagnosis_facts(spark, d):
    facts = _gold(spark, d, "fact_diagnosis", "silver_patients", "silver_diagnoses")
    return facts.select(F.col("diagnosis_id").alias("id"), "patient_sk", F.col("diagnosis_date_key").alias("date_key"), "diagnosis_sk", "diagnosis_type")


@query(_fact_sql(f"coalesce(facility_sk, -1) AS facility_sk, CAST({_AMOUNT} AS DOUBLE) AS claim_amount", "date_trunc('day', o_orderdate)", f"{_WITH_FACILITY} WHERE {_AMOUNT} >= 0"))
def gold_claims(spark, d):
    """From text in Bronze over Silver's rules to the fact."""
    facts = _gold(spark, d, "fact_claim", "silver_patients", "silver_facilities", "silver_claims")
    return facts.select(F.col("claim_id").alias("id"), "patient_sk", F.col("service_date_key").alias("date_key"), "facility_sk", F.col("claim_amount").cast("double").alias("claim_amount"))
