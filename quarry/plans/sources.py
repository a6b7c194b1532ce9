"""Registered queries: scans, sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators import booking as bk
from quarry.operators.profile import table_counts
from quarry.plans import fixtures as fx
from quarry.plans.registry import query
from quarry.session import scratch_path
from quarry.sources import infer, io
from quarry.spec import APPOINTMENTS, BILLING, CLINIC_TABLES, DOCTORS, PATIENTS


def _csv_round_trip(spark, sf_dir, sep: str, name: str):
    t = fx.Tables(spark, sf_dir)
    customer = t("customer")
    path = io.write_csv(customer, scratch_path(spark, name), sep=sep)
    return io.read_csv(spark, path, customer.schema, sep=sep)


@query("csv_scan_semicolon", sql="SELECT * FROM customer")
def csv_scan_semicolon(spark, sf_dir):
    """Customer written as a ';' CSV, scanned back with its schema."""
    return _csv_round_trip(spark, sf_dir, ";", "csv_semicolon")


@query("csv_scan_comma", sql="SELECT * FROM customer")
def csv_scan_comma(spark, sf_dir):
    """S2."""
    return _csv_round_trip(spark, sf_dir, ",", "csv_comma")


#: The stand-in of the inferring scan: customers with gaps, spelled in several ways,
#: in an integer, a number, a truth value and a text column, and without any value.
_GAPS_SQL = """
SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS c_nationkey,
       CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal > 0 END AS in_credit,
       CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS c_mktsegment,
       CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE c_name END AS mixed,
       CAST(NULL AS DOUBLE) AS nothing
FROM customer"""


def _csv_with_gaps(spark, sf_dir):
    key = F.col("c_custkey")

    def gaps(value, every, token):
        return F.when(key % every == 0, F.lit(token)).otherwise(value.cast("string"))

    rows = fx.Tables(spark, sf_dir)("customer").select(
        key.cast("string").alias("c_custkey"), gaps(F.col("c_nationkey"), 7, "NA").alias("c_nationkey"),
        gaps(F.col("c_acctbal"), 11, "n/a").alias("c_acctbal"),
        gaps(F.initcap((F.col("c_acctbal") > 0).cast("string")), 5, "NULL").alias("in_credit"),
        gaps(F.col("c_mktsegment"), 13, "").alias("c_mktsegment"),
        F.when(key % 2 == 0, F.col("c_nationkey").cast("string")).otherwise(F.col("c_name")).alias("mixed"),
        F.lit("nan").alias("nothing"))
    return io.write_csv(rows, scratch_path(spark, "csv_gaps"), sep=";")


@query("csv_scan_inferred", sql=f"""
SELECT c_custkey, CAST(coalesce(c_nationkey, -1) AS BIGINT) AS c_nationkey, c_acctbal,
       coalesce(in_credit, FALSE) AS in_credit, in_credit IS NULL AS credit_unknown, c_mktsegment, mixed, nothing
FROM ({_GAPS_SQL}) AS t""")
def csv_scan_inferred(spark, sf_dir):
    """S1 without a schema: a ';' CSV with missing-value tokens, types from its
    values.  Gaps of the integer show as -1, those of the truth value as a flag."""
    rows = infer.read_csv_inferred(spark, _csv_with_gaps(spark, sf_dir), sep=";")
    return rows.select(
        "c_custkey", F.coalesce("c_nationkey", F.lit(-1).cast("bigint")).alias("c_nationkey"), "c_acctbal",
        F.coalesce("in_credit", F.lit(False)).alias("in_credit"), F.col("in_credit").isNull().alias("credit_unknown"),
        "c_mktsegment", "mixed", "nothing")


@query("csv_inferred_types", sql="WITH t AS (" + _GAPS_SQL + ")\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{k}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS n_missing FROM t"
    for c, k in {"c_custkey": "bigint", "c_nationkey": "bigint", "c_acctbal": "double", "in_credit": "boolean",
                 "c_mktsegment": "string", "mixed": "string", "nothing": "double"}.items()))
def csv_inferred_types(spark, sf_dir):
    """The types found, with the rows and missing fields of each column."""
    return infer.type_report(infer.scan_text(spark, _csv_with_gaps(spark, sf_dir), sep=";"))


@query("csv_sink", sql="SELECT * FROM customer")
def csv_sink(spark, sf_dir):
    """S3: the sink's output read back equals its input."""
    return _csv_round_trip(spark, sf_dir, ",", "csv_sink")


@query("raw_landing", sql="""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer""")
def raw_landing(spark, sf_dir):
    """The CSV landed untouched (all text) as parquet in raw/."""
    t = fx.Tables(spark, sf_dir)
    src = io.write_csv(t("customer"), scratch_path(spark, "landing_src"))
    return io.land_raw(spark, src, scratch_path(spark, "raw"))


def _clinic_frames(spark, sf_dir):
    """The four clinic tables loaded from the fixtures, parents first."""
    t = fx.Tables(spark, sf_dir)
    held = fx.held(t)
    bills = bk.issue_invoices(held.filter(F.col("status") == "Confirmed"), fx.doctors(t))
    return [
        (PATIENTS, io.conform(fx.patients(t), PATIENTS)),
        (DOCTORS, io.conform(fx.doctors(t), DOCTORS)),
        (APPOINTMENTS, io.conform(held, APPOINTMENTS)),
        (BILLING, io.conform(bills, BILLING)),
    ]


def _new_store(spark):
    db = f"quarry_{uuid.uuid4().hex[:12]}"
    io.create_tables(spark, CLINIC_TABLES, db, scratch_path(spark, "store"))
    return db


def _store_counts(spark, db):
    return table_counts({s.name: spark.table(f"{db}.{s.name}") for s in CLINIC_TABLES})


_CLINIC_COUNTS = "WITH " + fx.BOOKING_SQL + """,
counts AS (
  SELECT 'patients' AS table_name, count(*) AS n FROM pat
  UNION ALL SELECT 'doctors', count(*) FROM doc
  UNION ALL SELECT 'appointments', count(*) FROM held
  UNION ALL SELECT 'billing', count(*) FROM held h JOIN doc d ON h.doctor_id = d.doctor_id
            WHERE h.status = 'Confirmed')
"""


@query("create_tables", sql=_CLINIC_COUNTS + "SELECT table_name, CAST(n AS BIGINT) AS n_rows FROM counts")
def create_tables(spark, sf_dir):
    """DDL from the specs (IF NOT EXISTS, DEFAULTs), loaded once."""
    db = _new_store(spark)
    io.create_tables(spark, CLINIC_TABLES, db, scratch_path(spark, "store"))  # idempotent re-run
    io.overwrite_reload([(f"{db}.{s.name}", df) for s, df in _clinic_frames(spark, sf_dir)])
    return _store_counts(spark, db)


@query("overwrite_reload", sql=_CLINIC_COUNTS + "SELECT table_name, CAST(n AS BIGINT) AS n_rows FROM counts")
def overwrite_reload(spark, sf_dir):
    """Two full reloads leave exactly one copy."""
    db = _new_store(spark)
    frames = _clinic_frames(spark, sf_dir)
    for _ in range(2):
        io.overwrite_reload([(f"{db}.{s.name}", df) for s, df in frames])
    return _store_counts(spark, db)


@query("bulk_append", sql=_CLINIC_COUNTS + "SELECT table_name, CAST(2 * n AS BIGINT) AS n_rows FROM counts")
def bulk_append(spark, sf_dir):
    """One load plus one set-based append of the same rows."""
    db = _new_store(spark)
    frames = _clinic_frames(spark, sf_dir)
    io.overwrite_reload([(f"{db}.{s.name}", df) for s, df in frames])
    for s, df in frames:
        io.bulk_append(f"{db}.{s.name}", df)
    return _store_counts(spark, db)


@query("list_tables", sql=_CLINIC_COUNTS + """
SELECT table_name, true AS present, CAST(n AS BIGINT) AS n_rows FROM counts""")
def list_tables(spark, sf_dir):
    """The required tables exist (and hold the loaded rows)."""
    db = _new_store(spark)
    io.overwrite_reload([(f"{db}.{s.name}", df) for s, df in _clinic_frames(spark, sf_dir)])
    listed = io.list_tables(spark, db, [s.name for s in CLINIC_TABLES])
    return listed.join(_store_counts(spark, db), "table_name", "left")


@query("sequence_source", sql="""
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
days AS (SELECT CAST(g AS DATE) AS day, CAST(date_diff('day', lo, CAST(g AS DATE)) + 1 AS INTEGER) AS day_index
         FROM b, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) AS s(g)),
per_day AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT day_index, strftime(days.day, '%Y-%m-%d') AS day, CAST(coalesce(n, 0) AS BIGINT) AS n_orders
FROM days LEFT JOIN per_day USING (day)
""")
def sequence_source(spark, sf_dir):
    """A dense day index over the order dates, zero-filled counts."""
    o = fx.Tables(spark, sf_dir)("orders")
    spine = io.day_spine(o, "o_orderdate")
    per_day = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(per_day, "day", "left").select(
        "day_index", F.date_format("day", "yyyy-MM-dd").alias("day"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n_orders"))


@query("full_table_scan", sql="SELECT * FROM orders")
def full_table_scan(spark, sf_dir):
    """S11."""
    return fx.Tables(spark, sf_dir)("orders")
