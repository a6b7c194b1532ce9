"""Derived inputs shared by the registered queries.

Each fixture exists twice, spelled alike: a Spark builder over the given
tables and a SQL common-table expression for the DuckDB oracle.  Both read
the whole tables; the modulo expressions below define *which* rows play a
role (e.g. already-held bookings), they never thin the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TPCH_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


class Tables:
    """Lazy parquet loader for ``{sf_dir}/{name}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


# --------------------------------------------------------------------------
# WIDE: the 20-column wide record (stands in for the 33-column student row)
# --------------------------------------------------------------------------

WIDE_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    "l_shipdate", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
    "o_orderpriority", "c_name", "c_acctbal", "c_mktsegment", "n_name",
]

# vertical split of WIDE into four tables sharing the generated key
WIDE_PARTS = {
    "line_fact": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax"],
    "line_status": ["l_returnflag", "l_linestatus", "l_shipdate"],
    "order_info": ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "customer_info": ["c_name", "c_acctbal", "c_mktsegment", "n_name"],
}


def wide(t: Tables) -> DataFrame:
    l, o, c, n = t("lineitem"), t("orders"), t("customer"), t("nation")
    # dimension side first: lineitem is shuffled once, on the order key
    enriched = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return l.join(enriched, l.l_orderkey == enriched.o_orderkey).select(*WIDE_COLS)


WIDE_SQL = f"""wide AS (
  SELECT {", ".join(WIDE_COLS)}
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)"""


# --------------------------------------------------------------------------
# DIRTY: events with nulls, padded text, upper-case names and repeated rows
# --------------------------------------------------------------------------

def dirty(t: Tables) -> DataFrame:
    e = t("events")
    base = e.select(
        F.col("event_id").alias("EVENT_ID"),
        F.col("ts").alias("TS"),
        F.col("user_id").alias("USER_ID"),
        F.concat(F.lit(" "), F.nullif(F.col("event_type"), F.lit("view")), F.lit("\t")).alias("EVENT_TYPE"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("value")).alias("VALUE"),
        F.col("props").alias("PROPS"),
    )
    return base.unionByName(base.filter(F.col("EVENT_ID") % 50 == 0))


DIRTY_SQL = """dirty_base AS (
  SELECT event_id AS EVENT_ID, ts AS TS, user_id AS USER_ID,
         ' ' || nullif(event_type, 'view') || chr(9) AS EVENT_TYPE,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS VALUE,
         props AS PROPS
  FROM events),
dirty AS (
  SELECT * FROM dirty_base
  UNION ALL
  SELECT * FROM dirty_base WHERE EVENT_ID % 50 = 0)"""


# --------------------------------------------------------------------------
# Bookings: REQ (requests), HELD (existing appointments), DOC, PAT
# --------------------------------------------------------------------------

def _booking_base(t: Tables) -> DataFrame:
    # number of doctor ids = ceil(1.2 * suppliers), in integer arithmetic
    n_ids = t("supplier").select(F.expr("(6 * count(*) + 4) div 5")).scalar()
    o = t("orders")
    return o.select(
        F.col("o_orderkey").alias("request_id"),
        F.col("o_custkey").alias("patient_id"),
        (F.col("o_custkey") % n_ids).alias("doctor_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("appointment_date"),
        F.col("o_orderpriority").alias("time_slot"),
        F.col("o_orderstatus"),
    )


def requests(t: Tables) -> DataFrame:
    return _booking_base(t).filter(F.col("request_id") % 10 != 0).drop("o_orderstatus")


def held(t: Tables) -> DataFrame:
    return (
        _booking_base(t)
        .filter(F.col("request_id") % 10 == 0)
        .select(
            F.col("request_id").alias("appointment_id"),
            "patient_id", "doctor_id", "appointment_date", "time_slot",
            F.when(F.col("o_orderstatus") == "P", "Cancelled").otherwise("Confirmed").alias("status"),
        )
    )


def doctors(t: Tables) -> DataFrame:
    s = t("supplier")
    return s.select(
        F.col("s_suppkey").alias("doctor_id"),
        F.col("s_name").alias("name"),
        F.abs("s_acctbal").alias("consultation_fee"),
    )


def patients(t: Tables) -> DataFrame:
    c = t("customer")
    return c.select(F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("name"))


BOOKING_SQL = """n_ids AS (SELECT (6 * count(*) + 4) // 5 AS m FROM supplier),
bk AS (
  SELECT o_orderkey AS request_id, o_custkey AS patient_id,
         o_custkey % (SELECT m FROM n_ids) AS doctor_id,
         strftime(o_orderdate, '%Y-%m-%d') AS appointment_date,
         o_orderpriority AS time_slot, o_orderstatus
  FROM orders),
req AS (
  SELECT request_id, patient_id, doctor_id, appointment_date, time_slot
  FROM bk WHERE request_id % 10 <> 0),
held AS (
  SELECT request_id AS appointment_id, patient_id, doctor_id, appointment_date, time_slot,
         CASE WHEN o_orderstatus = 'P' THEN 'Cancelled' ELSE 'Confirmed' END AS status
  FROM bk WHERE request_id % 10 = 0),
doc AS (SELECT s_suppkey AS doctor_id, s_name AS name, abs(s_acctbal) AS consultation_fee FROM supplier),
pat AS (SELECT c_custkey AS patient_id, c_name AS name FROM customer)"""


# --------------------------------------------------------------------------
# FEAT: model input built from lineitem and part
# --------------------------------------------------------------------------

FEAT_NUMERIC = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]
FEAT_TEXT = ["l_returnflag", "l_linestatus", "p_type"]
FEAT_TARGET = "l_extendedprice"


def feat(t: Tables) -> DataFrame:
    """lineitem joined to part; the row key comes from ``surrogate_key``."""
    from quarry.operators.keys import surrogate_key

    l, p = t("lineitem"), t("part")
    base = l.join(p, l.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber", *FEAT_NUMERIC, *FEAT_TEXT, FEAT_TARGET
    )
    order = ["l_orderkey", "l_linenumber", *FEAT_NUMERIC, *FEAT_TEXT, FEAT_TARGET]
    return surrogate_key(base, order, key="row_id")


def fold_frame(t: Tables) -> DataFrame:
    """(model, fold, actual, predicted) rows made by expression from lineitem."""
    l = t("lineitem")
    return l.select(
        F.concat(F.lit("model_"), F.col("l_returnflag")).alias("model"),
        (F.col("l_orderkey") % 5).alias("fold"),
        F.col("l_extendedprice").alias("actual"),
        (F.col("l_quantity") * 1500.0 * (1 - F.col("l_discount"))).alias("predicted"),
    )


FOLD_SQL = """folds AS (
  SELECT 'model_' || l_returnflag AS model, l_orderkey % 5 AS fold,
         l_extendedprice AS actual, l_quantity * 1500.0 * (1 - l_discount) AS predicted
  FROM lineitem)"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
