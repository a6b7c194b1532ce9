"""Registered queries: checks, keys, cleaning and normalising."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators import clean as cl
from quarry.operators import quality as qa
from quarry.operators.keys import surrogate_key
from quarry.plans import fixtures as fx
from quarry.plans.registry import query
from quarry.session import materialize, scratch_path


def _t(spark, sf_dir):
    return fx.Tables(spark, sf_dir)


def _viol_sql(table: str, rule: str, key: str, col: str, value: str, where: str, src: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, {key} AS row_key, '{col}' AS column_name, "
            f"{value} AS bad_value, CAST(1 AS BIGINT) AS n FROM {src} WHERE {where}")


@query("check_not_null", sql="WITH " + fx.DIRTY_SQL + "\n" + " UNION ALL ".join(
    _viol_sql("events", "not_null", "CAST(EVENT_ID AS VARCHAR)", c, "CAST(NULL AS VARCHAR)", f"{c} IS NULL", "dirty")
    for c in ["EVENT_ID", "TS", "USER_ID", "EVENT_TYPE", "VALUE", "PROPS"]))
def check_not_null(spark, sf_dir):
    """Required columns of the dirty events."""
    d = fx.dirty(_t(spark, sf_dir))
    return qa.check_not_null(d, "events", d.columns, ["EVENT_ID"])


@query("check_range", sql=_viol_sql(
    "lineitem", "range", "CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)", "l_discount",
    "CAST(l_discount AS VARCHAR)", "NOT (l_discount BETWEEN 0 AND 0.09)", "lineitem"))
def check_range(spark, sf_dir):
    """l_discount outside 0..0.09."""
    return qa.check_range(_t(spark, sf_dir)("lineitem"), "lineitem", {"l_discount": (0, 0.09)},
                          ["l_orderkey", "l_linenumber"])


@query("check_min", sql=_viol_sql("customer", "min", "CAST(c_custkey AS VARCHAR)", "c_acctbal",
                                  "CAST(c_acctbal AS VARCHAR)", "c_acctbal < 0", "customer"))
def check_min(spark, sf_dir):
    """c_acctbal >= 0."""
    return qa.check_min(_t(spark, sf_dir)("customer"), "customer", {"c_acctbal": 0}, ["c_custkey"])


@query("check_unique", sql="""
SELECT 'part' AS table_name, 'unique' AS rule, CAST(NULL AS VARCHAR) AS row_key, 'p_name' AS column_name,
       p_name AS bad_value, count(*) AS n
FROM part WHERE p_name IS NOT NULL GROUP BY p_name HAVING count(*) > 1""")
def check_unique(spark, sf_dir):
    """C4: p_name must not repeat."""
    return qa.check_unique(_t(spark, sf_dir)("part"), "part", ["p_name"])


@query("check_primary_key", sql="""
SELECT 'lineitem' AS table_name, 'pk_unique' AS rule, CAST(NULL AS VARCHAR) AS row_key,
       'l_orderkey,l_linenumber' AS column_name,
       CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS bad_value, count(*) AS n
FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'lineitem', 'pk_not_null', CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR),
       'l_orderkey', NULL, 1 FROM lineitem WHERE l_orderkey IS NULL
UNION ALL
SELECT 'lineitem', 'pk_not_null', CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR),
       'l_linenumber', NULL, 1 FROM lineitem WHERE l_linenumber IS NULL""")
def check_primary_key(spark, sf_dir):
    """(l_orderkey, l_linenumber) as a primary key."""
    return qa.check_primary_key(_t(spark, sf_dir)("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])


_WIDE_ORDER = ", ".join(fx.WIDE_COLS)
_KEYED_SQL = "WITH " + fx.WIDE_SQL + f""",
keyed AS (SELECT *, CAST(row_number() OVER (ORDER BY {_WIDE_ORDER}) AS BIGINT) AS row_id FROM wide)
"""


@query("surrogate_key", sql=_KEYED_SQL + "SELECT * FROM keyed")
def surrogate_key_q(spark, sf_dir):
    """Consecutive ids from 1 in the order of all wide columns."""
    return surrogate_key(fx.wide(_t(spark, sf_dir)), fx.WIDE_COLS, key="row_id")


def _parts(spark, sf_dir):
    return cl.normalize_tables(fx.wide(_t(spark, sf_dir)), fx.WIDE_PARTS, fx.WIDE_COLS, key="row_id")


@query("normalize_tables", sql=_KEYED_SQL + " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, min(row_id) AS min_key, max(row_id) AS max_key, "
    f"count(DISTINCT row_id) AS n_keys FROM keyed" for name in fx.WIDE_PARTS))
def normalize_tables(spark, sf_dir):
    """B2: the wide row split into four tables sharing one generated key,
    stored bucketed by that key; counts read back from the stored tables."""
    db = f"quarry_{uuid.uuid4().hex[:12]}"
    stored = cl.store_bucketed(_parts(spark, sf_dir), db, scratch_path(spark, "normalized"), key="row_id")
    out = None
    for name, df in stored.items():
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), F.min("row_id").alias("min_key"),
                     F.max("row_id").alias("max_key"), F.count_distinct("row_id").alias("n_keys"))
        row = row.select(F.lit(name).alias("table_name"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@query("reassemble_wide", sql=_KEYED_SQL + "SELECT * FROM keyed")
def reassemble_wide(spark, sf_dir):
    """The four parts, stored bucketed by the key, joined back equal the
    keyed wide rows."""
    db = f"quarry_{uuid.uuid4().hex[:12]}"
    stored = cl.store_bucketed(_parts(spark, sf_dir), db, scratch_path(spark, "normalized"), key="row_id")
    return cl.reassemble(stored, key="row_id")


@query("reconcile_counts", sql="WITH " + fx.WIDE_SQL + "\n" + " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, (SELECT count(*) FROM wide) AS source_rows, "
    f"true AS matches FROM wide" for name in fx.WIDE_PARTS))
def reconcile_counts(spark, sf_dir):
    """Every normalised table, as stored and read back, holds as many rows as the source."""
    wide = fx.wide(_t(spark, sf_dir))
    parts = cl.normalize_tables(wide, fx.WIDE_PARTS, fx.WIDE_COLS, key="row_id")
    stored = {name: materialize(part, f"reconcile_{name}") for name, part in parts.items()}
    return qa.reconcile_counts(stored, wide)


_CLEAN_SQL = "WITH " + fx.DIRTY_SQL + """,
d AS (SELECT DISTINCT * FROM dirty),
m AS (SELECT EVENT_TYPE AS v FROM d WHERE EVENT_TYPE IS NOT NULL
      GROUP BY EVENT_TYPE ORDER BY count(*) DESC, EVENT_TYPE LIMIT 1),
mp AS (SELECT PROPS AS v FROM d WHERE PROPS IS NOT NULL GROUP BY PROPS ORDER BY count(*) DESC, PROPS LIMIT 1),
clean AS (
  SELECT coalesce(EVENT_ID, (SELECT CAST(median(EVENT_ID) AS BIGINT) FROM d)) AS event_id,
         TS AS ts,
         coalesce(USER_ID, (SELECT CAST(median(USER_ID) AS BIGINT) FROM d)) AS user_id,
         regexp_replace(coalesce(EVENT_TYPE, (SELECT v FROM m)), '^\\s+|\\s+$', '', 'g') AS event_type,
         coalesce(VALUE, (SELECT median(VALUE) FROM d)) AS value,
         regexp_replace(coalesce(PROPS, (SELECT v FROM mp)), '^\\s+|\\s+$', '', 'g') AS props
  FROM d)
"""


@query("clean_table", sql=_CLEAN_SQL + "SELECT * FROM clean")
def clean_table(spark, sf_dir):
    """B1: lower names -> dedupe -> impute (mode / median) -> strip."""
    return cl.clean_table(fx.dirty(_t(spark, sf_dir)))


@query("validate_clean", sql=_CLEAN_SQL + """,
g AS (SELECT count(*) AS n FROM clean GROUP BY ALL)
SELECT (SELECT count(*) FROM clean) AS n_rows, 6 AS n_cols,
       (SELECT count(*) FILTER (WHERE event_id IS NULL) + count(*) FILTER (WHERE ts IS NULL)
             + count(*) FILTER (WHERE user_id IS NULL) + count(*) FILTER (WHERE event_type IS NULL)
             + count(*) FILTER (WHERE value IS NULL OR isnan(value)) + count(*) FILTER (WHERE props IS NULL)
        FROM clean) AS nulls_left,
       (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM clean
            GROUP BY event_id, ts, user_id, event_type, value, props)) AS duplicates_left""")
def validate_clean(spark, sf_dir):
    """What the cleaned table still holds of nulls and duplicates."""
    return cl.validate_clean(cl.clean_table(fx.dirty(_t(spark, sf_dir))))
