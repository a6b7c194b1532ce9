"""Registered queries: projections, filters, scalar functions, joins, sorts
(P1-P13 except P7/P11, F1-F12, J1-J4, O1-O5, D1-D2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import scalar as fn
from quarry.operators import relational as rel
from quarry.operators.clean import impute
from quarry.operators.profile import distinct_rows
from quarry.plans import fixtures as fx
from quarry.plans.registry import query


def _t(spark, sf_dir):
    return fx.Tables(spark, sf_dir)


def _smallest_custkey(o):
    """The lookup parameter: the smallest customer key that has orders, as a
    scalar subquery (evaluated once, then pushed as a literal filter)."""
    return o.select(F.min("o_custkey")).scalar()


# ------------------------------------------------------------ P family ----

MIXED_CASE = {"o_orderkey": "O_OrderKey", "o_custkey": "O_CustKey", "o_orderstatus": "O_OrderStatus",
              "o_totalprice": "O_TotalPrice", "o_orderdate": "O_OrderDate", "o_orderpriority": "O_OrderPriority"}


@query("lowercase_columns", sql="SELECT * FROM orders")
def lowercase_columns(spark, sf_dir):
    """Mixed-case names lower-cased (fails on a clash)."""
    o = _t(spark, sf_dir)("orders")
    mixed = o.toDF(*[MIXED_CASE.get(c, c) for c in o.columns])
    return fn.lowercase_columns(mixed)


@query("project_columns", sql="""
SELECT o_orderkey, c_name AS customer_name, o_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey""")
def project_columns(spark, sf_dir):
    """Keep, drop and alias through a join."""
    t = _t(spark, sf_dir)
    o, c = t("orders"), t("customer")
    j = o.join(c, o.o_custkey == c.c_custkey).drop("o_orderdate", "c_acctbal")
    return j.select("o_orderkey", F.col("c_name").alias("customer_name"), "o_totalprice")


@query("select_by_type", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
FROM lineitem""")
def select_by_type(spark, sf_dir):
    """Numeric columns chosen from the schema."""
    return rel.select_by_type(_t(spark, sf_dir)("lineitem"), "numeric")


@query("filter_compare", sql="SELECT l_extendedprice FROM lineitem WHERE l_quantity >= 30")
def filter_compare(spark, sf_dir):
    """One predicate, one projected column."""
    return rel.filter_project(_t(spark, sf_dir)("lineitem"), F.col("l_quantity") >= 30, "l_extendedprice")


def _opt(spec_type, max_fee):
    def run(spark, sf_dir):
        part = _t(spark, sf_dir)("part")
        return rel.optional_filters(part, equals={"p_type": spec_type}, at_most={"p_retailprice": max_fee})
    return run


query("optional_filters", sql="SELECT * FROM part WHERE p_type = 'ECONOMY' AND p_retailprice <= 950")(
    _opt("ECONOMY", 950))
query("optional_filters_type_only", sql="SELECT * FROM part WHERE p_type = 'ECONOMY'")(_opt("ECONOMY", None))
query("optional_filters_fee_only", sql="SELECT * FROM part WHERE p_retailprice <= 950")(_opt("", 950))
query("optional_filters_none", sql="SELECT * FROM part")(_opt(None, 0))


@query("key_lookup", sql="""
SELECT * FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders)""")
def key_lookup(spark, sf_dir):
    """Rows of one key (a bound parameter)."""
    o = _t(spark, sf_dir)("orders")
    return rel.key_lookup(o, "o_custkey", _smallest_custkey(o)).orderBy("o_orderkey")


@query("fill_nulls", sql="WITH " + fx.DIRTY_SQL + """,
m AS (SELECT EVENT_TYPE AS v FROM dirty WHERE EVENT_TYPE IS NOT NULL
      GROUP BY EVENT_TYPE ORDER BY count(*) DESC, EVENT_TYPE LIMIT 1)
SELECT EVENT_ID, coalesce(EVENT_TYPE, (SELECT v FROM m)) AS EVENT_TYPE,
       coalesce(VALUE, (SELECT median(VALUE) FROM dirty)) AS VALUE
FROM dirty""")
def fill_nulls(spark, sf_dir):
    """Text -> mode, numeric -> median, constants from one aggregate."""
    d = fx.dirty(_t(spark, sf_dir)).select("EVENT_ID", "EVENT_TYPE", "VALUE")
    return impute(d)


@query("case_label", sql="""
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN 'status-confirmed' ELSE 'status-pending' END AS status_class
FROM orders""")
def case_label(spark, sf_dir):
    """P9."""
    o = _t(spark, sf_dir)("orders")
    return o.select("o_orderkey", fn.case_label(F.col("o_orderstatus") == "F", "status-confirmed",
                                                "status-pending").alias("status_class"))


@query("override_column", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, '1-URGENT' AS o_orderpriority
FROM orders""")
def override_column(spark, sf_dir):
    """P10: scenario copy with one column set to a constant, over all rows."""
    return rel.override_column(_t(spark, sf_dir)("orders"), "o_orderpriority", "1-URGENT")


@query("xy_projection", sql="SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem")
def xy_projection(spark, sf_dir):
    """The two columns behind a scatter plot (no display cap)."""
    l = _t(spark, sf_dir)("lineitem")
    return l.select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))


@query("linear_expression", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem""")
def linear_expression(spark, sf_dir):
    """P13."""
    l = _t(spark, sf_dir)("lineitem")
    return l.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount")))
                    .alias("revenue"))


# ------------------------------------------------------------ F family ----

@query("fn_lower", sql="SELECT c_custkey, lower(c_name) AS name_lower FROM customer")
def fn_lower(spark, sf_dir):
    c = _t(spark, sf_dir)("customer")
    return c.select("c_custkey", fn.lower("c_name").alias("name_lower"))


@query("fn_strip", sql="WITH " + fx.DIRTY_SQL + """
SELECT EVENT_ID, regexp_replace(EVENT_TYPE, '^\\s+|\\s+$', '', 'g') AS event_type_clean FROM dirty""")
def fn_strip(spark, sf_dir):
    d = fx.dirty(_t(spark, sf_dir))
    return d.select("EVENT_ID", fn.strip("EVENT_TYPE").alias("event_type_clean"))


@query("fn_cast_int", sql="""
SELECT c_custkey, CAST(trunc(c_acctbal) AS INTEGER) AS acctbal_int,
       CAST(trunc(-c_acctbal / 3) AS INTEGER) AS third_int
FROM customer""")
def fn_cast_int(spark, sf_dir):
    """truncation toward zero, for negative values too."""
    c = _t(spark, sf_dir)("customer")
    return c.select("c_custkey", fn.cast_int("c_acctbal").alias("acctbal_int"),
                    fn.cast_int(-F.col("c_acctbal") / 3).alias("third_int"))


@query("fn_substring", sql="SELECT c_custkey, substr(c_name, 5, 2) AS avatar FROM customer")
def fn_substring(spark, sf_dir):
    """``name[4:6]``."""
    c = _t(spark, sf_dir)("customer")
    return c.select("c_custkey", fn.substring0("c_name", 4, 6).alias("avatar"))


@query("fn_concat_format", sql="""
SELECT '#' || CAST(o_orderkey AS VARCHAR) AS row_label,
       printf('%s | %s', o_orderpriority, o_orderstatus) AS summary
FROM orders""")
def fn_concat_format(spark, sf_dir):
    o = _t(spark, sf_dir)("orders")
    return o.select(F.concat(F.lit("#"), F.col("o_orderkey").cast("string")).alias("row_label"),
                    F.format_string("%s | %s", "o_orderpriority", "o_orderstatus").alias("summary"))


@query("fn_fixed_decimals", sql="""
SELECT c_custkey, printf('%.2f', c_acctbal) AS f2, printf('%.3f', c_acctbal) AS f3,
       printf('%7.2f', c_acctbal) AS w7, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS nation2
FROM customer""")
def fn_fixed_decimals(spark, sf_dir):
    c = _t(spark, sf_dir)("customer")
    return c.select("c_custkey", fn.fixed("c_acctbal", 2).alias("f2"), fn.fixed("c_acctbal", 3).alias("f3"),
                    fn.fixed("c_acctbal", 2, width=7).alias("w7"), fn.zero_pad("c_nationkey", 2).alias("nation2"))


@query("fn_round", sql="SELECT event_id, round(sqrt(value), 2) AS root_r2 FROM events")
def fn_round(spark, sf_dir):
    """half-even rounding to 2 digits (values chosen without exact ties)."""
    e = _t(spark, sf_dir)("events")
    return e.select("event_id", fn.round_half_even(F.sqrt("value"), 2).alias("root_r2"))


@query("fn_ceil", sql="""
SELECT l_orderkey, l_linenumber, CAST(ceil(l_extendedprice / 1000) AS BIGINT) AS thousands
FROM lineitem""")
def fn_ceil(spark, sf_dir):
    l = _t(spark, sf_dir)("lineitem")
    return l.select("l_orderkey", "l_linenumber", fn.ceil_int(F.col("l_extendedprice") / 1000).alias("thousands"))


@query("fn_capitalize", sql="""
SELECT c_custkey, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS segment
FROM customer""")
def fn_capitalize(spark, sf_dir):
    c = _t(spark, sf_dir)("customer")
    return c.select("c_custkey", fn.capitalize("c_mktsegment").alias("segment"))


@query("fn_between", sql="""
SELECT l_orderkey, l_linenumber, l_discount BETWEEN 0.02 AND 0.06 AS in_range FROM lineitem""")
def fn_between(spark, sf_dir):
    l = _t(spark, sf_dir)("lineitem")
    return l.select("l_orderkey", "l_linenumber", fn.between("l_discount", 0.02, 0.06).alias("in_range"))


@query("fn_negate", sql="SELECT c_custkey, -c_acctbal AS neg_acctbal FROM customer")
def fn_negate(spark, sf_dir):
    c = _t(spark, sf_dir)("customer")
    return c.select("c_custkey", fn.negate("c_acctbal").alias("neg_acctbal"))


_SLOT_SQL_TEXT = """lpad(CAST(o_orderkey % 12 + 1 AS VARCHAR), 2, '0') || ':' ||
       lpad(CAST((o_orderkey % 4) * 15 AS VARCHAR), 2, '0') || CASE WHEN o_orderkey % 2 = 0 THEN ' AM' ELSE ' PM' END"""


@query("fn_parse_slot", sql=f"""
WITH s AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS visit_date,
                  {_SLOT_SQL_TEXT} AS slot_text FROM orders)
SELECT o_orderkey, visit_date, slot_text,
       strptime(visit_date || ' ' || slot_text, '%Y-%m-%d %I:%M %p') AS slot_ts
FROM s""")
def fn_parse_slot(spark, sf_dir):
    """text date + text slot -> typed timestamp."""
    o = _t(spark, sf_dir)("orders")
    k = F.col("o_orderkey")
    slot = F.concat(fn.zero_pad(k % 12 + 1, 2), F.lit(":"), fn.zero_pad((k % 4) * 15, 2),
                    F.when(k % 2 == 0, F.lit(" AM")).otherwise(F.lit(" PM")))
    s = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("visit_date"),
                 slot.alias("slot_text"))
    return s.withColumn("slot_ts", fn.parse_slot("visit_date", "slot_text"))


# ------------------------------------------------------------ J family ----

@query("join_lookup", sql="""
SELECT o_orderkey, c_name, o_orderdate, o_orderpriority, o_orderstatus
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_custkey = (SELECT min(o_custkey) FROM orders)""")
def join_lookup(spark, sf_dir):
    """Inner join filtered on the fact's key; Catalyst pushes the filter
    into the orders scan and the customer side shrinks to one key."""
    t = _t(spark, sf_dir)
    o, c = t("orders"), t("customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return rel.key_lookup(j, "o_custkey", _smallest_custkey(o)).select(
        "o_orderkey", "c_name", "o_orderdate", "o_orderpriority", "o_orderstatus")


@query("join_billing", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderstatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_custkey = (SELECT min(o_custkey) FROM orders)""")
def join_billing(spark, sf_dir):
    """Child joined to parent, filtered on the parent's column."""
    t = _t(spark, sf_dir)
    l, o = t("lineitem"), t("orders")
    j = l.join(o, l.l_orderkey == o.o_orderkey)
    return rel.key_lookup(j, "o_custkey", _smallest_custkey(o)).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "o_orderstatus")


JOIN4_SQL = """
SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderdate, c_name, n_name
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey"""


@query("join_four_way", sql=JOIN4_SQL)
def join_four_way(spark, sf_dir):
    """Unfiltered star join.  Orders are enriched with their customer and
    nation first, so the lineitem-sized side is shuffled once (on the order
    key) even when customer is too large to broadcast; no hints -- AQE
    broadcasts whichever sides are small at runtime."""
    t = _t(spark, sf_dir)
    l, o, c, n = t("lineitem"), t("orders"), t("customer"), t("nation")
    enriched = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select(
        "o_orderkey", "o_orderdate", "c_name", "n_name")
    return l.join(enriched, l.l_orderkey == enriched.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "o_orderdate", "c_name", "n_name")


@query("fk_orphans", sql="""
SELECT * FROM orders
WHERE o_custkey IS NOT NULL
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def fk_orphans(spark, sf_dir):
    """Orders checked against the customers outside segment BUILDING."""
    t = _t(spark, sf_dir)
    parent = t("customer").filter(F.col("c_mktsegment") != "BUILDING")
    return rel.fk_orphans(t("orders"), parent, "o_custkey", "c_custkey")


# ------------------------------------------------------------ O family ----

@query("head_n", sql="SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def head_n(spark, sf_dir):
    """O1: an order must be named; ``TakeOrderedAndProject`` keeps 5 per task."""
    return _t(spark, sf_dir)("orders").orderBy("o_orderkey").limit(5)


@query("top_k_desc", sql="""
SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10""")
def top_k_desc(spark, sf_dir):
    """O2: the k largest, tie broken by key."""
    p = _t(spark, sf_dir)("part")
    return p.select("p_partkey", "p_name", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(10)


@query("below_threshold", sql="""
SELECT p_partkey, p_name, p_retailprice,
       (SELECT count(*) FROM part WHERE p_retailprice < 910) AS n_below
FROM part WHERE p_retailprice < 910 ORDER BY p_retailprice, p_partkey LIMIT 10""")
def below_threshold(spark, sf_dir):
    """O3: how many fall under the threshold, and the first 10 of them."""
    p = _t(spark, sf_dir)("part")
    below = p.filter(F.col("p_retailprice") < 910)
    n = below.select(F.count(F.lit(1))).scalar()
    return (below.select("p_partkey", "p_name", "p_retailprice").orderBy("p_retailprice", "p_partkey").limit(10)
            .withColumn("n_below", n))


@query("row_by_key", sql="SELECT * FROM orders WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders)")
def row_by_key(spark, sf_dir):
    """Rows have no position; pick by key."""
    o = _t(spark, sf_dir)("orders")
    return rel.key_lookup(o, "o_orderkey", o.select(F.min("o_orderkey")).scalar())


@query("first_match", sql="""
SELECT c_custkey, f.first_orderkey, f.first_orderkey IS NOT NULL AS has_order
FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS first_orderkey FROM orders GROUP BY o_custkey) f
  ON c_custkey = f.o_custkey""")
def first_match(spark, sf_dir):
    """O5 for every key at once: the first order of each customer or none."""
    t = _t(spark, sf_dir)
    first = t("orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_orderkey"))
    c = t("customer")
    return c.join(first, c.c_custkey == first.o_custkey, "left").select(
        "c_custkey", "first_orderkey", F.col("first_orderkey").isNotNull().alias("has_order"))


# ------------------------------------------------------------ D family ----

@query("distinct_rows", sql="WITH " + fx.DIRTY_SQL + "\nSELECT DISTINCT * FROM dirty")
def distinct_rows_q(spark, sf_dir):
    """D1."""
    return distinct_rows(fx.dirty(_t(spark, sf_dir)))


@query("metric_union", sql=" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, {ncols} AS n_cols FROM {name}"
    for name, ncols in [("region", 2), ("nation", 3), ("customer", 5), ("supplier", 4), ("part", 6),
                        ("orders", 6), ("lineitem", 11), ("events", 6)]))
def metric_union(spark, sf_dir):
    """One result row per table, stacked with ``unionByName``."""
    t = _t(spark, sf_dir)
    out = None
    for name in fx.TPCH_TABLES:
        df = t(name)
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))
        out = row if out is None else out.unionByName(row)
    return out
