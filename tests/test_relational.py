import pytest
from pyspark.sql import functions as F

from quarry.functions import scalar as fn
from quarry.operators import relational as rel
from quarry.spec import APPOINTMENTS


def _doctors(spark):
    return spark.createDataFrame([(11, "eyes", 75.5), (12, "teeth", 31.0), (13, "skin", None), (14, "teeth", 44.0)],
                                 "doctor_id long, specialty string, consultation_fee double")


@pytest.mark.parametrize("specialty,max_fee,expected", [
    ("eyes", None, [11]),
    (None, 50.0, [12, 14]),
    ("", 0, [11, 12, 13, 14]),          # '' and 0 both mean "no filter"
    (None, None, [11, 12, 13, 14]),
    ("teeth", 40.0, [12]),
])
def test_optional_filters_truthiness(spark, specialty, max_fee, expected):
    out = rel.optional_filters(_doctors(spark), equals={"specialty": specialty},
                               at_most={"consultation_fee": max_fee})
    assert sorted(r.doctor_id for r in out.collect()) == expected


def test_conflict_null_status_does_not_block(spark):
    req = spark.createDataFrame([(10, 1, "2026-06-25", "09:00 AM"), (11, 1, "2026-06-25", "10:00 AM"),
                                 (12, 1, "2026-06-25", "11:00 AM")],
                                "request_id long, doctor_id long, appointment_date string, time_slot string")
    held = spark.createDataFrame([(1, "2026-06-25", "09:00 AM", "Confirmed"), (1, "2026-06-25", "10:00 AM", None),
                                  (1, "2026-06-25", "11:00 AM", "Cancelled")],
                                 "doctor_id long, appointment_date string, time_slot string, status string")
    out = {r.request_id: r.n_conflicts for r in
           rel.conflict_counts(req, held, ["doctor_id", "appointment_date", "time_slot"]).collect()}
    assert out == {10: 1, 11: 0, 12: 0}


def test_apply_defaults_absent_vs_explicit_null(spark):
    absent = spark.createDataFrame([(1, 1, 1, "2026-06-25", "09:00 AM")],
                                   "appointment_id long, patient_id long, doctor_id long, appointment_date string, "
                                   "time_slot string")
    explicit = absent.withColumn("status", F.lit(None).cast("string"))
    assert rel.apply_defaults(absent, APPOINTMENTS.schema, APPOINTMENTS.defaults).first().status == "Pending"
    assert rel.apply_defaults(explicit, APPOINTMENTS.schema, APPOINTMENTS.defaults).first().status is None


def test_fk_orphans_ignores_null_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id long, parent_id long")
    parent = spark.createDataFrame([(10,)], "pid long")
    assert [r.id for r in rel.fk_orphans(child, parent, "parent_id", "pid").collect()] == [2]


def test_lowercase_clash_fails(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int").toDF("A", "a")
    with pytest.raises(ValueError):
        fn.lowercase_columns(df)


def test_strip_unicode_whitespace(spark):
    df = spark.createDataFrame([("\t a b  \n",)], "s string")
    assert df.select(fn.strip("s").alias("s")).first().s == "a b"


def test_scalar_formats(spark):
    df = spark.createDataFrame([(3.14159, 7, "HOUSEHOLD", "abc Alder", -2.7)],
                               "x double, n int, seg string, name string, neg double")
    r = df.select(fn.fixed("x", 2).alias("a"), fn.fixed("x", 3).alias("b"), fn.fixed("x", 2, width=7).alias("c"),
                  fn.zero_pad("n").alias("d"), fn.capitalize("seg").alias("e"),
                  fn.substring0("name", 4, 6).alias("f"), fn.cast_int("neg").alias("g"),
                  fn.ceil_int(F.lit(2.1)).alias("h")).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g, r.h) == ("3.14", "3.142", "   3.14", "07", "Household", "Al", -2, 3)


def test_parse_slot(spark):
    df = spark.createDataFrame([("2026-06-26", "02:00 PM")], "d string, s string")
    ts = df.select(fn.parse_slot("d", "s").alias("t")).first().t
    assert (ts.hour, ts.minute, ts.day) == (14, 0, 26)


def test_select_by_type(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "i int, s string, d double")
    assert rel.columns_of_type(df, "numeric") == ["i", "d"]
    assert rel.columns_of_type(df, "string") == ["s"]


def test_key_lookup_sql_binds_parameter(spark):
    df = _doctors(spark)
    assert [r.doctor_id for r in rel.key_lookup_sql(df, "specialty", "eyes").collect()] == [11]
    assert rel.key_lookup_sql(df, "specialty", "x' OR '1'='1").count() == 0   # a value, never SQL text


def test_read_csv_pandas_missing_tokens(spark):
    from quarry.session import scratch_path
    from quarry.sources import io

    path = scratch_path(spark, "test_csv_tokens")
    rows = [("1", "a", "1.5"), ("2", "NA", "null"), ("3", "", "N/A"), ("4", "None", "2.0")]
    spark.createDataFrame(rows, "id string, s string, x string").coalesce(1).write.option("header", True) \
        .option("sep", ";").csv(path)
    out = io.read_csv(spark, path, spark.createDataFrame([], "id int, s string, x double").schema, sep=";")
    got = {r.id: (r.s, r.x) for r in out.collect()}
    assert got == {1: ("a", 1.5), 2: (None, None), 3: (None, None), 4: (None, 2.0)}
