"""Registered queries: clinic bookings."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import booking as bk
from quarry.operators.relational import apply_defaults, conflict_counts
from quarry.plans import fixtures as fx
from quarry.plans.registry import query
from quarry.session import materialize
from quarry.spec import APPOINTMENTS, DOCTOR_SAMPLE_ROWS

ADMIT_SQL = """,
doc_ok AS (SELECT DISTINCT doctor_id FROM doc),
pat_ok AS (SELECT DISTINCT patient_id FROM pat),
taken AS (SELECT DISTINCT doctor_id, appointment_date, time_slot FROM held WHERE status <> 'Cancelled'),
r AS (
  SELECT q.*, d.doctor_id IS NOT NULL AS doc_ok, p.patient_id IS NOT NULL AS pat_ok,
         t.doctor_id IS NOT NULL AS is_held
  FROM req q
  LEFT JOIN doc_ok d ON q.doctor_id = d.doctor_id
  LEFT JOIN pat_ok p ON q.patient_id = p.patient_id
  LEFT JOIN taken t ON q.doctor_id = t.doctor_id AND q.appointment_date = t.appointment_date
                   AND q.time_slot = t.time_slot),
ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY doctor_id, appointment_date, time_slot, (doc_ok AND NOT is_held AND pat_ok)
           ORDER BY request_id) AS rn
  FROM r),
decided AS (
  SELECT request_id, patient_id, doctor_id, appointment_date, time_slot,
         CASE WHEN NOT doc_ok THEN 'unknown_doctor'
              WHEN is_held THEN 'slot_taken'
              WHEN NOT pat_ok THEN 'unknown_patient'
              WHEN rn = 1 THEN 'confirmed'
              ELSE 'slot_taken' END AS outcome
  FROM ranked),
appts AS (
  SELECT request_id AS appointment_id, patient_id, doctor_id, appointment_date, time_slot,
         'Confirmed' AS status
  FROM decided WHERE outcome = 'confirmed'),
bills AS (
  SELECT CAST(row_number() OVER (ORDER BY a.appointment_id) AS BIGINT) AS billing_id,
         a.appointment_id, d.consultation_fee AS amount_due, 'Unpaid' AS payment_status
  FROM appts a JOIN doc d ON a.doctor_id = d.doctor_id)
"""


def _decided(spark, sf_dir):
    t = fx.Tables(spark, sf_dir)
    return bk.admit_bookings(fx.requests(t), fx.held(t), fx.doctors(t), fx.patients(t)), t


@query("admit_bookings", sql="WITH " + fx.BOOKING_SQL + ADMIT_SQL + "SELECT * FROM decided")
def admit_bookings(spark, sf_dir):
    decided, _ = _decided(spark, sf_dir)
    return decided


@query("issue_invoices", sql="WITH " + fx.BOOKING_SQL + ADMIT_SQL + "SELECT * FROM bills")
def issue_invoices(spark, sf_dir):
    decided, t = _decided(spark, sf_dir)
    return bk.issue_invoices(bk.confirmed_appointments(decided), fx.doctors(t))


BOARD_SQL = "WITH " + fx.BOOKING_SQL + ADMIT_SQL + """
SELECT '#' || CAST(a.appointment_id AS VARCHAR) AS row_label,
       p.name AS patient_name, d.name AS doctor_name, substr(d.name, 5, 2) AS avatar,
       a.appointment_date, a.time_slot, a.status,
       CASE WHEN a.status = 'Confirmed' THEN 'status-confirmed' ELSE 'status-pending' END AS status_class,
       '$' || printf('%.2f', b.amount_due) AS amount,
       b.payment_status,
       CASE WHEN b.payment_status = 'Paid' THEN 'bill-paid' ELSE 'bill-unpaid' END AS bill_class
FROM appts a
JOIN pat p ON a.patient_id = p.patient_id
JOIN doc d ON a.doctor_id = d.doctor_id
JOIN bills b ON a.appointment_id = b.appointment_id
"""


def booking_board_frame(spark, sf_dir):
    decided, t = _decided(spark, sf_dir)
    # admitted once, reused by the invoices and the tracker join
    appts = materialize(bk.confirmed_appointments(decided), "admitted")
    bills = bk.issue_invoices(appts, fx.doctors(t))
    return bk.booking_board(appts, fx.patients(t), fx.doctors(t), bills)


query("booking_board", sql=BOARD_SQL)(booking_board_frame)


@query("doctor_cards", sql="WITH " + fx.BOOKING_SQL + """
SELECT doctor_id, name, substr(name, 5, 2) AS avatar, '$' || printf('%.2f', consultation_fee) AS fee_text FROM doc
""")
def doctor_cards(spark, sf_dir):
    """B5, second frame: one card per doctor."""
    return bk.doctor_cards(fx.doctors(fx.Tables(spark, sf_dir)))


@query("conflict_predicate", sql="WITH " + fx.BOOKING_SQL + """
SELECT q.request_id, q.doctor_id, q.appointment_date, q.time_slot,
       CAST(count(h.appointment_id) AS BIGINT) AS n_conflicts
FROM req q
LEFT JOIN held h ON h.doctor_id = q.doctor_id AND h.appointment_date = q.appointment_date
                AND h.time_slot = q.time_slot AND h.status <> 'Cancelled'
GROUP BY q.request_id, q.doctor_id, q.appointment_date, q.time_slot
""")
def conflict_predicate(spark, sf_dir):
    t = fx.Tables(spark, sf_dir)
    return conflict_counts(fx.requests(t), fx.held(t), list(bk.SLOT_KEYS))


@query("filtered_count", sql="WITH " + fx.BOOKING_SQL + """
SELECT doctor_id, appointment_date, time_slot,
       CAST(count(*) FILTER (WHERE status <> 'Cancelled') AS BIGINT) AS n_active
FROM held GROUP BY doctor_id, appointment_date, time_slot
""")
def filtered_count(spark, sf_dir):
    t = fx.Tables(spark, sf_dir)
    return fx.held(t).groupBy(*bk.SLOT_KEYS).agg(
        F.count_if(F.col("status") != "Cancelled").alias("n_active"))


@query("apply_defaults", sql="WITH " + fx.BOOKING_SQL + """
SELECT request_id AS appointment_id, patient_id, doctor_id, appointment_date, time_slot,
       'Pending' AS status
FROM req
""")
def apply_defaults_q(spark, sf_dir):
    t = fx.Tables(spark, sf_dir)
    rows = fx.requests(t).withColumnRenamed("request_id", "appointment_id")
    return apply_defaults(rows, APPOINTMENTS.schema, APPOINTMENTS.defaults)


@query("inline_rows", sql="""
WITH sample(row_no, specialty, experience_years, list_fee) AS (VALUES """ + ", ".join(
    f"({i + 1}, '{r[0]}', {r[1]}, CAST({r[2]} AS DOUBLE))" for i, r in enumerate(DOCTOR_SAMPLE_ROWS)) + """)
SELECT s_suppkey AS doctor_id, s_name AS name, specialty, experience_years, list_fee
FROM supplier JOIN sample ON s_suppkey % 5 + 1 = row_no
""")
def inline_rows(spark, sf_dir):
    """The reference's literal doctor rows as a source, used as a fixed
    five-row dimension over the suppliers (a proven broadcast bound)."""
    t = fx.Tables(spark, sf_dir)
    rows = [(i + 1, *r) for i, r in enumerate(DOCTOR_SAMPLE_ROWS)]
    sample = spark.createDataFrame(rows, T.StructType([
        T.StructField("row_no", T.LongType()),
        T.StructField("specialty", T.StringType()),
        T.StructField("experience_years", T.IntegerType()),
        T.StructField("list_fee", T.DoubleType()),
    ]))
    s = t("supplier")
    return s.join(F.broadcast(sample), (s.s_suppkey % 5 + 1) == sample.row_no).select(
        F.col("s_suppkey").alias("doctor_id"), F.col("s_name").alias("name"),
        "specialty", "experience_years", "list_fee")
