"""Admission, billing and data-quality rules on small tables."""

from pyspark.sql import functions as F

from quarry.operators import booking as bk
from quarry.operators import quality as qa
from quarry.session import scratch_path
from quarry.sources import io
from quarry.spec import BILLING, CLINIC_TABLES

REQ_SCHEMA = "request_id long, patient_id long, doctor_id long, appointment_date string, time_slot string"
HELD_SCHEMA = ("appointment_id long, patient_id long, doctor_id long, appointment_date string, time_slot string, "
               "status string")
DAY, OTHER_DAY = "2031-11-03", "2031-11-04"
EARLY, LATE = "07:45 AM", "04:15 PM"


def _clinic(spark):
    doctors = spark.createDataFrame([(21, "d21", 64.5), (22, "d22", 37.25)],
                                    "doctor_id long, name string, consultation_fee double")
    patients = spark.createDataFrame([(501, "p501"), (502, "p502")], "patient_id long, name string")
    held = spark.createDataFrame([(900, 502, 21, OTHER_DAY, EARLY, "Cancelled"), (901, 502, 22, OTHER_DAY, EARLY, None)],
                                 HELD_SCHEMA)
    return doctors, patients, held


def _outcomes(spark, requests):
    doctors, patients, held = _clinic(spark)
    out = bk.admit_bookings(spark.createDataFrame(requests, REQ_SCHEMA), held, doctors, patients)
    return {r.request_id: r.outcome for r in out.collect()}


def test_outcome_per_kind_of_request(spark):
    assert _outcomes(spark, [
        (31, 501, 21, DAY, LATE),         # free slot
        (32, 502, 21, DAY, LATE),         # same slot, later request
        (33, 501, 77, DAY, LATE),         # no such doctor
        (34, 501, 21, OTHER_DAY, EARLY),  # slot held only by a cancelled row
        (35, 501, 22, OTHER_DAY, EARLY),  # held with NULL status: does not block
    ]) == {31: "confirmed", 32: "slot_taken", 33: "unknown_doctor", 34: "confirmed", 35: "confirmed"}


def test_rejected_request_holds_nothing(spark):
    assert _outcomes(spark, [(41, 666, 21, DAY, EARLY), (42, 501, 21, DAY, EARLY)]) == {
        41: "unknown_patient", 42: "confirmed"}


def test_invoice_charges_the_doctors_fee(spark):
    doctors, patients, held = _clinic(spark)
    req = spark.createDataFrame([(58, 502, 22, DAY, LATE)], REQ_SCHEMA)
    appts = bk.confirmed_appointments(bk.admit_bookings(req, held, doctors, patients))
    assert appts.first().status == "Confirmed"
    bill = bk.issue_invoices(appts, doctors).first()
    assert (bill.billing_id, bill.appointment_id, bill.amount_due, bill.payment_status) == (1, 58, 37.25, "Unpaid")


def test_each_slot_confirmed_at_most_once(spark):
    doctors, patients, held = _clinic(spark)
    rows = [(i, 501 + i % 2, 21 + i % 2, DAY, [EARLY, LATE, "12:05 PM"][i % 3]) for i in range(60)]
    out = bk.admit_bookings(spark.createDataFrame(rows, REQ_SCHEMA), held, doctors, patients)
    per_slot = out.filter(F.col("outcome") == "confirmed").groupBy(*bk.SLOT_KEYS).count()
    assert per_slot.count() == 6 and per_slot.filter("count > 1").count() == 0


def test_amount_below_minimum_is_a_violation(spark):
    bills = spark.createDataFrame([(71, 1, -0.01, "Unpaid"), (72, 2, 0.0, None)],
                                  "billing_id long, appointment_id long, amount_due double, payment_status string")
    v = qa.check_spec(bills, BILLING).collect()
    assert [(r.rule, r.column_name, r.row_key) for r in v] == [("min", "amount_due", "71")]


def test_null_passes_range_but_not_not_null(spark):
    df = spark.createDataFrame([(1, None), (2, 40)], "id long, weight int")
    assert qa.check_range(df, "t", {"weight": (3, 33)}, ["id"]).select("row_key").collect()[0].row_key == "2"
    assert qa.check_not_null(df, "t", ["weight"], ["id"]).first().row_key == "1"


def test_unique_and_primary_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None), (3, None)], "k long, e string")
    assert qa.check_unique(df, "t", ["e"]).count() == 0            # NULLs are exempt
    pk = {(r.rule, r.bad_value) for r in qa.check_primary_key(df, "t", ["k"]).collect()}
    assert pk == {("pk_unique", "1"), ("pk_not_null", None)}


def test_ddl_lists_every_table_and_fills_defaults(spark):
    db = "quarry_ddl_test"
    io.create_tables(spark, CLINIC_TABLES, db, scratch_path(spark, "ddl"))
    names = [s.name for s in CLINIC_TABLES]
    listed = {r.table_name: r.present for r in io.list_tables(spark, db, [*names, "no_such"]).collect()}
    assert listed == dict.fromkeys(names, True) | {"no_such": False}
    spark.sql(f"INSERT INTO {db}.appointments (appointment_id, patient_id, doctor_id, appointment_date, time_slot) "
              f"VALUES (81, 501, 21, '{DAY}', '{EARLY}')")
    assert spark.table(f"{db}.appointments").first().status == "Pending"   # DEFAULT applied


def test_tied_requests_and_repeated_doctors(spark):
    """One id twice on one slot confirms once; a repeated doctor row bills once."""
    doctors = spark.createDataFrame([(1, "Dr. A", 80.0), (1, "Dr. A", 80.0)],
                                    "doctor_id long, name string, consultation_fee double")
    patients = spark.createDataFrame([(1, "P"), (2, "Q")], "patient_id long, name string")
    held = spark.createDataFrame([], "appointment_id long, patient_id long, doctor_id long, "
                                     "appointment_date string, time_slot string, status string")
    req = spark.createDataFrame([(5, 1, 1, "2027-02-03", "08:00 AM"), (5, 2, 1, "2027-02-03", "08:00 AM"),
                                 (5, 1, 1, "2027-02-03", "08:00 AM")], REQ_SCHEMA)
    out = bk.admit_bookings(req, held, doctors, patients)
    appts = bk.confirmed_appointments(out)
    assert appts.count() == 1
    assert bk.issue_invoices(appts, doctors).count() == 1
