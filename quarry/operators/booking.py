"""Set-based admission of booking requests and their invoices.

The reference books one request at a time (check, then insert, inside one
connection).  Here a whole batch is decided in one job; "first valid request
wins" is data (the smallest request order per slot), not control flow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import case_label, money, substring0
from quarry.operators.keys import surrogate_key
from quarry.session import materialize

SLOT_KEYS = ("doctor_id", "appointment_date", "time_slot")

OUTCOME_CONFIRMED = "confirmed"
OUTCOME_SLOT_TAKEN = "slot_taken"
OUTCOME_UNKNOWN_DOCTOR = "unknown_doctor"
OUTCOME_UNKNOWN_PATIENT = "unknown_patient"


def admit_bookings(requests: DataFrame, held: DataFrame, doctors: DataFrame, patients: DataFrame,
                   slot_keys: Sequence[str] = SLOT_KEYS, order_by: Sequence[str] = ("request_id",),
                   status_col: str = "status", cancelled: str = "Cancelled") -> DataFrame:
    """Decide every request of a batch.

    Order of checks follows the reference: unknown doctor, slot held by a
    non-cancelled appointment (a NULL status does not hold it), unknown
    patient (the foreign key fails on insert; holds nothing), then among the
    remaining valid requests of a slot the first by ``order_by`` is confirmed
    and the rest find the slot taken.

    Every step is a left join on a key or a grouped aggregate:  partial
    aggregation absorbs a hot slot before the shuffle, and the per-slot
    winners join back on the slot key (AQE splits a skewed slot partition).
    """
    slot = list(slot_keys)
    doc_ok = doctors.select("doctor_id").distinct().withColumn("_doc_ok", F.lit(True))
    pat_ok = patients.select("patient_id").distinct().withColumn("_pat_ok", F.lit(True))
    taken = (
        held.filter(F.col(status_col) != F.lit(cancelled))
        .groupBy(*slot).agg(F.lit(True).alias("_held"))
    )
    r = (
        requests.join(doc_ok, "doctor_id", "left")
        .join(pat_ok, "patient_id", "left")
        .join(taken, slot, "left")
        .fillna(False, subset=["_doc_ok", "_pat_ok", "_held"])
    )
    # written once: both branches below read it, and requests that tie in every
    # order column keep their tie-break
    r = materialize(r.withColumn("_tie", F.monotonically_increasing_id()), "joined_requests")
    order = F.struct(*[F.col(c) for c in order_by], F.col("_tie"))
    valid = F.col("_doc_ok") & ~F.col("_held") & F.col("_pat_ok")
    winners = r.filter(valid).groupBy(*slot).agg(F.min(order).alias("_first"))
    decided = r.join(winners, slot, "left").withColumn(
        "outcome",
        F.when(~F.col("_doc_ok"), OUTCOME_UNKNOWN_DOCTOR)
        .when(F.col("_held"), OUTCOME_SLOT_TAKEN)
        .when(~F.col("_pat_ok"), OUTCOME_UNKNOWN_PATIENT)
        .when(order == F.col("_first"), OUTCOME_CONFIRMED)
        .otherwise(OUTCOME_SLOT_TAKEN),
    )
    return decided.select(*requests.columns, "outcome")


def confirmed_appointments(decided: DataFrame, id_col: str = "request_id") -> DataFrame:
    """Admitted requests as appointment rows (status 'Confirmed')."""
    return decided.filter(F.col("outcome") == OUTCOME_CONFIRMED).select(
        F.col(id_col).alias("appointment_id"), "patient_id", "doctor_id",
        "appointment_date", "time_slot", F.lit("Confirmed").alias("status"),
    )


def issue_invoices(appointments: DataFrame, doctors: DataFrame, start: int | Column = 1) -> DataFrame:
    """One Unpaid bill per admitted appointment, amount = the doctor's
    fee; consecutive ``billing_id`` in appointment order."""
    # one fee per doctor: a repeated doctor row must not bill twice
    fees = doctors.groupBy("doctor_id").agg(F.min("consultation_fee").alias("consultation_fee"))
    billed = appointments.join(fees, "doctor_id", "inner").select(
        "appointment_id",
        F.col("consultation_fee").cast("double").alias("amount_due"),
        F.lit("Unpaid").alias("payment_status"),
    )
    keyed = surrogate_key(billed, ["appointment_id"], key="billing_id", start=start)
    return keyed.select("billing_id", "appointment_id", "amount_due", "payment_status")


def booking_board(appointments: DataFrame, patients: DataFrame, doctors: DataFrame,
                  billing: DataFrame) -> DataFrame:
    """Labelled tracker rows (4-way inner join + labels)."""
    a, p, d, b = (appointments.alias("a"), patients.alias("p"), doctors.alias("d"), billing.alias("b"))
    j = (
        a.join(p, F.col("a.patient_id") == F.col("p.patient_id"))
        .join(d, F.col("a.doctor_id") == F.col("d.doctor_id"))
        .join(b, F.col("a.appointment_id") == F.col("b.appointment_id"))
    )
    return j.select(
        F.concat(F.lit("#"), F.col("a.appointment_id").cast("string")).alias("row_label"),
        F.col("p.name").alias("patient_name"),
        F.col("d.name").alias("doctor_name"),
        substring0(F.col("d.name"), 4, 6).alias("avatar"),
        F.col("a.appointment_date").alias("appointment_date"),
        F.col("a.time_slot").alias("time_slot"),
        F.col("a.status").alias("status"),
        case_label(F.col("a.status") == "Confirmed", "status-confirmed", "status-pending").alias("status_class"),
        money(F.col("b.amount_due")).alias("amount"),
        F.col("b.payment_status").alias("payment_status"),
        case_label(F.col("b.payment_status") == "Paid", "bill-paid", "bill-unpaid").alias("bill_class"),
    )


def doctor_cards(doctors: DataFrame) -> DataFrame:
    """The doctor catalogue rows behind the cards: avatar letters and fee text,
    with specialty and experience where the catalogue has them."""
    extra = [c for c in ("specialty", "experience") if c in doctors.columns]
    return doctors.select(
        "doctor_id", "name", *extra,
        substring0(F.col("name"), 4, 6).alias("avatar"),
        money(F.col("consultation_fee")).alias("fee_text"),
    )
