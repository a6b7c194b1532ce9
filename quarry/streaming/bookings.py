"""Booking admission per micro-batch (``foreachBatch``).

Each micro-batch of requests is decided by the batch operator
(``admit_bookings``) against the held appointments plus everything accepted
by earlier micro-batches.  Decisions go to ``out_dir/decisions/batch_id=N``
and confirmed bookings to ``out_dir/accepted/batch_id=N/appointment_month=M``,
both with overwrite, so a micro-batch replayed after a failure rewrites its
own folders (idempotent) and is never counted twice.  Earlier acceptances are
read with a semi-join on the slot keys of the current batch: the batch-id
filter prunes later batches and dynamic partition pruning on the month keeps
the read to the months in play (months, not days: few files per batch), so a long-running stream does not rescan its
whole history every micro-batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.booking import OUTCOME_CONFIRMED, SLOT_KEYS, admit_bookings


_ACCEPTED_SCHEMA = T.StructType([
    T.StructField("appointment_id", T.LongType()), T.StructField("patient_id", T.LongType()),
    T.StructField("doctor_id", T.LongType()), T.StructField("time_slot", T.StringType()),
    T.StructField("appointment_date", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("batch_id", T.LongType()), T.StructField("appointment_month", T.StringType()),
])


def _month(date_col: str = "appointment_date"):
    return F.substring(F.col(date_col), 1, 7)


def _accepted_before(spark: SparkSession, out_dir: str, batch_id: int, slots: DataFrame) -> DataFrame | None:
    try:
        # explicit schema: partition values stay text (no date inference)
        prev = spark.read.schema(_ACCEPTED_SCHEMA).parquet(f"{out_dir}/accepted")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None  # nothing accepted yet; any other failure ends the batch
    prev = prev.filter(F.col("batch_id") < batch_id)
    keys = [*SLOT_KEYS, "appointment_month"]
    return prev.join(slots.withColumn("appointment_month", _month()), keys, "left_semi").select(
        "appointment_id", "patient_id", "doctor_id", "appointment_date", "time_slot", "status")


def booking_batch_writer(held: DataFrame, doctors: DataFrame, patients: DataFrame, out_dir: str):
    """The ``foreachBatch`` function."""

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        slots = batch.select(*SLOT_KEYS).distinct()
        taken = held.join(slots, list(SLOT_KEYS), "left_semi").select(
            "appointment_id", "patient_id", "doctor_id", "appointment_date", "time_slot", "status")
        before = _accepted_before(spark, out_dir, batch_id, slots)
        if before is not None:
            taken = taken.unionByName(before)
        # decide once; the accepted table is derived from the written decisions
        path = f"{out_dir}/decisions/batch_id={batch_id}"
        known_doctors = doctors.join(batch.select("doctor_id").distinct(), "doctor_id", "left_semi")
        known_patients = patients.join(batch.select("patient_id").distinct(), "patient_id", "left_semi")
        admit_bookings(batch, taken, known_doctors, known_patients).write.mode("overwrite").parquet(path)
        decided = spark.read.parquet(path)
        (decided.filter(F.col("outcome") == OUTCOME_CONFIRMED)
         .select(F.col("request_id").alias("appointment_id"), "patient_id", "doctor_id", "time_slot",
                 "appointment_date", F.lit("Confirmed").alias("status"), _month().alias("appointment_month"))
         .write.mode("overwrite").partitionBy("appointment_month")
         .parquet(f"{out_dir}/accepted/batch_id={batch_id}"))

    return process


def start_booking_stream(spark: SparkSession, requests_dir: str, schema: T.StructType, held: DataFrame,
                         doctors: DataFrame, patients: DataFrame, out_dir: str, checkpoint_dir: str,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(requests_dir)
    return (stream.writeStream.foreachBatch(booking_batch_writer(held, doctors, patients, out_dir))
            .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())


def read_decisions(spark: SparkSession, out_dir: str) -> DataFrame:
    """All decided requests written by the stream (``batch_id`` included)."""
    return spark.read.parquet(f"{out_dir}/decisions")
