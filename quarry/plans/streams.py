"""Registered streaming queries (T1 streaming form, T3).  The stream inputs
are the fixture rows written as files to a shared scratch folder; each job
runs with ``availableNow`` and its sink is read back as the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans import fixtures as fx
from quarry.plans.booking import ADMIT_SQL
from quarry.plans.registry import query
from quarry.plans.statistics import ALERT_THRESHOLD, ALERT_WIDTH, ALERTS_SQL
from quarry.session import scratch_path
from quarry.streaming import alerts as sa
from quarry.streaming import bookings as sb


@query("booking_stream", sql="WITH " + fx.BOOKING_SQL + ADMIT_SQL + "SELECT * FROM decided")
def booking_stream(spark, sf_dir):
    """Requests arriving as files in three deliveries, in request order, each
    admitted against the held appointments and earlier deliveries' admissions;
    the outcome is that of deciding all requests at once."""
    t = fx.Tables(spark, sf_dir)
    req = fx.requests(t)
    src = scratch_path(spark, "booking_requests")
    out, ckpt = scratch_path(spark, "booking_decisions"), scratch_path(spark, "booking_ckpt")
    first, second = req.select(F.percentile_approx("request_id", [1 / 3, 2 / 3])).first()[0] or (0, 0)
    k = F.col("request_id")
    for delivery in (k <= first, (k > first) & (k <= second), k > second):
        req.filter(delivery).write.mode("append").parquet(src)
        sb.start_booking_stream(spark, src, req.schema, fx.held(t), fx.doctors(t), fx.patients(t), out,
                                ckpt).awaitTermination()
    return sb.read_decisions(spark, out).drop("batch_id")


@query("latency_alerts_stream", sql="WITH " + ALERTS_SQL + "\nSELECT * FROM a")
def latency_alerts_stream(spark, sf_dir):
    """T1 streaming: hourly windows with a 1-hour watermark, append mode
    (a window is emitted once the watermark passes its end), and the windows
    still open when the input ends."""
    events = fx.Tables(spark, sf_dir)("events")
    src = scratch_path(spark, "alert_events")
    events.write.parquet(src)
    out, ckpt = scratch_path(spark, "alert_windows"), scratch_path(spark, "alert_ckpt")
    q = sa.start_alert_stream(spark, src, events.schema, out, ckpt, width=ALERT_WIDTH, threshold=ALERT_THRESHOLD,
                              watermark="1 hour")
    q.awaitTermination()
    windows = sa.closed_and_open_windows(spark, src, events.schema, out, width=ALERT_WIDTH, threshold=ALERT_THRESHOLD)
    # the stream's event time is TIMESTAMP; the table's column is given back its type
    ts = events.schema["ts"].dataType
    return windows.withColumns({"window_start": F.col("window_start").cast(ts), "window_end": F.col("window_end").cast(ts),
                                "avg_value": F.round("avg_value", 6)})
