"""Trend fit and threshold forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trend_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least squares ``y = intercept + slope * x`` per series; a constant
    x gives NULL slope instead of an error."""
    agg = [
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
        F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept"),
        F.regr_r2(F.col(y).cast("double"), F.col(x).cast("double")).alias("r2"),
    ]
    return df.groupBy(*by).agg(*agg) if by else df.agg(*agg)


def breach_day(fit: DataFrame, threshold: float) -> DataFrame:
    """``ceil((threshold - intercept) / slope)``; NULL unless the trend rises
    (the reference would report a past or infinite day)."""
    day = F.when(F.col("slope") > 0,
                 F.ceil((F.lit(threshold) - F.col("intercept")) / F.col("slope")).cast("bigint"))
    return fit.withColumn("breach_day", day)


def threshold_forecast(df: DataFrame, x: str, y: str, threshold: float, horizon_after: int = 4,
                       by: Sequence[str] = ()) -> DataFrame:
    """Fit, breach day, and the fitted line for days ``1 .. breach+4``.

    One series: the fit is one row, and the line comes from ``spark.range``,
    so a far-off breach day yields a long line split across partitions, not
    an ``explode`` inside one task.  Per series (``by``): one
    ``explode(sequence)`` per series row."""
    fit = breach_day(trend_fit(df, x, y, by), threshold)
    if not by:
        row = fit.first()
        if row is None or row["breach_day"] is None:
            return df.sparkSession.createDataFrame([], "day bigint, predicted double, breach_day bigint")
        days = df.sparkSession.range(1, int(row["breach_day"]) + horizon_after + 1).withColumnRenamed("id", "day")
        return days.select("day", (F.lit(row["intercept"]) + F.lit(row["slope"]) * F.col("day")).alias("predicted"),
                           F.lit(row["breach_day"]).cast("bigint").alias("breach_day"))
    line = fit.filter(F.col("breach_day").isNotNull()).select(
        *by, "slope", "intercept", "breach_day",
        # an already-crossed threshold (breach_day + horizon < 1) gives no line,
        # as range(1, breach + 5) does; sequence() would count downwards
        F.explode(F.when(F.col("breach_day") + horizon_after >= 1,
                         F.sequence(F.lit(1).cast("bigint"), F.col("breach_day") + horizon_after))
                  .otherwise(F.array().cast("array<bigint>"))).alias("day"))
    return line.select(*by, "day", (F.col("intercept") + F.col("slope") * F.col("day")).alias("predicted"),
                       "breach_day")


def cumulative_daily_counts(df: DataFrame, ts_col: str) -> DataFrame:
    """Daily event counts, their running total, and a day index from 1.
    The running window is over days (bounded by the time span), not rows."""
    from pyspark.sql import Window

    daily = df.groupBy(F.to_date(ts_col).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    first = daily.select(F.min("day")).scalar()
    return daily.select("day", (F.datediff("day", first) + 1).alias("day_index"), "n",
                        F.sum("n").over(w).alias("cumulative"))
