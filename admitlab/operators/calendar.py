"""Running sums by date without a window over rows (two-level calendar prefix sum).

Rows are summed per day (a partial aggregate).  Days run within their month (at
most 31 rows a window) and months run on one row per month; a day's running sum
is its month's start plus its place in the month.  Rows then look up their day.
All rows of a day share the sum, as in the default RANGE frame of
``SUM(v) OVER (ORDER BY date)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def day_sums(df: DataFrame, date_col: str, value: str) -> DataFrame:
    """One row per day: ``date_col``, ``_running`` (sum over all days up to this
    one) and ``_month_running`` (over the days of its month up to this one).

    Both are NULL while no non-NULL value has been seen, like SQL's SUM.  Rows
    without a date are one day, after all others and in a month of its own.  The
    column must be a date: that bounds the table by the days of the calendar, at
    most 3,652,059, whatever the number of rows."""
    if not isinstance(df.schema[date_col].dataType, T.DateType):
        raise TypeError(f"{date_col} must be a date")
    days = df.groupBy(date_col).agg(F.sum(value).alias("_s"), F.count(value).alias("_c")) \
             .withColumn("_month", F.trunc(date_col, "MM"))
    inside = Window.partitionBy("_month").orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = days.withColumn("_in", F.sum("_s").over(inside)).withColumn("_seen", F.sum("_c").over(inside))
    earlier = Window.orderBy(F.col("_month").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    months = (days.groupBy("_month").agg(F.sum("_s").alias("_ms"), F.sum("_c").alias("_mc"))
              .select(F.col("_month").alias("_m"), F.sum("_ms").over(earlier).alias("_before"),
                      F.coalesce(F.sum("_mc").over(earlier), F.lit(0)).alias("_seen_before")))
    both = days.join(months, F.col("_month").eqNullSafe(F.col("_m")))
    zero = F.lit(0)
    return both.select(
        date_col,
        F.when(F.col("_seen") + F.col("_seen_before") > 0,
               F.coalesce("_before", zero) + F.coalesce("_in", zero)).alias("_running"),
        F.when(F.col("_seen") > 0, F.col("_in")).alias("_month_running"))


def with_running_sums(df: DataFrame, date_col: str, value: str) -> DataFrame:
    """``df`` plus ``_running`` and ``_month_running`` of its day (``day_sums``).
    The day table is bounded by the calendar, so it is broadcast; a day that
    holds a third of the rows costs nothing extra."""
    days = day_sums(df, date_col, value).withColumnRenamed(date_col, "_day")
    return df.join(F.broadcast(days), F.col(date_col).eqNullSafe(F.col("_day"))).drop("_day")
