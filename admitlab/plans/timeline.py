"""Time analysis.

Windows here run over aggregated calendar rows (one per month or day), so
their size is bounded by the calendar span, not by the number of admissions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import fixed as FX
from ..functions.numeric import rdiv


def _rate(digits: int):
    flag = F.col("readmitted_30_days")
    return rdiv(F.sum(flag) * 100, F.count(flag), digits)


def _month(c="admission_date"):
    return F.trunc(F.col(c), "MM")


def monthly_active(df: DataFrame) -> DataFrame:
    return (df.groupBy(_month().alias("admission_month"))
              .agg(F.count_distinct("patient_key").alias("distinct_patients"))
              .orderBy("admission_month"))


def cohort_retention(df: DataFrame) -> DataFrame:
    """Cohort = month of the first admission; patients seen k months later.
    The first month is a per-patient minimum joined back, then one distinct
    count per (cohort, k)."""
    visits = df.select("patient_key", _month().alias("m"))
    # first month per patient: a partial aggregate joined back (a hot
    # patient's rows are combined map-side, the join splits skewed partitions)
    first = visits.groupBy("patient_key").agg(F.min("m").alias("cohort_month"))
    m = visits.join(first, "patient_key")
    k = F.months_between(F.col("m"), F.col("cohort_month")).cast("int")
    return (m.groupBy("cohort_month", k.alias("months_since_first"))
             .agg(F.count_distinct("patient_key").alias("patients"))
             .orderBy("cohort_month", "months_since_first"))


def day_of_week_effect(df: DataFrame, pad: bool = False) -> DataFrame:
    """Weekday name (trimmed; ``pad=True`` pads to 9 characters like TO_CHAR)."""
    name = F.date_format("admission_date", "EEEE")
    if pad:
        name = F.rpad(name, 9, " ")
    return (df.groupBy(name.alias("day_of_week"))
              .agg(F.count(F.lit(1)).alias("admissions"), _rate(2).alias("readmission_rate"))
              .orderBy(F.col("readmission_rate").desc()))


def weekend_mix(df: DataFrame) -> DataFrame:
    iso = F.weekday("admission_date") + 1  # ISO day of week, Monday = 1
    day_type = F.when(iso.isin(*FX.WEEKEND_ISO_DAYS), FX.DAY_TYPES[0]).otherwise(FX.DAY_TYPES[1])
    return (df.groupBy(day_type.alias("day_type"), "primary_diagnosis")
              .agg(F.count(F.lit(1)).alias("admissions"))
              .orderBy("day_type", F.col("admissions").desc()))


def seasonal_months(df: DataFrame, pad: bool = False) -> DataFrame:
    """Month number and name (trimmed; ``pad=True`` pads to 9 characters like
    TO_CHAR(d, 'Month')): admissions and readmission rate."""
    name = F.date_format("admission_date", "MMMM")
    if pad:
        name = F.rpad(name, 9, " ")
    return (df.groupBy(F.month("admission_date").alias("month"), name.alias("month_name"))
              .agg(F.count(F.lit(1)).alias("admissions"), _rate(1).alias("readmission_rate"))
              .orderBy("month"))


def monthly_rate_change(df: DataFrame) -> DataFrame:
    flag = F.col("readmitted_30_days")
    monthly = df.groupBy(_month().alias("month")).agg(
        (F.sum(flag) / F.count(flag)).alias("readmission_rate"))
    w = Window.orderBy("month")  # one row per month
    return (monthly.withColumn("rate_change", F.col("readmission_rate") - F.lag("readmission_rate").over(w))
                   .orderBy(F.col("month").desc()))


def _month_calendar(monthly: DataFrame) -> DataFrame:
    """Every month between the first and the last one present."""
    return monthly.agg(F.min("month").alias("a"), F.max("month").alias("b")).select(
        F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month"))


def yoy_admissions(df: DataFrame, dense: bool = False) -> DataFrame:
    """Monthly admissions against 12 rows back.  ``dense`` first fills the
    month calendar with zero months, so 12 rows back is always 12 months."""
    monthly = df.groupBy(_month().alias("month")).agg(F.count(F.lit(1)).alias("monthly_admissions"))
    if dense:
        monthly = (_month_calendar(monthly).join(monthly, "month", "left")
                   .select("month", F.coalesce("monthly_admissions", F.lit(0)).cast("bigint").alias("monthly_admissions")))
    w = Window.orderBy("month")
    prev = F.lag("monthly_admissions", 12).over(w)
    c = F.col("monthly_admissions")
    return (monthly.select("month", "monthly_admissions", prev.alias("same_month_last_year"))
                   .withColumn("yoy_change", c - F.col("same_month_last_year"))
                   .withColumn("yoy_pct_change", rdiv(F.col("yoy_change") * 100, F.col("same_month_last_year"), 2))
                   .orderBy("month"))


def moving_avg_daily(df: DataFrame, days: int = 7, dense: bool = False) -> DataFrame:
    """Daily admissions and their average over the last ``days`` rows.  With
    ``dense`` the calendar is filled with zero days first, so the frame is
    ``days`` calendar days."""
    daily = df.groupBy("admission_date").agg(F.count(F.lit(1)).alias("daily_admissions"))
    if dense:
        cal = daily.agg(F.min("admission_date").alias("a"), F.max("admission_date").alias("b")).select(
            F.explode(F.sequence("a", "b")).alias("admission_date"))
        daily = (cal.join(daily, "admission_date", "left")
                 .select("admission_date", F.coalesce("daily_admissions", F.lit(0)).cast("bigint").alias("daily_admissions")))
    w = Window.orderBy("admission_date").rowsBetween(-(days - 1), 0)
    c = F.col("daily_admissions")
    return (daily.withColumn(f"moving_avg_{days}day", F.sum(c).over(w) / F.count(c).over(w))
                 .orderBy("admission_date"))


def churn_status(df: DataFrame, as_of: dt.date = dt.date(2001, 8, 1)) -> DataFrame:
    """Last visit per patient; 'Churned' when before as_of minus one year."""
    cutoff = F.add_months(F.lit(as_of), -12)
    return (df.groupBy("patient_key", "patient_id").agg(F.max("admission_date").alias("last_visit"))
              .select("patient_id", "last_visit",
                      F.when(F.col("last_visit") < cutoff, "Churned").otherwise("Active").alias("status")))
