"""Visit intervals and episodes of care.

All jobs start from ``with_gaps``: one window over the patient's visits in
(admission_date, id) order.  The window is partitioned on ``patient_key``,
which the encounter join already hash-partitions on, so the plan has a single
exchange; the aggregates that follow are partial (map-side) aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import expr as X
from ..functions.numeric import rdiv
from ..operators import histogram
from ..operators.sequence import hot_keys, sequence

# A patient with more visits than this is "hot": its visits are ordered by
# the bucketed global order instead of inside one window task.
MAX_ROWS_PER_KEY = 2_000_000


def patient_sequence(enc: DataFrame, lag=(), lead=(), sums=(), hot=None, max_rows: int | None = None) -> DataFrame:
    """Visits of each patient in (admission_date, id) order: ``_seq``,
    ``_prev_<c>``, ``_next_<c>``, ``_cum_<c>`` (see operators.sequence)."""
    return sequence(enc, "patient_key", "admission_date", "id", tuple(lag), tuple(lead), tuple(sums),
                    max_rows or MAX_ROWS_PER_KEY, hot)


def patient_hot_keys(enc: DataFrame) -> list:
    return hot_keys(enc, "patient_key", MAX_ROWS_PER_KEY)


def with_gaps(enc: DataFrame, lag_more=(), hot=None) -> DataFrame:
    """Adds prev_discharge_date and days_gap (bigint, NULL on a first visit),
    plus ``_seq`` and ``_prev_<c>`` for ``lag_more``.  For ordinary patients
    this is one window partitioned on patient_key (the partitioning the
    encounter join already has)."""
    s = patient_sequence(enc, lag=("discharge_date",) + tuple(lag_more), hot=hot)
    return (s.withColumnRenamed("_prev_discharge_date", "prev_discharge_date")
             .withColumn("days_gap", F.datediff("admission_date", "prev_discharge_date").cast("bigint")))


def visit_gap(enc: DataFrame) -> DataFrame:
    return with_gaps(enc).select("patient_id", "admission_date", "prev_discharge_date", "days_gap")


def visit_gap_context(enc: DataFrame) -> DataFrame:
    return (with_gaps(enc, lag_more=("discharge_disposition", "primary_diagnosis"))
            .select("patient_id", "admission_date", "prev_discharge_date", "days_gap",
                    F.col("_prev_discharge_disposition").alias("prev_discharge_disposition"),
                    F.col("discharge_disposition").alias("current_discharge_disposition"),
                    "primary_diagnosis",
                    F.col("_prev_primary_diagnosis").alias("prev_diagnosis")))


def visit_gap_risk(enc: DataFrame) -> DataFrame:
    """Every visit with its risk tier.  The reference filters on window
    functions inside WHERE (not legal SQL); the gap is derived first and the
    same predicate applied after."""
    g = with_gaps(enc)
    return (g.filter(F.col("days_gap").isNotNull() | F.col("prev_discharge_date").isNull())
             .select("patient_id", "admission_date", "prev_discharge_date", "days_gap",
                     "readmitted_30_days",
                     X.gap_risk_level(F.col("days_gap")).alias("readmission_risk_level"))
             .orderBy("patient_id", "admission_date"))


def revisit_detail(enc: DataFrame) -> DataFrame:
    g = (with_gaps(enc, lag_more=("primary_diagnosis",))
         .withColumn("visit_number", F.col("_seq"))
         .withColumn("prev_diagnosis", F.col("_prev_primary_diagnosis")))
    return (g.filter(F.col("visit_number") > 1)
             .select("patient_id", "visit_number", "admission_date", "prev_discharge_date",
                     "days_gap", "primary_diagnosis", "prev_diagnosis", "readmitted_30_days",
                     X.gap_risk_category(F.col("days_gap")).alias("risk_category"))
             .orderBy("patient_id", "admission_date"))


def _readmissions(enc: DataFrame) -> DataFrame:
    return with_gaps(enc).filter(F.col("days_gap").isNotNull())


def _share(count_col: str, digits: int):
    """count * 100 / SUM(count) OVER () on the aggregated rows (a handful of
    tiers, so the global window runs over a bounded table)."""
    total = F.sum(count_col).over(Window.partitionBy())
    return rdiv(F.col(count_col) * 100, total, digits)


def gap_distribution_4(enc: DataFrame) -> DataFrame:
    g = _readmissions(enc).withColumn("readmission_window", X.gap_tier4(F.col("days_gap")))
    agg = (g.groupBy("readmission_window")
            .agg(F.count(F.lit(1)).alias("patient_count"),
                 rdiv(F.sum("days_gap"), F.count("days_gap"), 1).alias("avg_days_gap"),
                 F.min("days_gap").alias("min_days"),
                 F.max("days_gap").alias("max_days")))
    order = X.order_of(F.col("readmission_window"), X.gap_tier4_labels())
    return (agg.withColumn("pct_of_readmissions", _share("patient_count", 2))
               .withColumn("window_order", order.cast("int"))
               .orderBy("window_order"))


def gap_distribution_5(enc: DataFrame) -> DataFrame:
    g = _readmissions(enc).withColumn("readmission_window", X.gap_tier5(F.col("days_gap")))
    agg = (g.groupBy("readmission_window")
            .agg(F.count(F.lit(1)).alias("patient_count"),
                 rdiv(F.sum("days_gap"), F.count("days_gap"), 1).alias("avg_gap")))
    order = X.order_of(F.col("readmission_window"), X.gap_tier5_labels())
    return (agg.withColumn("pct_distribution", _share("patient_count", 2))
               .withColumn("window_order", order.cast("int"))
               .orderBy("window_order"))


def gap_by_diagnosis(enc: DataFrame) -> DataFrame:
    """Per diagnosis: readmissions, average / min / max / median gap.

    Gaps are days, so a diagnosis has few different ones: the rows collapse to
    (diagnosis, gap, n), and the median is selected from the cumulated counts.
    No aggregate holds a map of values."""
    h = _gap_counts(enc)
    n, gap = F.col("n"), F.col("days_gap")
    return (h.groupBy("primary_diagnosis")
            .agg(F.sum(n).alias("readmission_count"),
                 rdiv(F.sum(gap * n), F.sum(n), 1).alias("avg_days_to_readmit"),
                 F.min(gap).alias("min_days"),
                 F.max(gap).alias("max_days"),
                 F.round(histogram.percentile_cont("days_gap", 0.5), 1).alias("median_days"))
            .orderBy("avg_days_to_readmit"))


def gap_percentiles(enc: DataFrame, shares: tuple[int, ...] = (25, 50, 90)) -> DataFrame:
    """Per diagnosis the discrete percentiles of the gap: values that occur."""
    h = _gap_counts(enc)
    return h.groupBy("primary_diagnosis").agg(
        F.sum("n").alias("readmission_count"),
        *[histogram.percentile_disc("days_gap", k / 100).alias(f"p{k}_days") for k in shares])


def _gap_counts(enc: DataFrame) -> DataFrame:
    return histogram.grouped_running_counts(_readmissions(enc), "days_gap", "primary_diagnosis")


def high_risk_share(enc: DataFrame) -> DataFrame:
    r = _readmissions(enc)
    hi = F.sum(F.when(F.col("days_gap") <= 30, 1).otherwise(0))
    return r.agg(F.count(F.lit(1)).alias("total_readmissions"),
                 hi.cast("bigint").alias("high_risk_readmissions"),
                 rdiv(hi * 100, F.count(F.lit(1)), 2).alias("pct_high_risk"))


def _patient_gap_stats(enc: DataFrame) -> DataFrame:
    r = _readmissions(enc)
    rapid = F.sum(F.when(F.col("days_gap") <= 30, 1).otherwise(0))
    # grouping on (patient_key, patient_id) is satisfied by the window's
    # hash partitioning on patient_key: no second exchange
    return (r.groupBy("patient_key", "patient_id")
             .agg(F.count(F.lit(1)).alias("total_readmissions"),
                  rdiv(F.sum("days_gap"), F.count("days_gap"), 1).alias("avg_days_between_visits"),
                  F.min("days_gap").alias("fastest_readmit"),
                  F.max("days_gap").alias("slowest_readmit"),
                  rdiv(rapid * 100, F.count(F.lit(1)), 0).alias("pct_rapid_readmit")))


def frequent_flyers(enc: DataFrame, min_readmissions: int = 3, top: int = 10) -> DataFrame:
    """Top patients by number of readmissions (ties broken by patient_id)."""
    s = _patient_gap_stats(enc).filter(F.col("total_readmissions") >= min_readmissions)
    return (s.orderBy(F.col("total_readmissions").desc(), F.col("patient_id").asc())
             .limit(top).drop("patient_key"))


def case_management_targets(enc: DataFrame, min_readmissions: int = 3) -> DataFrame:
    s = _patient_gap_stats(enc).filter(F.col("total_readmissions") >= min_readmissions)
    return (s.filter((F.col("avg_days_between_visits") < 30) | (F.col("pct_rapid_readmit") > 50))
             .drop("patient_key"))


def care_episodes(enc: DataFrame, continue_days: int = 1) -> DataFrame:
    """Episode number per visit: a gap of at most ``continue_days`` continues
    the episode, a first visit or longer gap starts a new one.  The running
    sum uses the default RANGE frame on admission_date, so visits on the same
    day share the number."""
    hot = patient_hot_keys(enc)
    g = with_gaps(enc, hot=hot)
    g = g.select("patient_key", "id", "patient_id", "admission_date", "discharge_date", "days_gap",
                 F.when(F.col("days_gap") <= continue_days, 0).otherwise(1).alias("_start"))
    e = patient_sequence(g, sums=("_start",), hot=hot)
    return e.select("patient_id", "admission_date", "discharge_date",
                    F.col("days_gap").alias("days_since_last_discharge"),
                    F.col("_cum__start").cast("bigint").alias("episode_id"))
