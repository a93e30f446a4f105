"""Window analytics.

Per-patient windows partition on ``patient_key``.  Windows the reference
writes without PARTITION BY ("global": moving average by id, running totals,
NTILE, CUME_DIST) use ``operators.order`` so no step holds all rows in one
task; top-k reports use Spark's per-partition top-k (TakeOrderedAndProject
or WindowGroupLimit) before any exchange.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import expr as X
from ..functions import fixed as FX
from ..functions.numeric import money, rdiv
from ..operators import histogram
from ..operators.calendar import with_running_sums
from ..operators.order import OrderSpec, moving_frame, ntile, ordered
from .intervals import patient_sequence

BILL = "total_bill_amount"


def _cents(c: str = BILL):
    return (F.col(c) * 100).cast("bigint")


def bill_rank(enc: DataFrame, top: int = 20) -> DataFrame:
    """RANK and DENSE_RANK by bill (highest first) for the top ``top`` bills.

    The top rows are taken first (a per-partition top-k, then one small
    merge); ranks computed on them are exact, since every larger bill is
    among them."""
    t = (enc.filter(F.col(BILL).isNotNull())
            .orderBy(F.col(BILL).desc(), F.col("id")).limit(top)
            .select("id", "patient_id", BILL))
    w = Window.orderBy(F.col(BILL).desc())  # over `top` rows
    return t.select("patient_id", money(F.col(BILL)).alias(BILL),
                    F.rank().over(w).cast("bigint").alias("spending_rank"),
                    F.dense_rank().over(w).cast("bigint").alias("dense_rank"))


def top_bills_per_diagnosis(enc: DataFrame, k: int = 3) -> DataFrame:
    """DENSE_RANK <= k inside each diagnosis.  Spark inserts a WindowGroupLimit
    below the exchange, so each task forwards at most its own top-k ranks per
    diagnosis: a diagnosis holding a third of all rows costs nothing extra."""
    w = Window.partitionBy("primary_diagnosis").orderBy(F.col(BILL).desc())
    return (enc.filter(F.col(BILL).isNotNull())
               .select("patient_id", "primary_diagnosis", BILL, F.dense_rank().over(w).cast("bigint").alias("bill_rank"))
               .filter(F.col("bill_rank") <= k)
               .select("patient_id", "primary_diagnosis", money(F.col(BILL)).alias(BILL), "bill_rank"))


def los_outliers(enc: DataFrame, top: int = 20) -> DataFrame:
    """Stay against the diagnosis average: ratio, flag, top ``top`` by ratio.

    The per-diagnosis average is an aggregate joined back (a handful of rows,
    which adaptive execution broadcasts) instead of a window partitioned by
    diagnosis, which would give each diagnosis to one task."""
    e = enc.filter(F.col("discharge_date").isNotNull() & F.col("admission_date").isNotNull()) \
           .withColumn("length_of_stay", X.length_of_stay().cast("bigint"))
    bench = e.groupBy("primary_diagnosis").agg(F.sum("length_of_stay").alias("_s"),
                                               F.count("length_of_stay").alias("_c"))
    j = e.join(bench, "primary_diagnosis")
    los, s, c = F.col("length_of_stay"), F.col("_s"), F.col("_c")
    status = (F.when(los * c >= 2 * s, FX.STAY_STATUS[0])
               .when(2 * los * c >= 3 * s, FX.STAY_STATUS[1])
               .otherwise(FX.STAY_STATUS[2]))
    out = j.select("id", "patient_id", "primary_diagnosis", "admission_date", "discharge_date", "length_of_stay",
                   rdiv(s, c, 1).alias("avg_benchmark"),
                   rdiv(los * c, s, 2).alias("stay_ratio"),
                   status.alias("stay_status"),
                   (los * c / s).alias("_exact"))
    return (out.orderBy(F.col("stay_ratio").desc(), F.col("id")).limit(top)
               .drop("id", "_exact"))


def _moving(enc: DataFrame, preceding: int = 9) -> DataFrame:
    e = enc.select("id", "admission_date", "admission_type", BILL).withColumn("_c", _cents())
    return moving_frame(e, "id", ["_c"], preceding)


def moving_avg_bill(enc: DataFrame, rows: int = 10) -> DataFrame:
    """Average of the bill over the current and previous rows=10 rows by id."""
    m = _moving(enc, rows - 1)
    return m.select("id", "admission_type", money(F.col(BILL)).alias(BILL),
                    rdiv(F.col("_win_sum__c"), F.col("_win_cnt__c") * 100, 2).alias(f"moving_avg_{rows}"))


def bill_deviation(enc: DataFrame, rows: int = 10, limit: int | None = None) -> DataFrame:
    """Moving average plus deviation, % difference and HIGH / LOW flag.
    ``limit`` keeps the first rows by id (the reference shows 50): their frames
    hold no later row, so they are taken first (a top-k per task); the other
    registered job keeps all rows."""
    m = _moving(enc.orderBy("id").limit(limit) if limit else enc, rows - 1)
    s, n, b = F.col("_win_sum__c"), F.col("_win_cnt__c"), F.col("_c")
    status = (F.when(2 * b * n > 3 * s, FX.BILL_STATUS[0]).when(2 * b * n < s, FX.BILL_STATUS[1])
               .otherwise(FX.BILL_STATUS[2]))
    out = m.select("id", "admission_date", "admission_type", money(F.col(BILL)).alias(BILL),
                   rdiv(s, n * 100, 2).alias(f"moving_avg_{rows}"),
                   rdiv(b * n - s, n * 100, 2).alias("deviation_from_avg"),
                   rdiv((b * n - s) * 100, s, 2).alias("pct_diff"),
                   status.alias("bill_status"))
    return out.orderBy("id") if limit else out


def bill_delta(enc: DataFrame) -> DataFrame:
    prev = F.col(f"_prev_{BILL}")
    return patient_sequence(enc, lag=(BILL,)).select("patient_id", "admission_date", money(F.col(BILL)).alias(BILL),
                      money(prev).alias("previous_bill"), money(F.col(BILL) - prev).alias("bill_change"))


def bill_trends(enc: DataFrame, trend: str | None = FX.TRENDS[0]) -> DataFrame:
    """Bill change against the previous visit with % change, trend label and
    visit number; ``trend`` filters on the label (None keeps all)."""
    t = patient_sequence(enc, lag=(BILL,)).select(
        "patient_id", "admission_date", F.col(BILL).alias("_b"), F.col(f"_prev_{BILL}").alias("_p"),
        F.col("_seq").alias("visit_number"))
    b, p = F.col("_b"), F.col("_p")
    first, up, down, same = FX.TRENDS
    label = F.when(p.isNull(), first).when(b > p, up).when(b < p, down).otherwise(same)
    out = t.select("patient_id", "admission_date", money(b).alias(BILL), money(p).alias("previous_bill"),
                   money(b - p).alias("bill_change"),
                   rdiv((b * 100 - p * 100).cast("bigint") * 100, (p * 100).cast("bigint"), 2).alias("pct_change"),
                   label.alias("trend"), "visit_number")
    if trend is not None:
        out = out.filter(F.col("trend") == trend)
    return out.orderBy(F.col("bill_change").desc_nulls_first())


def monthly_cumulative(enc: DataFrame) -> DataFrame:
    """Revenue running within each month (default RANGE frame: same-day rows
    share the total), from day sums: rows are summed per day and look the
    running sum of their day up, so no window runs over rows."""
    o = with_running_sums(enc.select("admission_date", BILL), "admission_date", BILL)
    return o.select("admission_date", money(F.col(BILL)).alias(BILL),
                    money(F.col("_month_running")).alias("monthly_cumulative_revenue"))


def running_total(enc: DataFrame, frame: str = "rows") -> DataFrame:
    """Running revenue by admission date.  ``frame='rows'``: ROWS frame with id
    as tie-break; ``'range'``: the default RANGE frame, same-day rows share the
    sum of their day."""
    if frame == "range":
        o, col = with_running_sums(enc.select("admission_date", BILL), "admission_date", BILL), "_running"
    else:
        o = ordered(enc.select("id", "admission_date", BILL), OrderSpec("admission_date", "id"), sums=(BILL,))
        col = f"_rows_{BILL}"
    return o.select("admission_date", money(F.col(BILL)).alias(BILL), money(F.col(col)).alias("running_total"))


def _bill_order(enc: DataFrame, descending: bool, drop_null: bool) -> DataFrame:
    e = enc.select("id", "patient_id", "primary_diagnosis", BILL)
    if drop_null:
        e = e.filter(F.col(BILL).isNotNull())
    return ordered(e, OrderSpec(BILL, "id", descending=descending))


def top_cost_percentiles(enc: DataFrame, keep: int = 5) -> DataFrame:
    """NTILE(100) by bill, highest first; the top ``keep`` percentiles."""
    o = _bill_order(enc, True, True)
    return (o.select("patient_id", money(F.col(BILL)).alias(BILL), "primary_diagnosis",
                     ntile(100, F.col("_rn"), F.col("_n")).alias("cost_percentile"))
             .filter(F.col("cost_percentile") <= keep)
             .orderBy(F.col(BILL).desc()))


def cost_ntiles(enc: DataFrame) -> DataFrame:
    o = _bill_order(enc, False, True)
    rn, n = F.col("_rn"), F.col("_n")
    return o.select("patient_id", money(F.col(BILL)).alias(BILL),
                    ntile(4, rn, n).alias("quartile"), ntile(10, rn, n).alias("decile"),
                    ntile(100, rn, n).alias("percentile"))


def quartile_summary(enc: DataFrame) -> DataFrame:
    """min / max / average bill per NTILE(4) over all rows (NULL bills sort
    last, so they sit in the last quartile), from the histogram of bills."""
    scan, total = histogram.running_counts(enc.select(BILL), BILL)
    q = histogram.tiles(scan, total, 4)
    big = "decimal(38,0)"
    known = F.when(F.col(BILL).isNotNull(), F.col("rows"))
    return q.groupBy(F.col("tile").alias("quartile")).agg(
        money(F.min(BILL)).alias("min_cost"), money(F.max(BILL)).alias("max_cost"),
        rdiv(F.sum((_cents().cast(big) * F.col("rows")).cast(big)), F.sum(known) * 100, 2).alias("avg_cost"))


def spend_cdf(enc: DataFrame) -> DataFrame:
    """CUME_DIST of the bill (NULL bills last, so their cdf is 1): every row looks
    its bill up in the running counts of the histogram."""
    scan, total = histogram.running_counts(enc.select(BILL), BILL)
    share = scan.select(F.col(BILL).alias("_bill"), (F.col("upto") / F.lit(total)).alias("cdf"))
    rows = enc.select("patient_id", BILL)
    return rows.join(share, F.col(BILL).eqNullSafe(F.col("_bill"))).select(
        "patient_id", money(F.col(BILL)).alias(BILL), "cdf")


def cdf_threshold(enc: DataFrame, p: float = 0.8, top: float = 0.9) -> DataFrame:
    """Largest bill with cdf <= p, smallest bill with cdf >= p, rows with cdf > top,
    from the histogram of bills: one row per different bill."""
    scan, total = histogram.running_counts(enc.select(BILL), BILL)
    b, cdf = money(F.col(BILL)), F.col("upto") / F.lit(total)
    return scan.agg(F.max(F.when(cdf <= p, b)).alias("bill_at_or_below_p"),
                    F.min(F.when(cdf >= p, b)).alias("bill_at_or_above_p"),
                    F.coalesce(F.sum(F.when(cdf > top, F.col("n"))), F.lit(0)).alias("rows_above_top"))


def visit_sequence(enc: DataFrame) -> DataFrame:
    s = patient_sequence(enc, lag=("admission_date",), lead=("admission_date",))
    return s.select("patient_id", "admission_date", F.col("_seq").alias("visit_number"),
                    F.col("_prev_admission_date").alias("prev_visit"),
                    F.col("_next_admission_date").alias("next_visit"))


def _patient_spend(enc: DataFrame) -> DataFrame:
    """Spend per patient; patients whose bills are all NULL have no spend and
    are left out before ranking (with NULLs first, they would fill the top
    bucket)."""
    s = enc.groupBy("patient_key", "patient_id").agg(F.sum(BILL).alias("total_spend"))
    return s.filter(F.col("total_spend").isNotNull())


def _top_bucket(enc: DataFrame) -> DataFrame:
    s = _patient_spend(enc)
    o = ordered(s, OrderSpec("total_spend", "patient_key", descending=True))
    return o.withColumn("percentile", ntile(100, F.col("_rn"), F.col("_n")))


def pareto_top1(enc: DataFrame) -> DataFrame:
    t = _top_bucket(enc)
    return t.agg(money(F.sum(F.when(F.col("percentile") == 1, F.col("total_spend")))).alias("top_1_percent_cost"),
                 money(F.sum("total_spend")).alias("total_hospital_revenue"))


def top1_patients(enc: DataFrame) -> DataFrame:
    t = _top_bucket(enc)
    return (t.filter(F.col("percentile") == 1)
             .select("patient_id", money(F.col("total_spend")).alias("total_spend"))
             .orderBy(F.col("total_spend").desc()))


def bill_zscore(enc: DataFrame) -> DataFrame:
    """z-score of every bill against the mean and sample standard deviation.

    One aggregate gives three exact numbers (count, sum and sum of squares of
    the bills in whole cents); they enter the row-level plan as literals, so
    the rows need no join.  The variance formula then runs in double on those
    exact sums."""
    e = enc.filter(F.col(BILL).isNotNull()).withColumn("_c", _cents())
    c = F.col("_c").cast("decimal(38,0)")
    st = e.agg(F.count(F.lit(1)).alias("n"), F.sum(c).alias("s"), F.sum(c * c).alias("q")).first()
    n_i = int(st["n"])
    # literals are made from the Decimals: a Python int has to fit into 64 bits,
    # which the sum of squares in sf0.1 exceeds from about 270,000 bills on
    s_d, q_d = (F.lit(Decimal(0) if v is None else v).cast("decimal(38,0)") for v in (st["s"], st["q"]))
    n, s, q = F.lit(n_i).cast("double"), s_d.cast("double"), q_d.cast("double")
    mean_c = s / n
    # sample sd: NULL for fewer than two bills; a zero sd gives NULL z-scores
    var = F.when(F.lit(n_i) > 1, (q - s * s / n) / (n - 1))
    sd_c = F.nullif(F.sqrt(F.greatest(var, F.lit(0.0))), F.lit(0.0))
    z = (F.col("_c") - mean_c) / sd_c
    extreme, moderate, above, below, normal = FX.Z_BANDS
    band = (F.when(z > 3, extreme).when(z > 2, moderate).when(z > 1, above).when(z < -1, below)
             .otherwise(normal))
    return (e.select("patient_id", money(F.col(BILL)).alias(BILL),
                     rdiv(s_d, F.lit(n_i * 100), 2).alias("population_mean"),
                     (F.round(sd_c / 100, 2) + F.lit(0.0)).alias("standard_deviation"),
                     (F.round(z, 2) + F.lit(0.0)).alias("z_score"),
                     band.alias("outlier_status"))
             .orderBy(F.col("z_score").desc()))


def bill_spread(enc: DataFrame) -> DataFrame:
    """Per diagnosis: bills, mean and sample standard deviation."""
    return enc.groupBy("primary_diagnosis").agg(
        F.count(BILL).alias("bills"), rdiv(F.sum(_cents()), F.count(BILL) * 100, 2).alias("avg_bill"),
        F.round(F.stddev_samp(F.col(BILL).cast("double")), 2).alias("bill_stddev"))


def patient_bill_share(enc: DataFrame) -> DataFrame:
    """Every bill as a share of its patient's bills: SUM(bill) OVER (PARTITION BY
    patient) without ORDER BY.  The window has the exchange that the aggregate
    would need too, and its rows spill, so a hot patient is a long task only."""
    w = Window.partitionBy("patient_key")
    c = _cents()
    return enc.select("id", "patient_id", money(F.col(BILL)).alias(BILL),
                      money(F.sum(BILL).over(w)).alias("patient_total"), F.count(F.lit(1)).over(w).alias("patient_visits"),
                      rdiv(c * 100, F.sum(c).over(w), 2).alias("pct_of_patient"))
