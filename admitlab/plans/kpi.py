"""Distribution and KPI aggregates.

All are hash aggregates with map-side partial aggregation; shares use a
window over the aggregated rows (one row per group, so bounded by the number
of groups, never by the table)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import expr as X
from ..functions import fixed as FX
from ..functions.numeric import money, ravg, rdiv, scaled_sum
from ..operators.matview import View


def _rate(digits: int):
    """ROUND(AVG(readmitted_30_days) * 100, digits), exact."""
    return rdiv(F.sum(F.col("readmitted_30_days")) * 100, F.count(F.col("readmitted_30_days")), digits)


def _share(count_col: str, digits: int):
    return rdiv(F.col(count_col) * 100, F.sum(count_col).over(Window.partitionBy()), digits)


def readmission_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_patients"),
                  F.sum(F.col("readmitted_30_days")).cast("bigint").alias("total_readmissions"),
                  _rate(2).alias("readmission_rate"))


def payer_mix(df: DataFrame, digits: int = 2, share_name: str = "pct_share") -> DataFrame:
    return (df.groupBy("insurance_type").agg(F.count(F.lit(1)).alias("total_patients"))
              .withColumn(share_name, _share("total_patients", digits))
              .orderBy(F.col(share_name).desc()))


def gender_distribution(df: DataFrame) -> DataFrame:
    return (df.groupBy("gender").agg(F.count(F.lit(1)).alias("total_patients"))
              .withColumn("pct_share", _share("total_patients", 2)))


def los_distribution(df: DataFrame) -> DataFrame:
    return (df.groupBy(X.length_of_stay().cast("bigint").alias("los"))
              .agg(F.count(F.lit(1)).alias("admissions")).orderBy("los"))


def top_diagnoses(df: DataFrame) -> DataFrame:
    return (df.groupBy("primary_diagnosis").agg(F.count(F.lit(1)).alias("admissions"))
              .orderBy(F.col("admissions").desc()))


def rate_by_income_tier(df: DataFrame) -> DataFrame:
    return (df.groupBy(X.income_tier().alias("income_tier"))
              .agg(F.count(F.lit(1)).alias("total_patients"),
                   F.sum(F.col("readmitted_30_days")).cast("bigint").alias("readmitted_count"),
                   _rate(2).alias("readmission_rate"))
              .orderBy(F.col("readmission_rate").desc()))


def insured_vs_uninsured(df: DataFrame, insured=FX.INSURED) -> DataFrame:
    status = F.when(F.col("insurance_type").isin(*insured), FX.COVERAGE[0]).otherwise(FX.COVERAGE[1])
    return (df.groupBy(status.alias("coverage_status"))
              .agg(F.count(F.lit(1)).alias("patients"), ravg(F.col("total_bill_amount"), 2, 0).alias("avg_bill")))


def payer_price_gap(df: DataFrame, diagnosis: str = "Heart Failure",
                    payer_a: str = "Medicare", payer_b: str = "Private") -> DataFrame:
    """Average bill of two payers for one diagnosis and their difference
    (conditional aggregates; the difference is rounded exactly)."""
    ins = F.col("insurance_type")
    a = F.when(ins == payer_a, F.col("total_bill_amount"))
    b = F.when(ins == payer_b, F.col("total_bill_amount"))
    sa, na = scaled_sum(a, 2), F.count(a)
    sb, nb = scaled_sum(b, 2), F.count(b)
    return (df.filter(ins.isin(payer_a, payer_b) & (F.col("primary_diagnosis") == diagnosis))
              .groupBy("primary_diagnosis")
              .agg(ravg(a, 2, 0).alias("medicare_avg"),
                   ravg(b, 2, 0).alias("private_avg"),
                   rdiv(sa * nb - sb * na, na * nb * 100, 0).alias("price_gap")))


def rate_by_diagnosis(df: DataFrame) -> DataFrame:
    return (df.groupBy("primary_diagnosis")
              .agg(F.count(F.lit(1)).alias("total_cases"),
                   F.sum(F.col("readmitted_30_days")).cast("bigint").alias("readmissions"),
                   _rate(1).alias("readmission_rate"))
              .orderBy(F.col("readmission_rate").desc()))


def revenue_by_region(df: DataFrame) -> DataFrame:
    return (df.groupBy("hospital_region")
              .agg(F.count(F.lit(1)).alias("patient_volume"),
                   money(F.sum(F.col("total_bill_amount"))).alias("total_revenue"),
                   ravg(F.col("total_bill_amount"), 2, 2).alias("avg_revenue_per_patient"))
              .orderBy(F.col("total_revenue").desc()))


def regional_stats(df: DataFrame) -> DataFrame:
    """The materialised-view body: patients and average cost per region."""
    return (df.groupBy("hospital_region")
              .agg(F.count(F.lit(1)).alias("total_patients"), ravg(F.col("total_bill_amount"), 2, 2).alias("avg_cost")))


def regional_view(name: str, rows: Callable[[DataFrame], DataFrame]) -> View:
    """The same as a stored view: counts and cents by region add up over input files."""
    bill = F.col("total_bill_amount")
    return View(name, ("hospital_region",), rows,
                {"n": F.count(F.lit(1)), "bills": F.count(bill), "cents": scaled_sum(bill, 2)},
                {"total_patients": F.col("n"), "avg_cost": rdiv(F.col("cents"), F.col("bills") * 100, 2)})


def los_by_hospital_type(df: DataFrame) -> DataFrame:
    los = X.length_of_stay()
    return (df.groupBy("hospital_type")
              .agg(F.count(F.lit(1)).alias("admissions"),
                   rdiv(F.sum(los), F.count(los), 1).alias("avg_los"),
                   F.min(los).cast("bigint").alias("min_los"),
                   F.max(los).cast("bigint").alias("max_los")))


def comorbidity_impact(df: DataFrame) -> DataFrame:
    los = X.length_of_stay()
    return (df.filter(F.col("comorbidity_score").isNotNull())
              .groupBy("comorbidity_score")
              .agg(F.count(F.lit(1)).alias("patient_count"),
                   _rate(1).alias("readmission_rate"),
                   ravg(F.col("total_bill_amount"), 2, 0).alias("avg_cost"),
                   rdiv(F.sum(los), F.count(los), 1).alias("avg_los"))
              .orderBy("comorbidity_score"))


def adherence_impact(df: DataFrame) -> DataFrame:
    m = F.col("missed_medications")
    level = X.ladder(m, "<=", FX.ADHERENCE, FX.ADHERENCE_ELSE, start=F.when(m == 0, FX.ADHERENCE_PERFECT))
    return (df.groupBy(level.alias("adherence_level"))
              .agg(F.count(F.lit(1)).alias("patients"), _rate(1).alias("readmission_rate"))
              .orderBy("adherence_level"))


def icu_impact(df: DataFrame) -> DataFrame:
    r = F.col("icu_utilization_ratio")
    cat = X.ladder(r, ">", FX.ICU_USE, FX.ICU_USE_ELSE)
    return (df.groupBy(cat.alias("icu_category"))
              .agg(F.count(F.lit(1)).alias("patient_count"), _rate(1).alias("readmission_rate"),
                   ravg(F.col("total_bill_amount"), 2, 0).alias("avg_cost"))
              .orderBy("icu_category"))


def payer_profitability(df: DataFrame) -> DataFrame:
    oop = F.col("out_of_pocket_ratio")
    return (df.filter(F.col("total_bill_amount").isNotNull()).groupBy("insurance_type")
              .agg(F.count(F.lit(1)).alias("patients"),
                   ravg(F.col("total_bill_amount"), 2, 0).alias("avg_bill"),
                   ravg(oop, 4, 3).alias("avg_oop_ratio"),
                   ravg(F.col("total_bill_amount") * oop, 6, 0).alias("avg_patient_payment"),
                   ravg(F.col("total_bill_amount") * (1 - oop), 6, 0).alias("avg_insurance_payment"))
              .orderBy(F.col("avg_insurance_payment").desc()))


def age_income_crosstab(df: DataFrame) -> DataFrame:
    a, i = F.col("age"), F.col("household_income")
    (a_lo, a_hi), (i_lo, i_hi) = FX.CROSS_AGE_BOUNDS, FX.CROSS_INCOME_BOUNDS
    age_group = (F.when(a < a_lo, FX.CROSS_AGE[0]).when(a.between(a_lo, a_hi), FX.CROSS_AGE[1])
                  .otherwise(FX.CROSS_AGE[2]))
    income_level = (F.when(i < i_lo, FX.CROSS_INCOME[0]).when(i.between(i_lo, i_hi), FX.CROSS_INCOME[1])
                     .otherwise(FX.CROSS_INCOME[2]))
    return (df.filter(i.isNotNull())
              .groupBy(age_group.alias("age_group"), income_level.alias("income_level"))
              .agg(F.count(F.lit(1)).alias("patient_count"), _rate(1).alias("readmission_rate"))
              .orderBy("age_group", "income_level"))


def diagnosis_by_region(df: DataFrame) -> DataFrame:
    return (df.groupBy("hospital_region", "primary_diagnosis")
              .agg(F.count(F.lit(1)).alias("case_count"), ravg(F.col("total_bill_amount"), 2, 0).alias("avg_cost"))
              .orderBy("hospital_region", F.col("case_count").desc()))


def revenue_pivot_by_month(df: DataFrame, months=(1, 2, 3),
                           names=("jan_revenue", "feb_revenue", "mar_revenue")) -> DataFrame:
    """Rows = payer, one revenue column per month (pivot with the month list
    given, so Spark needs no extra pass to find the values)."""
    p = (df.withColumn("_m", F.month("admission_date"))
           .groupBy("insurance_type").pivot("_m", list(months)).agg(F.sum(F.col("total_bill_amount"))))
    return p.select("insurance_type", *[money(F.col(str(m))).alias(n) for m, n in zip(months, names)])


def wealth_health(df: DataFrame) -> DataFrame:
    i = F.col("household_income")
    rich, poor = FX.WEALTH_BOUNDS
    cls = F.when(i > rich, FX.WEALTH[0]).when(i < poor, FX.WEALTH[1]).otherwise(FX.WEALTH[2])
    c = F.col("comorbidity_score")
    return (df.groupBy(cls.alias("income_class"))
              .agg(rdiv(F.sum(c), F.count(c), 2).alias("avg_sickness_score"),
                   rdiv(F.sum("age"), F.count("age"), 0).alias("avg_age"))
              .orderBy(F.col("avg_sickness_score").desc()))


def complex_chronic(df: DataFrame, pattern: str = "%Hypertension%", min_comorbidity: int = 3) -> DataFrame:
    return (df.filter(F.col("primary_diagnosis").like(pattern) & (F.col("comorbidity_score") >= min_comorbidity))
              .agg(F.count(F.lit(1)).alias("complex_patients"), ravg(F.col("total_bill_amount"), 2, 0).alias("avg_cost")))


def multi_diagnosis_patients(df: DataFrame) -> DataFrame:
    return (df.groupBy("patient_key", "patient_id")
              .agg(F.count_distinct("primary_diagnosis").alias("unique_conditions"))
              .filter(F.col("unique_conditions") > 1)
              .drop("patient_key")
              .orderBy(F.col("unique_conditions").desc()))


def revenue_per_day(df: DataFrame) -> DataFrame:
    """Average bill, average stay and their ratio per diagnosis; the stay is
    derived from the dates (the table has no length_of_stay column)."""
    los = X.length_of_stay()
    s_b, n_b = scaled_sum(F.col("total_bill_amount"), 2), F.count(F.col("total_bill_amount"))
    s_l, n_l = F.sum(los), F.count(los)
    return (df.groupBy("primary_diagnosis")
              .agg(ravg(F.col("total_bill_amount"), 2, 0).alias("revenue"),
                   rdiv(s_l, n_l, 1).alias("days"),
                   rdiv(s_b * n_l, n_b * s_l * 100, 0).alias("rev_per_day"))
              .orderBy(F.col("rev_per_day").desc()))


def _revenue_by_diagnosis(df: DataFrame) -> DataFrame:
    g = (df.filter(F.col("total_bill_amount").isNotNull()).groupBy("primary_diagnosis")
           .agg(F.count(F.lit(1)).alias("case_count"),
                F.sum(F.col("total_bill_amount")).alias("_rev"),
                ravg(F.col("total_bill_amount"), 2, 0).alias("avg_revenue_per_case")))
    total_cents = F.sum(F.col("_rev") * 100).over(Window.partitionBy())
    # share in whole hundredths of a percent, exact
    return g.withColumn("_pct_h", rdiv(F.col("_rev") * 100 * 10000, total_cents, 0))


def revenue_by_diagnosis(df: DataFrame) -> DataFrame:
    g = _revenue_by_diagnosis(df)
    return (g.select("primary_diagnosis", "case_count", money(F.col("_rev")).alias("total_revenue"),
                     "avg_revenue_per_case", (F.col("_pct_h") / 100).alias("pct_of_total_revenue"))
             .orderBy(F.col("total_revenue").desc()))


def revenue_pareto(df: DataFrame, threshold: float = 80.0) -> DataFrame:
    """Diagnoses, by revenue, while the running share stays within ``threshold``
    percent (the running sum uses the default RANGE frame: ties share)."""
    g = _revenue_by_diagnosis(df)
    w = Window.orderBy(F.col("_rev").desc())  # one row per diagnosis: bounded
    out = (g.withColumn("_cum_h", F.sum("_pct_h").over(w))
             .select("primary_diagnosis", "case_count", money(F.col("_rev")).alias("total_revenue"),
                     "avg_revenue_per_case", (F.col("_pct_h") / 100).alias("pct_of_total_revenue"),
                     (F.col("_cum_h") / 100).alias("cumulative_pct")))
    return out.filter(F.col("cumulative_pct") <= threshold)


def executive_dashboard(df: DataFrame, wide: bool = False) -> DataFrame:
    """One row of headline numbers, from a two-level aggregate and no join:
    per diagnosis (partial, map-side) the counts and sums, then over those
    few rows the totals and the most frequent diagnosis (``min_by`` over
    (-count, name): ties go to the first name)."""
    bill, flag = F.col("total_bill_amount"), F.col("readmitted_30_days")
    icu, los = F.col("icu_utilization_ratio"), X.length_of_stay()
    per = df.groupBy("primary_diagnosis").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(bill).alias("_rev"),
        F.sum(flag).alias("_flag"), F.count(flag).alias("_nflag"),
        F.sum((icu * 10000).cast("decimal(18,0)")).alias("_icu"), F.count(icu).alias("_nicu"),
        F.sum(los).alias("_los"), F.count(los).alias("_nlos"))
    n_flag = F.sum("_nflag")
    aggs = [money(F.sum("_rev")).alias("total_revenue"),
            F.sum("_n").alias("total_patients"),
            rdiv(F.sum("_flag") * 100, n_flag, 2).alias("readmission_pct")]
    if wide:
        aggs += [rdiv(F.sum("_icu") * 100, F.sum("_nicu") * 10000, 2).alias("icu_utilization_pct"),
                 rdiv(F.sum("_los"), F.sum("_nlos"), 1).alias("avg_los")]
    aggs.append(F.min_by("primary_diagnosis", F.struct(-F.col("_n"), F.col("primary_diagnosis"))).alias("top_driver"))
    return per.agg(*aggs)
