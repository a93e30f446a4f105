"""Risk scoring.  Scores are column expressions: one Project in
whole-stage codegen, no Python."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from ..functions import fixed as FX
from ..functions.numeric import money

VIEW_NAME = "v_high_risk_patients"


def lace_view(df: DataFrame, register_view: bool = True) -> DataFrame:
    """Capped LACE and its tier per admission; also registered as a temp view."""
    score = X.lace_capped().cast("bigint")
    out = df.select("patient_id", "primary_diagnosis",
                    money(F.col("total_bill_amount")).alias("total_bill_amount"),
                    score.alias("lace_score"), X.lace_risk(score).alias("risk_category"))
    if register_view:
        out.createOrReplaceTempView(VIEW_NAME)
    return out


def lace_score(df: DataFrame) -> DataFrame:
    """The scalar LACE function applied to every admission."""
    return df.select("id", "patient_id", X.lace_uncapped().cast("bigint").alias("lace_score"))


def lace_score_sql(df: DataFrame) -> DataFrame:
    """The same through the SQL function ``calculate_lace``."""
    register_sql_functions(df.sparkSession)
    return df.selectExpr("id", "patient_id", """CAST(calculate_lace(
        datediff(discharge_date, admission_date), admission_type = 'Emergency', comorbidity_score,
        previous_admissions_12m) AS BIGINT) AS lace_score""")


def _predictive_score():
    w = FX.RISK_WEIGHTS
    return (F.when(F.col("age") > 70, w["age_over_70"]).otherwise(0)
            + F.when(F.col("primary_diagnosis").like("%Heart Failure%"), w["heart_failure"]).otherwise(0)
            + F.when(F.col("admission_type") == "Emergency", w["emergency"]).otherwise(0)
            + F.when(X.lace_uncapped() > 10, w["lace_over_10"]).otherwise(0)
            + F.coalesce(F.col("comorbidity_score"), F.lit(0)) * w["per_comorbidity"])


def _predictive_tier(s):
    return X.ladder(s, ">=", FX.RISK_TIERS, FX.RISK_TIERS_ELSE)


def predictive_risk(df: DataFrame) -> DataFrame:
    s = _predictive_score().cast("bigint")
    return (df.select("patient_id", "age", "primary_diagnosis", s.alias("predictive_risk_score"))
              .withColumn("risk_category", _predictive_tier(F.col("predictive_risk_score")))
              .orderBy(F.col("predictive_risk_score").desc()))


def _risk_ladder():
    c, m, a = F.col("comorbidity_score"), F.col("missed_medications"), F.col("age")
    critical, high, moderate, low = FX.RISK_LADDER
    return (F.when((c > 10) & (m > 3), critical)
             .when((c > 7) | (m > 2), high)
             .when((c > 3) | (a > 75), moderate)
             .otherwise(low))


def risk_category(df: DataFrame) -> DataFrame:
    return (df.filter(F.col("readmitted_30_days") == 1)
              .select("patient_id", "age", "comorbidity_score", "missed_medications", "readmitted_30_days",
                      _risk_ladder().alias("risk_category"))
              .orderBy(F.col("comorbidity_score").desc_nulls_first(), F.col("missed_medications").desc()))


def _validate(tiers: DataFrame, count_name: str) -> DataFrame:
    flag = F.col("readmitted_30_days")
    return tiers.groupBy("risk_category").agg(
        F.count(F.lit(1)).alias(count_name),
        F.sum(flag).cast("bigint").alias("readmissions"),
        (F.sum(flag) / F.count(flag) * 100).alias("readmission_rate"))


def risk_validation(df: DataFrame) -> DataFrame:
    """Per tier of the rule ladder (over the readmitted rows it lists)."""
    tiers = df.filter(F.col("readmitted_30_days") == 1).select(
        "readmitted_30_days", _risk_ladder().alias("risk_category"))
    return _validate(tiers, "total")


def risk_validation_predictive(df: DataFrame) -> DataFrame:
    """Per tier of the weighted score, over all admissions."""
    tiers = df.select("readmitted_30_days", _predictive_tier(_predictive_score()).alias("risk_category"))
    return _validate(tiers, "patients")


def young_high_risk(df: DataFrame, max_age: int = 40, min_comorbidity: int = 4) -> DataFrame:
    return (df.filter((F.col("age") < max_age) & (F.col("comorbidity_score") > min_comorbidity))
              .select("patient_id", "age", "primary_diagnosis", "comorbidity_score")
              .orderBy(F.col("comorbidity_score").desc()))


def high_risk_list(df: DataFrame) -> DataFrame:
    return (df.filter((F.col("comorbidity_score") > 10) & (F.col("missed_medications") > 3))
              .select("patient_id", "age", "comorbidity_score", "primary_diagnosis", "missed_medications")
              .orderBy(F.col("comorbidity_score").desc()))


def register_sql_functions(spark) -> None:
    """Make the scalar LACE function callable from SQL, as in the reference:
    a SQL function (Spark 4+), inlined by the analyzer into the query plan,
    so it stays in whole-stage codegen like ``expr.calculate_lace``."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION calculate_lace(
            len_stay INT, is_emergency BOOLEAN, comorb_score INT, ed_visits INT)
        RETURNS INT
        RETURN CASE WHEN len_stay >= 14 THEN 7 WHEN len_stay >= 7 THEN 5 ELSE len_stay END
               + CASE WHEN is_emergency THEN 3 ELSE 0 END + comorb_score + ed_visits""")
