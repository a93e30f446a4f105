"""Financial risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import money, rdiv


def _ratio():
    return (F.col("total_bill_amount").cast("double")
            / F.nullif(F.col("household_income"), F.lit(0)).cast("double"))


def debt_ratio(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return (df.select("patient_id", money(F.col("household_income")).alias("household_income"),
                      money(F.col("total_bill_amount")).alias("total_bill_amount"),
                      _ratio().alias("debt_ratio"))
              .filter(F.col("debt_ratio") > threshold))


def debt_ratio_rounded(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The ratio rounded to a whole number before the test (a different filter)."""
    r = rdiv((F.col("total_bill_amount") * 100).cast("bigint"),
             (F.col("household_income") * 100).cast("bigint"), 0)
    return (df.select("patient_id", money(F.col("household_income")).alias("household_income"),
                      money(F.col("total_bill_amount")).alias("total_bill_amount"), r.alias("debt_ratio"))
              .filter(F.col("debt_ratio") > threshold))


def _bad_debt_rows(df: DataFrame, payer: str, share: float):
    return df.filter((F.col("insurance_type") == payer)
                     & (F.col("total_bill_amount") > F.col("household_income") * F.lit(share)))


def bad_debt(df: DataFrame, payer: str = "Self-Pay", share: float = 0.20) -> DataFrame:
    return (_bad_debt_rows(df, payer, share)
            .select("patient_id", money(F.col("total_bill_amount")).alias("total_bill_amount"),
                    money(F.col("household_income")).alias("household_income"))
            .orderBy(F.col("total_bill_amount").desc()))


def bad_debt_exposure(df: DataFrame, payer: str = "Self-Pay", share: float = 0.20,
                      uncollectible_pct: int = 70) -> DataFrame:
    cents = F.sum((F.col("total_bill_amount") * 100).cast("decimal(18,0)"))
    return (_bad_debt_rows(df, payer, share)
            .agg(F.count(F.lit(1)).alias("at_risk_patients"),
                 money(F.sum("total_bill_amount")).alias("total_exposure"),
                 rdiv(cents * uncollectible_pct, F.lit(100 * 100), 4).alias("estimated_bad_debt")))
