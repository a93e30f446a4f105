"""Pure column expressions shared by the jobs: tiers, brackets, LACE scores,
PostgreSQL-style initcap."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed as FX

_OPS = {"<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}


def ladder(c: Column, op: str, steps, default=None, start: Column | None = None) -> Column:
    """CASE WHEN c <op> bound THEN label ... [ELSE default] END, branches in
    the given order (after those already in ``start``)."""
    out = start
    for bound, label in steps:
        cond = _OPS[op](c, F.lit(bound))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out if default is None else out.otherwise(default)


def length_of_stay() -> Column:
    return F.datediff(F.col("discharge_date"), F.col("admission_date"))


def pg_initcap(c: Column) -> Column:
    """INITCAP as PostgreSQL does it: a word starts after any non-alphanumeric
    character ('self-PAY' -> 'Self-Pay'), other letters lowered."""
    parts = F.split(F.lower(c), r"(?<=[^a-z0-9])")
    return F.array_join(
        F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))),
        "")


def age_bracket(young_label: str = FX.AGE_YOUNG_LABELS[0]) -> Column:
    a = F.col("age")
    return (F.when(a < 30, young_label)
             .when(a.between(30, 60), FX.AGE_MIDDLE)
             .when(a > 60, FX.AGE_SENIOR)
             .otherwise(FX.AGE_UNKNOWN))


def income_tier() -> Column:
    return ladder(F.col("household_income"), "<", FX.INCOME_TIERS, FX.INCOME_TIER_ELSE)


def lace_capped() -> Column:
    """LACE as the view computes it: L capped at 7, A 3 if Emergency, C capped at 5,
    E capped at 4.  ``least`` skips NULL, so an unknown comorbidity counts 5."""
    return (F.least(length_of_stay(), F.lit(7))
            + F.when(F.col("admission_type") == "Emergency", 3).otherwise(0)
            + F.least(F.col("comorbidity_score"), F.lit(5))
            + F.least(F.col("previous_admissions_12m"), F.lit(4)))


def lace_risk(score: Column) -> Column:
    return ladder(score, ">", FX.LACE_RISK, FX.LACE_RISK_ELSE)


def calculate_lace(len_stay: Column, is_emergency: Column, comorb: Column, ed_visits: Column) -> Column:
    """The scalar LACE function: 7 points from 14 days, 5 from 7 days, else the
    days; 3 for an emergency; comorbidity and ED visits added uncapped (NULL
    propagates)."""
    l_pts = F.when(len_stay >= 14, 7).when(len_stay >= 7, 5).otherwise(len_stay)
    return l_pts + F.when(is_emergency, 3).otherwise(0) + comorb + ed_visits


def lace_uncapped() -> Column:
    return calculate_lace(length_of_stay(), F.col("admission_type") == "Emergency",
                          F.col("comorbidity_score"), F.col("previous_admissions_12m"))


def gap_tier4(g: Column) -> Column:
    """Four tiers; a NULL gap has none (no ELSE branch)."""
    over = FX.GAP_TIERS_4[-1][0]
    return ladder(g, "<=", FX.GAP_TIERS_4).when(g > over, FX.GAP_TIERS_4_OVER)


def gap_tier4_labels() -> list:
    return [label for _, label in FX.GAP_TIERS_4] + [FX.GAP_TIERS_4_OVER]


def gap_tier5(g: Column) -> Column:
    return ladder(g, "<=", FX.GAP_TIERS_5, FX.GAP_TIERS_5_ELSE)


def gap_tier5_labels() -> list:
    return [label for _, label in FX.GAP_TIERS_5] + [FX.GAP_TIERS_5_ELSE]


def gap_risk_level(g: Column) -> Column:
    """Tier tested before the first-visit check (a NULL gap falls through)."""
    return ladder(g, "<=", FX.GAP_RISK).when(g.isNull(), FX.GAP_FIRST_VISIT).otherwise(FX.GAP_RISK_ELSE)


def gap_risk_category(g: Column) -> Column:
    """First-visit check before the tiers."""
    return ladder(g, "<=", FX.GAP_RISK, FX.GAP_RISK_ELSE, start=F.when(g.isNull(), FX.GAP_FIRST_VISIT))


def order_of(c: Column, labels: list) -> Column:
    """1-based position of the label in ``labels`` (an explicit sort key)."""
    out = None
    for i, label in enumerate(labels):
        out = F.when(c == label, i + 1) if out is None else out.when(c == label, i + 1)
    return out.cast("int")
