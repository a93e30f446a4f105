"""Job registry: key -> callable(spark, sf_dir) -> DataFrame.

Each entry reads the driver's tables, derives the mapped inputs and runs one
job over the whole tables.  Parameters are the defaults documented in
FIXTURES.md (as_of date, regex pattern, start node, ...).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as FX
from ..operators import closure, matview
from ..session import ensure_checkpoint_dir
from ..sources import tables as T
from ..sources.parts import PartTable
from . import changes, finance, intervals, kpi, quality, relate, risk, semi, timeline, windows

Job = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2001, 8, 1)
REGEX = "heart|stroke"
REFERRAL_START = 137
JSON_THRESHOLD = 50
LOOKUP_PATIENT = "PAT0000500"

#: Jobs that use income, payer or region, or every column.  All others read
#: the columns of ``orders`` and join neither customer nor geography.
ALL_COLUMNS = {
    "column_profile", "table_scan", "table_sample", "impute_income", "standardize_labels", "impute_multi",
    "drop_duplicate_encounters", "missing_counts", "category_profile", "numeric_ranges", "payer_mix",
    "rate_by_income_tier", "insured_vs_uninsured", "payer_price_gap", "revenue_by_region", "payer_profitability",
    "age_income_crosstab", "diagnosis_by_region", "revenue_pivot_by_month", "wealth_health", "debt_ratio",
    "debt_ratio_rounded", "bad_debt", "bad_debt_exposure", "patient_lookup", "json_patients_by_payer", "json_patient_lists",
    "regex_match",
    "scale_income_by_payer",
}

_REGISTRY: dict[str, Job] = {}


def _enc_job(fn, **params) -> Job:
    source = T.encounters if fn.__name__ in ALL_COLUMNS else T.admissions

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(source(spark, sf_dir), **params)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def register(key: str, job: Job) -> None:
    if key in _REGISTRY:
        raise KeyError(f"duplicate job key {key}")
    _REGISTRY[key] = job


def _regional_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materialised view: bring the stored view of these tables up to date (only
    order files that are new or changed are read) and re-read it by its name."""
    root, view = _views_root(spark), regional_view(spark, sf_dir)
    others = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("customer", "nation", "region")]
    matview.refresh(spark, root, view, f"{sf_dir.rstrip('/')}/orders.parquet", others)
    return matview.read_view(spark, root, view.name)


def regional_view(spark: SparkSession, sf_dir: str) -> matview.View:
    """One stored view per folder of tables."""
    name = "regional_stats-" + hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:16]
    return kpi.regional_view(name, lambda orders: T.encounters_from(orders, spark, sf_dir, ("_part",)))


def _views_root(spark: SparkSession) -> str:
    """Stored views outlive a session, so they are kept below the shared folder
    itself and not below the session's own part of it."""
    own = ensure_checkpoint_dir(spark)
    shared = spark.conf.get("spark.checkpoint.dir", None) or own.rstrip("/").rsplit("/", 1)[0]
    return f"{shared.rstrip('/')}/views"


def _hot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``diagnosis_history`` with patients above a thousandth of the visits on the
    path of hot patients (at most a thousand of them), in parts of 8 visits."""
    enc = T.admissions(spark, sf_dir)
    return semi.diagnosis_history(enc, chunk=8, max_rows=max(8, enc.count() // 1000))


def _shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


def _set_bill_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``set_bill`` on the stored table: only parts with such a patient are rewritten."""
    table = PartTable(_shared_path(spark, "encounter_parts"), 64)
    table.save(T.encounters(spark, sf_dir))
    table.change(_delinquent_requests(spark, sf_dir), changes.set_bill)
    return table.read(spark)


def _delinquent_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.delinquency(spark, sf_dir).select("patient_key", F.col("customer_id").alias("patient_id"),
                                               F.lit("Home Health").alias("disposition"))


def _register_all() -> None:
    for name in ["column_profile", "table_scan", "table_sample", "row_count", "impute_income",
                 "standardize_labels", "age_brackets", "length_of_stay", "impute_multi",
                 "threshold_outliers", "duplicate_encounters",
                 "missing_counts", "category_profile", "date_range", "numeric_ranges"]:
        register(name, _enc_job(getattr(quality, name)))
    for fn in (quality.drop_duplicate_encounters, quality.delete_duplicate_encounters):
        register(fn.__name__, lambda spark, d, fn=fn: fn(T.encounters(spark, d), T.admissions(spark, d)))
    register("age_brackets_rows", _enc_job(quality.age_brackets, descending=None, distinct=False))
    register("age_brackets_young_adult",
             _enc_job(quality.age_brackets, young_label=FX.AGE_YOUNG_LABELS[1], descending=False))
    for name in ["readmission_rate", "payer_mix", "gender_distribution", "los_distribution",
                 "top_diagnoses", "rate_by_income_tier", "insured_vs_uninsured", "payer_price_gap",
                 "rate_by_diagnosis", "revenue_by_region", "los_by_hospital_type",
                 "comorbidity_impact", "adherence_impact", "icu_impact", "payer_profitability",
                 "age_income_crosstab", "diagnosis_by_region", "revenue_pivot_by_month",
                 "wealth_health", "complex_chronic", "multi_diagnosis_patients", "revenue_per_day",
                 "revenue_by_diagnosis", "revenue_pareto", "executive_dashboard"]:
        register(name, _enc_job(getattr(kpi, name)))
    register("payer_market_share", _enc_job(kpi.payer_mix, digits=1, share_name="market_share"))
    register("executive_dashboard_wide", _enc_job(kpi.executive_dashboard, wide=True))
    register("regional_stats", _regional_stats)
    for name in ["visit_gap", "visit_gap_context", "visit_gap_risk", "revisit_detail",
                 "gap_distribution_4", "gap_distribution_5", "gap_by_diagnosis", "gap_percentiles",
                 "high_risk_share", "frequent_flyers", "case_management_targets",
                 "care_episodes"]:
        register(name, _enc_job(getattr(intervals, name)))
    # 2.4 windows
    for name in ["bill_rank", "top_bills_per_diagnosis", "los_outliers", "moving_avg_bill", "bill_deviation",
                 "bill_delta", "bill_trends", "monthly_cumulative", "running_total", "top_cost_percentiles",
                 "cost_ntiles", "quartile_summary", "spend_cdf", "cdf_threshold", "visit_sequence",
                 "pareto_top1", "top1_patients", "bill_zscore", "bill_spread", "patient_bill_share"]:
        register(name, _enc_job(getattr(windows, name)))
    register("running_total_range", _enc_job(windows.running_total, frame="range"))
    # 2.3 time
    for name in ["monthly_active", "cohort_retention", "day_of_week_effect", "weekend_mix",
                 "seasonal_months", "monthly_rate_change", "yoy_admissions", "moving_avg_daily"]:
        register(name, _enc_job(getattr(timeline, name)))
    register("yoy_admissions_dense", _enc_job(timeline.yoy_admissions, dense=True))
    register("moving_avg_daily_dense", _enc_job(timeline.moving_avg_daily, dense=True))
    register("churn_status", _enc_job(timeline.churn_status, as_of=AS_OF))
    # 2.6 risk, 2.7 finance
    for name in ["lace_view", "lace_score", "lace_score_sql", "predictive_risk", "risk_validation",
                 "risk_validation_predictive", "risk_category", "young_high_risk", "high_risk_list"]:
        register(name, _enc_job(getattr(risk, name)))
    for name in ["debt_ratio", "debt_ratio_rounded", "bad_debt", "bad_debt_exposure"]:
        register(name, _enc_job(getattr(finance, name)))
    # 2.8 joins
    register("delinquent_in", lambda spark, d: relate.delinquent_in(T.encounters(spark, d), T.delinquency(spark, d)))
    register("delinquent_exists",
             lambda spark, d: relate.delinquent_exists(T.encounters(spark, d), T.delinquency(spark, d)))
    register("diagnosis_pairs", _enc_job(relate.diagnosis_pairs))
    register("referral_chain",
             lambda spark, d: relate.referral_chain(T.referral_tree(spark, d), REFERRAL_START))
    # a batch of starts at once
    register("referral_chains", lambda spark, d: relate.referral_chains(
        T.referral_tree(spark, d), T.referral_tree(spark, d).where("doctor_id % 100 = 99").select(F.col("doctor_id").alias("start"))))
    register("referral_chain_sql",
             lambda spark, d: relate.referral_chain_sql(T.referral_tree(spark, d), REFERRAL_START))
    register("tree_roots", lambda spark, d: closure.roots(T.referral_tree(spark, d), "doctor_id", "referred_by_id"))
    register("bill_deviation_first", _enc_job(windows.bill_deviation, limit=50))
    register("patient_lookup", _enc_job(relate.patient_lookup, patient_id=LOOKUP_PATIENT))
    register("orphan_encounters", T.orphan_encounters)
    # 2.9 semi-structured
    register("json_filter", lambda spark, d: semi.json_filter(T.patient_logs(spark, d), "k", JSON_THRESHOLD))
    register("json_filter_variant",
             lambda spark, d: semi.json_filter_variant(T.patient_logs(spark, d), "k", JSON_THRESHOLD))
    register("unnest_counts", lambda spark, d: semi.unnest_counts(T.patient_surveys(spark, d)))
    for name in ["diagnosis_history", "diagnosis_positions", "unnest_history", "json_summary", "json_patients_by_payer",
                 "json_patient_lists", "json_profile"]:
        register(name, _enc_job(getattr(semi, name)))
    register("diagnosis_history_hot", _hot_history)
    register("regex_match", _enc_job(semi.regex_match, pattern=REGEX))
    # 2.10 table versions
    register("scale_income_by_payer", _enc_job(changes.scale_income_by_payer))
    register("discharge_patients",
             lambda spark, d: changes.discharge_patients(T.encounters(spark, d), _delinquent_requests(spark, d)))
    register("set_bill",
             lambda spark, d: changes.set_bill(T.encounters(spark, d), _delinquent_requests(spark, d)))

    register("set_bill_stored", _set_bill_stored)

    def _audit(null_safe):
        def run(spark, d):
            old = T.admissions(spark, d)
            return changes.bill_audit(old, changes.set_bill(old, _delinquent_requests(spark, d)), null_safe)
        return run
    register("bill_audit", _audit(False))
    register("bill_audit_null_safe", _audit(True))

    def _audit_log(spark, d):
        path = _shared_path(spark, "bill_audit_log")
        changes.append_log(_audit(False)(spark, d), path, AS_OF)
        return spark.read.parquet(path)
    register("bill_audit_log", _audit_log)


def jobs() -> dict[str, Job]:
    if not _REGISTRY:
        _register_all()
    return dict(_REGISTRY)
