"""Unit tests on hand-made rows for the reference's traps
and the small goldens of FIXTURES.md."""

import datetime as dt

from pyspark.sql import functions as F

from admitlab.functions import expr as X
from admitlab.functions.numeric import rdiv
from admitlab.plans import changes, quality, relate, semi
from admitlab.plans.intervals import care_episodes, with_gaps


def test_pg_initcap(spark):
    df = spark.createDataFrame([("self-PAY",), ("  PRIVATE ",), ("medicaid",), ("",)], "x string")
    got = [r[0] for r in df.select(X.pg_initcap(F.trim("x"))).collect()]
    assert got == ["Self-Pay", "Private", "Medicaid", ""]


def test_exact_rounding_half_away_from_zero(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (1, 3), (2, 3), (7, 0), (-1, 3)], "n long, d long")
    got = [r[0] for r in df.select(rdiv(F.col("n"), F.col("d"), 0)).collect()]
    assert got == [3.0, -3.0, 0.0, 1.0, None, 0.0]
    assert all(v is None or str(v) != "-0.0" for v in got)
    got2 = [r[0] for r in df.select(rdiv(F.col("n"), F.col("d"), 2)).collect()]
    assert got2[:4] == [2.5, -2.5, 0.33, 0.67]


def _enc(spark, rows):
    schema = ("id long, patient_key long, patient_id string, admission_date date, discharge_date date, "
              "admission_type string, comorbidity_score int, previous_admissions_12m int")
    return spark.createDataFrame(rows, schema)


def test_lace_null_comorbidity(spark):
    d = dt.date(2020, 1, 1)
    df = _enc(spark, [(1, 1, "P1", d, d + dt.timedelta(days=9), "Emergency", None, 6),
                      (2, 1, "P1", d, d + dt.timedelta(days=15), "Elective", 2, 1)])
    r = df.select(X.lace_capped().alias("c"), X.lace_uncapped().alias("u")).collect()
    # view: L capped 7 + A 3 + C (NULL skipped by least -> 5) + E capped 4
    assert r[0]["c"] == 7 + 3 + 5 + 4 and r[0]["u"] is None
    # function: 15 days -> 7 points, no caps on C and E
    assert r[1]["u"] == 7 + 0 + 2 + 1


def test_gap_edges_and_episodes(spark):
    d = dt.date(2020, 1, 1)
    rows = [(1, 1, "P1", d, d + dt.timedelta(days=2), "E", 0, 0),
            (2, 1, "P1", d + dt.timedelta(days=3), d + dt.timedelta(days=4), "E", 0, 0),    # gap 1: same episode
            (3, 1, "P1", d + dt.timedelta(days=11), d + dt.timedelta(days=12), "E", 0, 0),  # gap 7
            (4, 1, "P1", d + dt.timedelta(days=26), d + dt.timedelta(days=27), "E", 0, 0),  # gap 14
            (5, 1, "P1", d + dt.timedelta(days=24), d + dt.timedelta(days=30), "E", 0, 0)]  # overlap
    g = {r["id"]: r["days_gap"] for r in with_gaps(_enc(spark, rows)).collect()}
    assert g == {1: None, 2: 1, 3: 7, 5: 12, 4: -4}
    tiers = [r[0] for r in spark.createDataFrame([(7,), (8,), (14,), (15,), (30,), (31,)], "g long")
             .select(X.gap_tier4(F.col("g"))).collect()]
    assert tiers == ["≤7 days (Critical)", "8-14 days (High Risk)", "8-14 days (High Risk)",
                     "15-30 days (Moderate)", "15-30 days (Moderate)", ">30 days (Low Risk)"]
    ep = {r["admission_date"]: r["episode_id"] for r in care_episodes(_enc(spark, rows)).collect()}
    assert ep[d] == 1 and ep[d + dt.timedelta(days=3)] == 1 and ep[d + dt.timedelta(days=11)] == 2


def test_income_tier_edges(spark):
    df = spark.createDataFrame([(39999.99,), (40000.0,), (79999.99,), (80000.0,), (None,)], "household_income double")
    got = [r[0] for r in df.select(X.income_tier()).collect()]
    # an unknown income falls to the ELSE branch, as in the reference
    assert got == ["Low Income", "Middle Income", "Middle Income", "High Income", "High Income"]


def _doctors(spark, pairs):
    return spark.createDataFrame([(d, f"n{d}", "s", up) for d, up in pairs],
                                 "doctor_id long, name string, specialty string, referred_by_id long")


def test_referral_chain_of_a_side_branch(spark):
    docs = _doctors(spark, [(50, None), (41, 50), (33, 41), (34, 41), (20, 33), (21, 34), (12, 20), (77, 50), (13, 999)])
    got = sorted((r["level"], r["doctor_id"]) for r in relate.referral_chain(docs, 12).collect())
    assert got == [(1, 12), (2, 20), (3, 33), (4, 41), (5, 50)]
    assert [r["doctor_id"] for r in relate.referral_chain(docs, 13).collect()] == [13]


def test_long_chain_is_walked_whole(spark):
    docs = _doctors(spark, [(i, i - 1 if i else None) for i in range(150)])
    got = relate.referral_chain(docs, 149).collect()
    assert len(got) == 150 and max(r["level"] for r in got) == 150


def test_referral_chain_cycle_terminates(spark):
    docs = spark.createDataFrame([(1, "A", "s", 2), (2, "B", "s", 3), (3, "C", "s", 1)],
                                 "doctor_id long, name string, specialty string, referred_by_id long")
    got = sorted(r["doctor_id"] for r in relate.referral_chain(docs, 1).collect())
    assert got == [1, 2, 3]


def test_json_filter_skips_what_is_no_number(spark):
    logs = spark.createDataFrame(
        [("a", '{"spo2": 91, "pain": 3}'), ("b", '{"spo2": "96.5"}'), ("c", '{"spo2": 97, "note": "ok"}'), ("d", '{"pain": 9}'),
         ("e", '{"spo2": null}'), ("f", '{"spo2": "high"}'), ("g", "not json"), ("h", None)], "patient_id string, vitals string")
    got = sorted((r[0], r[1]) for r in semi.json_filter(logs, "spo2", 95).collect())
    assert got == [("b", "96.5"), ("c", "97")]


def test_unnest_counts_repeats_and_blanks(spark):
    s = spark.createDataFrame([("x,y,x",), ("y",), ("",), (None,), ("z, y",)], "diagnosis_list string")
    got = {r[0]: r[1] for r in semi.unnest_counts(s).collect()}
    assert got == {"x": 2, "y": 2, " y": 1, "z": 1, "": 1}


def test_ids_of_more_than_seven_digits_stay_apart(spark):
    from admitlab.sources.tables import patient_id_of
    keys = spark.createDataFrame([(1000000,), (10000001,), (7,)], "k long")
    assert [r[0] for r in keys.select(patient_id_of(F.col("k"))).collect()] == ["PAT1000000", "PAT10000001", "PAT0000007"]
    enc = spark.createDataFrame([(1, 1000000, "PAT1000000"), (2, 10000001, "PAT10000001")],
                                "id long, patient_key long, patient_id string")
    listed = spark.createDataFrame([(1000000, "PAT1000000")], "patient_key long, customer_id string")
    assert [r["id"] for r in relate.delinquent_in(enc, listed).collect()] == [1]
    assert [r["id"] for r in relate.delinquent_exists(enc, listed).collect()] == [1]
    assert [r["id"] for r in relate.patient_lookup(enc, "PAT10000001").collect()] == [2]


def test_dedupe_keeps_the_lowest_id_of_null_groups(spark):
    d = dt.date(2020, 1, 1)
    df = spark.createDataFrame([(1, 1, d), (2, 1, d), (4, 1, None), (3, 1, None), (6, None, d), (5, None, d)],
                               "id long, patient_key long, admission_date date")
    got = quality.drop_duplicate_encounters(df)
    assert got.columns == df.columns and sorted(r["id"] for r in got.collect()) == [1, 3, 5]


def test_two_requests_for_a_patient_do_not_double_rows(spark):
    d = dt.date(2020, 1, 1)
    enc = spark.createDataFrame([(1, 1, d, d, "Home"), (2, 2, d, d, "AMA")],
                                "id long, patient_key long, admission_date date, discharge_date date, discharge_disposition string")
    req = spark.createDataFrame([(1, "SNF"), (1, "Home Health")], "patient_key long, disposition string")
    got = {r["id"]: (r["discharge_date"], r["discharge_disposition"]) for r in changes.discharge_patients(enc, req).collect()}
    assert got == {1: (d + dt.timedelta(days=5), "Home Health"), 2: (d, "AMA")}


def test_earlier_version_of_a_stored_view_stays_readable(spark):
    from admitlab.plans.registry import jobs
    from sf_dirs import SF_MID, SF_SMALL
    first = jobs()["regional_stats"](spark, SF_SMALL)
    n = first.count()
    jobs()["regional_stats"](spark, SF_MID).count()
    assert first.count() == n


def test_checkpoints_need_a_shared_folder_on_a_cluster(spark):
    from types import SimpleNamespace as N

    import pytest
    from admitlab.session import ensure_checkpoint_dir
    far = N(sparkContext=N(getCheckpointDir=lambda: None, master="yarn"), conf=N(get=lambda k, d: d))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(far)


def test_audit_self_empty_and_dedupe_idempotent(spark):
    d = dt.date(2020, 1, 1)
    df = spark.createDataFrame([(1, 1, "P1", d, 10.0), (2, 1, "P1", d, 11.0), (3, 2, "P2", d, None)],
                               "id long, patient_key long, patient_id string, admission_date date, total_bill_amount double")
    assert changes.bill_audit(df, df).count() == 0
    once = quality.drop_duplicate_encounters(df)
    twice = quality.drop_duplicate_encounters(once)
    assert sorted(r["id"] for r in once.collect()) == [1, 3]
    assert sorted(r["id"] for r in twice.collect()) == [1, 3]


def test_zscore_degenerate(spark):
    from admitlab.plans.windows import bill_zscore
    one = spark.createDataFrame([(1, "P1", 100.0)], "id long, patient_id string, total_bill_amount double")
    same = spark.createDataFrame([(1, "P1", 100.0), (2, "P2", 100.0)], "id long, patient_id string, total_bill_amount double")
    for df in (one, same):
        rows = bill_zscore(df).collect()
        assert all(r["z_score"] is None and r["outlier_status"] == "Normal Range" for r in rows)


def test_zscore_sums_beyond_64_bits(spark):
    """The squares of 100 bills of about 9 billion exceed 64 bits by far."""
    import statistics

    from admitlab.plans.windows import bill_zscore
    bills = [9_000_000_000 + k * 1_000_000 for k in range(100)]
    df = spark.createDataFrame([(k, f"P{k}", float(b)) for k, b in enumerate(bills)],
                               "id long, patient_id string, total_bill_amount double") \
        .withColumn("total_bill_amount", F.col("total_bill_amount").cast("decimal(12,2)"))
    assert sum((b * 100) ** 2 for b in bills) > 2 ** 63
    rows = bill_zscore(df).collect()
    mean, sd = statistics.fmean(bills), statistics.stdev(bills)
    assert len(rows) == 100
    assert {r["population_mean"] for r in rows} == {mean}
    assert all(abs(r["standard_deviation"] / sd - 1) < 1e-6 for r in rows)
    assert {r["patient_id"]: r["z_score"] for r in rows} == {f"P{k}": round((b - mean) / sd, 2) for k, b in enumerate(bills)}


def test_gap_distribution_adds_up(spark):
    from admitlab.plans import intervals
    from admitlab.sources.tables import encounters
    from sf_dirs import SF_SMALL
    enc = encounters(spark, SF_SMALL)
    gaps = intervals.with_gaps(enc).filter(F.col("days_gap").isNotNull()).count()
    for f in (intervals.gap_distribution_4, intervals.gap_distribution_5):
        assert f(enc).agg(F.sum("patient_count")).first()[0] == gaps


def test_append_log(spark, tmp_path):
    d = dt.date(2020, 1, 1)
    old = spark.createDataFrame([(1, 1, "P1", d, 10.0), (2, 2, "P2", d, 11.0)],
                                "id long, patient_key long, patient_id string, admission_date date, total_bill_amount double")
    new = old.withColumn("total_bill_amount", F.when(F.col("id") == 1, 12.0).otherwise(F.col("total_bill_amount")))
    path = str(tmp_path / "log")
    changes.append_log(changes.bill_audit(old, new), path)
    changes.append_log(changes.bill_audit(old, new), path)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 2 and {(r["old_amount"], r["new_amount"]) for r in rows} == {(10.0, 12.0)}


def test_referral_chain_sql_equals_loop(spark):
    from admitlab.sources.tables import referral_tree
    from sf_dirs import SF_SMALL
    tree = referral_tree(spark, SF_SMALL)
    a = sorted(tuple(r) for r in relate.referral_chain(tree, 137).collect())
    b = sorted(tuple(r) for r in relate.referral_chain_sql(tree, 137).collect())
    assert a == b and [r[0] for r in sorted(a, key=lambda t: t[-1])] == [137, 68, 34, 17, 8, 4, 2, 1, 0]


def test_sql_lace_function_equals_expression(spark):
    from admitlab.plans import risk
    from admitlab.sources.tables import encounters
    from sf_dirs import SF_SMALL
    risk.register_sql_functions(spark)
    enc = encounters(spark, SF_SMALL)
    enc.createOrReplaceTempView("enc_for_lace")
    sql = spark.sql("""SELECT id, calculate_lace(datediff(discharge_date, admission_date),
                              admission_type = 'Emergency', comorbidity_score, previous_admissions_12m) AS s
                       FROM enc_for_lace""")
    a = {r["id"]: r["s"] for r in sql.collect()}
    b = {r["id"]: r["lace_score"] for r in risk.lace_score(enc).collect()}
    assert a == b and any(v is None for v in a.values())


def test_to_char_padding(spark):
    from admitlab.plans import timeline
    df = spark.createDataFrame([(dt.date(2021, 5, 3), 1)], "admission_date date, readmitted_30_days int")
    assert timeline.seasonal_months(df, pad=True).first()["month_name"] == "May      "
    assert timeline.day_of_week_effect(df, pad=True).first()["day_of_week"] == "Monday   "
    assert timeline.seasonal_months(df).first()["month_name"] == "May"


def test_roots_by_pointer_doubling(spark):
    from admitlab.operators.closure import roots, walk_up
    from admitlab.sources.tables import referral_tree
    from sf_dirs import SF_SMALL
    tree = referral_tree(spark, SF_SMALL)
    got = {r["doctor_id"]: (r["root"], r["depth"]) for r in roots(tree, "doctor_id", "referred_by_id").collect()}
    assert len(got) == tree.count()
    for start in (0, 1, 137, 199):
        chain = walk_up(tree, tree.filter(F.col("doctor_id") == start), "doctor_id", "referred_by_id").collect()
        top = max(chain, key=lambda r: r["level"])
        assert got[start] == (top["doctor_id"], top["level"] - 1)
    cyc = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 1), (4, None)], "doctor_id long, referred_by_id long")
    got2 = {r["doctor_id"]: (r["root"], r["depth"]) for r in roots(cyc, "doctor_id", "referred_by_id").collect()}
    assert got2[4] == (4, 0) and all(got2[i] == (None, None) for i in (1, 2, 3, 5))
