"""Physical plans have the shape the design relies on."""

from admitlab.plans.registry import jobs
from sf_dirs import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_pushes_key_into_scan(spark):
    p = _plan(jobs()["patient_lookup"](spark, SF_SMALL))
    assert "EqualTo(o_custkey,500)" in p


def test_column_pruning(spark):
    df = jobs()["readmission_rate"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in p and "o_orderdate" not in p


def test_flagship_single_exchange(spark):
    p = _plan(jobs()["frequent_flyers"](spark, SF_SMALL))
    assert p.count("hashpartitioning") == 1


def test_top_k_per_group_uses_group_limit(spark):
    df = jobs()["top_bills_per_diagnosis"](spark, SF_SMALL)
    assert "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString()


def test_global_ntile_is_bucketed(spark):
    p = _plan(jobs()["cost_ntiles"](spark, SF_SMALL))
    assert "hashpartitioning(_tid" in p or "hashpartitioning(_b1" in p  # by range, not one task


def test_bucketed_encounters_need_no_exchange(spark):
    from admitlab.plans import intervals
    from admitlab.sources.tables import encounters, save_encounters
    stored = save_encounters(encounters(spark, SF_SMALL), "enc_bucketed_test", 8)
    p = _plan(intervals.frequent_flyers(stored))
    assert "Exchange hashpartitioning" not in p
    assert intervals.frequent_flyers(stored).count() == 10


def test_jobs_on_order_columns_read_only_orders(spark):
    for key in ("row_count", "date_range", "length_of_stay", "readmission_rate", "top_diagnoses", "frequent_flyers"):
        p = _plan(jobs()[key](spark, SF_SMALL))
        assert "c_custkey" not in p and "r_name" not in p and "Join" not in p, key


def test_column_profile_is_one_scan(spark):
    plan = jobs()["column_profile"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation" in line and "o_orderkey" in line for line in plan.splitlines()) == 1


def test_order_plan_does_not_grow_with_hot_values(spark):
    from admitlab.operators.order import OrderSpec, ordered, plan_order
    from pyspark.sql import functions as F
    from pyspark.sql.window import Window
    # a third of the rows share one value, so it is hot at either number of ranges
    df = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 700).alias("v"))
    sizes = []
    for ranges in (50, 5000):
        plan = plan_order(df, OrderSpec("v"), n_buckets=ranges)
        out = ordered(df, OrderSpec("v"), plan=plan)
        sizes.append(len(out._jdf.queryExecution().optimizedPlan().toString().splitlines()))
        want = df.withColumn("_rn", F.row_number().over(Window.orderBy("v", "id")))
        assert out.select("id", "v", "_rn").exceptAll(want).isEmpty()
        hot = len(plan.hot_info)
        assert hot == 1 if ranges == 50 else hot > 600
    assert sizes[0] == sizes[1]
