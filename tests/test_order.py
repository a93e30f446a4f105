"""Bucketed global order equals Spark's own single-partition windows."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admitlab.operators.order import OrderSpec, moving_frame, ntile, ordered


def _data(spark, n, n_vals, null_frac, seed, hot=None):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if rnd.random() < null_frac:
            v = None
        elif hot is not None and rnd.random() < 0.4:
            v = hot
        else:
            v = rnd.randint(-n_vals, n_vals)
        rows.append((i * 3 + rnd.randint(0, 2), v, rnd.choice([None, rnd.randint(-50, 50)])))
    return spark.createDataFrame(rows, "id long, v long, x long")


CASES = [(400, 30, 0.1, 1, None), (300, 1000, 0.0, 1, None), (500, 5, 0.3, 3, 7),
         (250, 50, 0.45, 50, None), (5, 3, 0.2, 50, None), (600, 200, 0.05, 13, 0)]


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("desc", [False, True])
def test_matches_spark(spark, case, desc):
    n, n_vals, null_frac, buckets, hot = case
    df = _data(spark, n, n_vals, null_frac, n + buckets, hot)
    spec = OrderSpec("v", "id", descending=desc)
    # alternate the two placements of ranges on tasks
    got = ordered(df, spec, sums=("x",), n_buckets=buckets, dense=True)
    vo = F.col("v").desc_nulls_first() if desc else F.col("v").asc_nulls_last()
    w = Window.orderBy(vo, F.col("id"))
    wv = Window.orderBy(vo)
    ref = (df.withColumn("rn", F.row_number().over(w)).withColumn("rk", F.rank().over(wv))
             .withColumn("dr", F.dense_rank().over(wv)).withColumn("cd", F.cume_dist().over(wv))
             .withColumn("nt", F.ntile(7).over(w))
             .withColumn("sr", F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("sg", F.sum("x").over(wv)))
    g = {r["id"]: r for r in got.withColumn("nt", ntile(7, F.col("_rn"), F.col("_n"))).collect()}
    for r in ref.collect():
        o = g[r["id"]]
        assert o["_rn"] == r["rn"]
        assert o["_rank"] == r["rk"]
        assert o["_dense_rank"] == r["dr"]
        assert abs(o["_le"] / o["_n"] - r["cd"]) < 1e-12
        assert o["nt"] == r["nt"]
        assert o["_rows_x"] == r["sr"]
        assert o["_range_x"] == r["sg"]
    assert len(g) == n


@pytest.mark.parametrize("preceding,buckets", [(9, 7), (0, 5), (1, 60), (30, 300), (299, 4), (500, 4), (9, None)])
def test_moving_frame(spark, preceding, buckets):
    df = _data(spark, 300, 100, 0.1, 5)
    got = moving_frame(df, "id", ["v"], preceding, n_buckets=buckets)
    w = Window.orderBy("id").rowsBetween(-preceding, 0)
    ref = df.withColumn("s", F.sum("v").over(w)).withColumn("c", F.count("v").over(w))
    g = {r["id"]: (r["_win_sum_v"], r["_win_cnt_v"]) for r in got.collect()}
    assert len(g) == 300
    for r in ref.collect():
        assert g[r["id"]] == (r["s"], r["c"])


def test_no_single_partition_exchange(spark):
    df = _data(spark, 200, 50, 0.1, 9)
    plan = ordered(df, OrderSpec("v", "id"), n_buckets=4)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0] or "rangepartitioning" not in plan


def test_number_of_ranges_does_not_change_results(spark):
    df = _data(spark, 300, 40, 0.2, 11, hot=3)
    a = ordered(df, OrderSpec("v", "id"), sums=("x",), n_buckets=6)
    b = ordered(df, OrderSpec("v", "id"), sums=("x",), n_buckets=2)
    cols = ["id", "_rn", "_rank", "_le", "_rows_x", "_range_x"]
    assert sorted(tuple(r) for r in a.select(*cols).collect()) == sorted(tuple(r) for r in b.select(*cols).collect())


def test_materialized_input(spark):
    df = _data(spark, 120, 20, 0.1, 3)
    a = ordered(df, OrderSpec("v", "id"), n_buckets=3, materialize=True)
    b = ordered(df, OrderSpec("v", "id"), n_buckets=3)
    assert sorted((r["id"], r["_rn"]) for r in a.collect()) == sorted((r["id"], r["_rn"]) for r in b.collect())
