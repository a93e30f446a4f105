"""Running sums by day and order statistics by histogram against plain SQL windows."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admitlab.operators import histogram
from admitlab.operators.calendar import day_sums, with_running_sums
from admitlab.plans import windows
from admitlab.plans.registry import jobs
from sf_dirs import SF_SMALL


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    days = [dt.date(2020, 1, 25) + dt.timedelta(days=k) for k in range(0, 80, 3)] + [dt.date(1999, 12, 31), None]
    hot = dt.date(2020, 2, 3)
    rows = []
    for i in range(600):
        day = hot if i % 3 == 0 else rng.choice(days)
        value = None if rng.random() < 0.2 or day == days[0] else Decimal(rng.choice([-500, 0, 1, 1, 250, 99_999])) / 100
        rows.append((i, day, value, rng.choice("abc")))
    return spark.createDataFrame(rows, "id long, day date, v decimal(12,2), g string").cache()


def test_running_sums_equal_range_windows(table):
    w = Window.orderBy(F.col("day").asc_nulls_last())
    m = Window.partitionBy(F.trunc("day", "MM")).orderBy("day")
    want = table.select("id", F.sum("v").over(w).alias("a"), F.sum("v").over(m).alias("b"))
    got = with_running_sums(table, "day", "v").select("id", "_running", "_month_running")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_day_table_is_bounded_and_typed(spark, table):
    assert day_sums(table, "day", "v").count() == table.select("day").distinct().count()
    assert day_sums(table.limit(0), "day", "v").count() == 0
    assert with_running_sums(table.limit(0), "day", "v").count() == 0
    with pytest.raises(TypeError):
        day_sums(table, "id", "v")


def test_running_counts_equal_cume_dist(table):
    scan, total = histogram.running_counts(table, "v")
    assert total == 600
    w = Window.orderBy(F.col("v").asc_nulls_last())
    want = {r["v"]: round(r["c"] * 600) for r in table.select("v", F.cume_dist().over(w).alias("c")).collect()}
    got = scan.collect()
    assert {r["v"]: r["upto"] for r in got} == want and all(r["upto"] - r["below"] == r["n"] for r in got)


@pytest.mark.parametrize("n", [1, 3, 4, 7, 600, 1000])
def test_tiles_equal_ntile(table, n):
    scan, total = histogram.running_counts(table, "v")
    w = Window.orderBy(F.col("v").asc_nulls_last(), "id")
    want = {(r["t"], r["v"]): r["count"] for r in
            table.select("v", F.ntile(n).over(w).alias("t")).groupBy("t", "v").count().collect()}
    assert {(r["tile"], r["v"]): r["rows"] for r in histogram.tiles(scan, total, n).collect()} == want


@pytest.mark.parametrize("p", [0.0, 0.1, 0.25, 0.5, 0.9, 1.0])
def test_percentiles_equal_spark(table, p):
    days = table.withColumn("k", F.datediff("day", F.lit("2020-01-01")))
    h = histogram.grouped_running_counts(days, "k", "g")
    got = {r["g"]: (r["c"], r["d"]) for r in h.groupBy("g").agg(
        histogram.percentile_cont("k", p).alias("c"), histogram.percentile_disc("k", p).alias("d")).collect()}
    want = {r["g"]: r["c"] for r in days.groupBy("g").agg(F.percentile("k", p).alias("c")).collect()}
    assert {g: c for g, (c, _) in got.items()} == pytest.approx(want)
    values = {}
    for r in days.where("k is not null").select("g", "k").collect():
        values.setdefault(r["g"], []).append(r["k"])
    for g, vs in values.items():
        vs.sort()
        assert got[g][1] == next(v for i, v in enumerate(vs, 1) if sum(x <= v for x in vs) / len(vs) >= p)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "id long, patient_id string, admission_date date, total_bill_amount decimal(12,2)")
    for job in (windows.spend_cdf, windows.quartile_summary, windows.monthly_cumulative):
        assert job(empty).count() == 0
    assert tuple(windows.cdf_threshold(empty).first()) == (None, None, 0)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_window_over_rows(spark):
    """The only windows left run over days, months or the value histogram."""
    for key in ("monthly_cumulative", "running_total_range"):
        over = re.findall(r"Window \[sum\((\w+)#", plan_of(jobs()[key](spark, SF_SMALL)))
        assert over and set(over) <= {"_s", "_c", "_ms", "_mc"}  # sums of days and months
    for key in ("cdf_threshold", "quartile_summary"):
        text = plan_of(jobs()[key](spark, SF_SMALL))
        assert "orders" not in text and "FileScan" not in text  # rows were read once, into the stored histogram
    text = plan_of(jobs()["bill_deviation_first"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text
