"""One patient holding a third of all admissions (derived from the given
tables): results stay exact and the work is spread over many ranges."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admitlab.operators.order import OrderSpec, ordered, plan_order
from admitlab.operators.sequence import hot_keys, sequence
from admitlab.sources.tables import encounters
from sf_dirs import SF_MID


@pytest.fixture(scope="module")
def skewed(spark):
    enc = encounters(spark, SF_MID)
    hot = F.col("id") % 3 == 0
    return (enc.withColumn("patient_key", F.when(hot, F.lit(0)).otherwise(F.col("patient_key")))
               .withColumn("patient_id", F.when(hot, F.lit("PAT0000000")).otherwise(F.col("patient_id"))))


def test_hot_patient_detected(skewed):
    assert hot_keys(skewed, "patient_key", 1000) == [0]


@pytest.mark.parametrize("undated", [0, 7])
def test_sequence_equals_plain_window(skewed, undated):
    if undated:  # rows without a date come first in their patient
        skewed = skewed.withColumn("admission_date", F.when(F.col("id") % undated != 0, F.col("admission_date")))
    got = sequence(skewed, "patient_key", "admission_date", "id", ("discharge_date",), ("admission_date",),
                   ("readmitted_30_days",), max_rows_per_key=1000)
    w = Window.partitionBy("patient_key").orderBy("admission_date", "id")
    ref = (skewed.withColumn("rn", F.row_number().over(w)).withColumn("p", F.lag("discharge_date").over(w))
                 .withColumn("nx", F.lead("admission_date").over(w))
                 .withColumn("c", F.sum("readmitted_30_days").over(Window.partitionBy("patient_key").orderBy("admission_date"))))
    a = {r["id"]: (r["_seq"], r["_prev_discharge_date"], r["_next_admission_date"], r["_cum_readmitted_30_days"])
         for r in got.collect()}
    b = {r["id"]: (r["rn"], r["p"], r["nx"], r["c"]) for r in ref.collect()}
    assert a == b


def test_hot_rows_are_spread(spark, skewed):
    hot_rows = skewed.filter(F.col("patient_key") == 0).withColumn(
        "_hv", F.unix_date("admission_date").cast("long"))
    spec = OrderSpec("_hv", "id")
    k = 16
    o = ordered(hot_rows, spec, n_buckets=k, keep_ranges=True)
    n = hot_rows.count()
    sizes = [r["count"] for r in o.groupBy("_b1", "_b2").count().collect()]
    assert sum(sizes) == n
    assert max(sizes) <= 3 * n / k  # no range far above its share

    # a single value holding 40% of the rows is split by id ranges as well
    tied = hot_rows.withColumn("_hv", F.when(F.col("id") % 5 < 2, F.lit(0)).otherwise(F.col("_hv")))
    plan = plan_order(tied, spec, n_buckets=k)
    assert plan.hot_info  # the tied value was recognised
    o2 = ordered(tied, spec, plan=plan, keep_ranges=True)
    sizes2 = [r["count"] for r in o2.groupBy("_b1", "_b2").count().collect()]
    assert max(sizes2) <= 3 * n / k
