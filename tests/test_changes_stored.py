"""Copy-on-write parts, bucket checksums, binary lifting, narrow duplicate removal, VARIANT."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from admitlab.operators.closure import ancestors
from admitlab.plans import changes, quality, relate, semi
from admitlab.sources.parts import PartTable


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def enc(spark):
    rng = random.Random(3)
    day = dt.date(2020, 1, 1)
    made = [(i, None if i % 101 == 0 else (1 if i % 3 == 0 else i % 60), f"P{i % 60}", day + dt.timedelta(days=rng.randrange(40)),
             rng.choice([None, 1, 250, 9_999])) for i in range(1500)]
    return spark.createDataFrame(made, "id long, patient_key long, patient_id string, admission_date date, bill long").withColumn(
        "total_bill_amount", F.col("bill").cast("decimal(12,2)")).drop("bill").cache()


def files(path):
    return {p.relative_to(path).as_posix() for p in path.rglob("*.parquet")}


def test_only_touched_parts_are_rewritten(spark, enc, tmp_path):
    folder = tmp_path / "enc"
    table = PartTable(str(folder), 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows(table.save(enc)) == rows(enc)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    before = files(folder)
    assert len([f for f in before if f.startswith("part=")]) > 16  # a part is several files
    req = spark.createDataFrame([(7,), (7,), (9,), (5_000,)], "patient_key long")
    touched = table.change(req, changes.set_bill)
    after = files(folder)
    assert 1 <= len(touched) <= 2
    assert {f for f in before if int(f.split("/")[0][5:]) not in touched} == {
        f for f in after if int(f.split("/")[0][5:]) not in touched}
    assert not before & {f for f in after if int(f.split("/")[0][5:]) in touched}
    assert rows(table.read(spark)) == rows(changes.set_bill(enc, req))


def test_requests_without_a_patient_change_nothing(spark, enc, tmp_path):
    folder = tmp_path / "enc"
    table = PartTable(str(folder), 8)
    table.save(enc)
    before = files(folder)
    assert table.change(spark.createDataFrame([(9_999,), (None,)], "patient_key long"), changes.set_bill) == []
    assert table.change(spark.createDataFrame([], "patient_key long"), changes.set_bill) == []
    assert files(folder) == before


def test_a_change_that_fails_leaves_the_table(spark, enc, tmp_path):
    table = PartTable(str(tmp_path / "enc"), 8)
    table.save(enc)

    def broken(hit, req):
        return hit.withColumn("total_bill_amount", F.raise_error(F.lit("stop")).cast("decimal(12,2)"))
    with pytest.raises(Exception, match="stop"):
        table.change(spark.createDataFrame([(1,)], "patient_key long"), broken)
    assert rows(table.read(spark)) == rows(enc)
    table.change(spark.createDataFrame([(1,)], "patient_key long"), changes.set_bill)  # again, whole
    assert rows(table.read(spark)) == rows(changes.set_bill(enc, spark.createDataFrame([(1,)], "patient_key long")))


@pytest.mark.parametrize("buckets", [1, 8, 4096])
def test_audit_joins_only_buckets_that_differ(spark, enc, buckets):
    new = enc.withColumn("total_bill_amount", F.when(F.col("id").isin(30, 700, 701), F.lit(5).cast("decimal(12,2)"))
                         .when(F.col("id") == 900, F.lit(None)).otherwise(F.col("total_bill_amount")))
    differ = changes.changed_buckets(enc, new, buckets)
    assert 1 <= len(differ) <= 4
    for null_safe in (False, True):
        plain = enc.alias("o").join(new.alias("n"), "id").select("id", "o.patient_id", F.col("o.total_bill_amount").cast("double").alias("a"),
                                                                 F.col("n.total_bill_amount").cast("double").alias("b"))
        want = plain.where(~F.col("a").eqNullSafe(F.col("b")) if null_safe else F.col("a") != F.col("b"))
        assert rows(changes.bill_audit(enc, new, null_safe, buckets)) == rows(want)


def test_an_unchanged_version_reads_no_details(spark, enc, tmp_path):
    enc.write.parquet(str(tmp_path / "a"))
    old, new = spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "a"))
    out = changes.bill_audit(old, new)
    assert out.count() == 0 and "LocalTableScan <empty>" in out._jdf.queryExecution().executedPlan().toString()
    assert changes.changed_buckets(old, new.where("id <> 5")) != []
    assert changes.changed_buckets(old.limit(0), new.limit(0)) == []


def test_duplicates_by_either_form(spark, enc):
    keep = {}
    for r in enc.collect():
        k = (r["patient_key"], r["admission_date"])
        keep[k] = min(keep.get(k, r["id"]), r["id"])
    by_semi = quality.drop_duplicate_encounters(enc)
    assert by_semi.columns == enc.columns
    assert {r["id"] for r in by_semi.collect()} == set(keep.values())
    assert rows(quality.delete_duplicate_encounters(enc, enc.select("id", "patient_key", "admission_date"))) == rows(by_semi)
    plan = by_semi._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "min_by" not in plan


def tree(spark, pairs):
    return spark.createDataFrame([(d, f"n{d}", "s", up) for d, up in pairs],
                                 "doctor_id long, name string, specialty string, referred_by_id long")


def walk(parent, node):
    path = []
    while node in parent and node not in path:
        path.append(node)
        node = parent[node]
    return path


def test_lifting_equals_walking(spark):
    rng = random.Random(4)
    pairs = [(i, rng.randrange(i) if i and rng.random() < 0.97 else None) for i in range(300)]
    pairs += [(1000, 1001), (1001, 1002), (1002, 1000), (1003, 1001), (2000, 2000), (3000, 9999)]
    parent = dict(pairs)
    starts = [299, 150, 1003, 1000, 2000, 3000, 77_777]
    got = {}
    for r in ancestors(tree(spark, pairs + [(299, parent[299])]), spark.createDataFrame([(s,) for s in starts], "start long"),
                       "doctor_id", "referred_by_id").collect():
        got.setdefault(r["start"], {})[r["level"]] = r["node"]
    assert got == {s: dict(enumerate(walk(parent, s), 1)) for s in starts if s in parent}


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    writes = []
    plain = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (writes.append(path), plain(self, path, *a, **k))[1])
    docs = tree(spark, [(i, i - 1 if i else None) for i in range(150)])
    out = relate.referral_chain(docs, 149)
    assert len(writes) <= 9
    got = {r["level"]: r["doctor_id"] for r in out.collect()}
    assert got == {k + 1: 149 - k for k in range(150)}
    assert "array" not in out._jdf.queryExecution().executedPlan().toString()


def test_variant_and_text_agree(spark):
    payloads = ['{"k": 51}', '{"k": "77"}', '{"k": 50}', '{"k": 50.5}', '{"k": null}', "{}", "junk", "", None, '{"k": "x"}', "[1]",
                '{"k": true}', '{"k": {"a": 1}}', '{"k": [99]}', '{"k": 1e3}', '{"other": 99}', '{"k": 99', '{"k": -60}', '"k"']
    logs = spark.createDataFrame([(f"p{i}", v) for i, v in enumerate(payloads)], "patient_id string, vitals string")
    a = {r["patient_id"]: float(r["temperature"]) for r in semi.json_filter(logs).collect()}
    b = {r["patient_id"]: float(r["temperature"]) for r in semi.json_filter_variant(logs).collect()}
    assert a == b and len(a) >= 4
