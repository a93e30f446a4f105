"""Ordered lists in bounded chunks."""

import random

import pytest
from pyspark.sql import functions as F

from admitlab.operators.lists import chunked_lists, joined, positions
from admitlab.plans import semi


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(8)
    rows = [(i * 7 - 900, "hot" if i % 3 else rng.choice(["a", "b", None]), rng.choice(["x", "y", None])) for i in range(900)]
    rows += [(100_000, "none", None), (100_001, "none", None)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id long, k string, v string").repartition(6).cache()


def lists_of(table):
    found = {}
    for r in sorted(table.collect(), key=lambda r: r["id"]):
        found.setdefault(r["k"], []).append(r["v"])
    return found


@pytest.mark.parametrize("ranges", [None, 1, 40])
def test_positions_number_each_key(table, ranges):
    want = {}
    for r in sorted(table.collect(), key=lambda r: r["id"]):
        want[r["id"]] = sum(1 for x in want.values() if x[0] == r["k"]) + 1, r["k"]
        want[r["id"]] = (r["k"], want[r["id"]][0])
    got = {r["id"]: (r["k"], r["_pos"]) for r in positions(table, "k", "id", ranges).collect()}
    assert got == want


@pytest.mark.parametrize("chunk", [1, 7, 10_000])
def test_chunks_make_up_the_whole_list(table, chunk):
    out = chunked_lists(positions(table, "k", "id"), ["k"], "_pos", F.col("v"), chunk).collect()
    want = lists_of(table)
    got = {}
    for r in sorted(out, key=lambda r: (str(r["k"]), r["part"])):
        mine = got.setdefault(r["k"], [])
        assert r["first_position"] == len(mine) + 1 and r["n"] == len(r["items"]) <= chunk
        mine += r["items"]
    assert got == want


def test_joined_text_like_string_agg(table):
    out = chunked_lists(positions(table, "k", "id"), ["k"], "_pos", F.col("v")).select("k", joined(F.col("items")).alias("t"))
    want = {k: ", ".join(v for v in vs if v is not None) or None for k, vs in lists_of(table).items()}
    assert {r["k"]: r["t"] for r in out.collect()} == want and want["none"] is None


def test_no_task_holds_a_hot_patient(spark):
    """A patient with a third of the visits: the same history by either path, in bounded parts."""
    rng = random.Random(1)
    rows = [(i, 1 if i % 3 == 0 else 2 + i % 50, f"2020-01-{1 + rng.randrange(28):02d}", rng.choice(["A", "B", None]))
            for i in range(3000)]
    enc = (spark.createDataFrame(rows, "id long, patient_key long, d string, primary_diagnosis string")
           .selectExpr("*", "concat('P', patient_key) as patient_id", "cast(d as date) as admission_date"))
    plain = sorted(map(tuple, semi.diagnosis_history(enc, chunk=100).collect()))
    spread = sorted(map(tuple, semi.diagnosis_history(enc, chunk=100, max_rows=500).collect()))
    assert plain == spread
    parts = [r for r in plain if r[0] == "P1"]
    assert [r[1:4] for r in parts] == [(k + 1, 100 * k + 1, 100) for k in range(10)]
    order = sorted((r for r in rows if r[1] == 1), key=lambda r: (r[2], r[0]))
    assert ", ".join(r[4] for r in parts) == ", ".join(r[3] for r in order if r[3])


def test_json_lists_are_arrays(spark):
    import json
    enc = spark.createDataFrame([(i, "P" if i % 2 else None, f"p{i}", None if i == 5 else i) for i in range(25)],
                                "id long, insurance_type string, patient_id string, bill long").withColumn(
        "total_bill_amount", F.col("bill").cast("decimal(12,2)"))
    out = semi.json_patient_lists(enc, chunk=4).collect()
    got = {}
    for r in sorted(out, key=lambda r: r["part"]):
        items = json.loads(r["patients"])
        assert len(items) == r["elements"] <= 4
        got.setdefault(r["insurance_type"], []).extend(x["patient_id"] for x in items)
    assert got == {"P": [f"p{i}" for i in range(1, 25, 2)], None: [f"p{i}" for i in range(0, 25, 2)]}
    assert semi.json_patient_lists(enc.limit(0)).count() == 0
