"""A stored view: re-read by name, refreshed part by part."""

import shutil

import pytest
from pyspark.sql import functions as F

from admitlab.functions.numeric import rdiv
from admitlab.operators import matview
from admitlab.operators.matview import View
from admitlab.plans.registry import jobs
from sf_dirs import SF_SMALL


def view(name="v", source=None):
    rows = source or (lambda df: df.select("g", "x", "_part"))
    return View(name, ("g",), rows, {"n": F.count(F.lit(1)), "c": F.count("x"), "s": F.sum("x")},
                {"rows": F.col("n"), "mean": rdiv(F.col("s"), F.col("c"), 2)})


def put(spark, path, values):
    spark.createDataFrame(values, "g string, x long").coalesce(1).write.mode("append").parquet(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def direct(spark, path):
    return rows(spark.read.parquet(path).groupBy("g").agg(F.count(F.lit(1)).alias("rows"),
                                                            rdiv(F.sum("x"), F.count("x"), 2).alias("mean")))


@pytest.fixture()
def place(tmp_path):
    return str(tmp_path / "views of a %20 + name"), str(tmp_path / "in put%2F+")


def test_only_new_files_are_read(spark, place):
    root, path = place
    put(spark, path, [("a", 1), ("a", 2), ("b", None), (None, 5)])
    put(spark, path, [("a", 10)])
    first = matview.refresh(spark, root, view(), path)
    assert (first["version"], first["files"], first["files_read"]) == (1, 2, 2)
    assert rows(matview.read_view(spark, root, "v")) == direct(spark, path)
    assert matview.refresh(spark, root, view(), path) == first  # nothing to do
    old = matview.read_view(spark, root, "v")
    before = direct(spark, path)
    put(spark, path, [("a", 100), ("c", 7)])
    read = []

    def source(df):
        read.extend(df.inputFiles())
        return df.select("g", "x", "_part")
    second = matview.refresh(spark, root, view(source=source), path)
    assert (second["version"], second["files"], second["files_read"]) == (2, 3, 1) and len(read) == 1
    assert rows(matview.read_view(spark, root, "v")) == direct(spark, path) != before
    assert rows(old) == before  # a reader of the earlier version


def test_files_that_change_or_go(spark, place, tmp_path):
    root, path = place
    for k in range(3):
        put(spark, path, [("a", k), ("b", k)])
    matview.refresh(spark, root, view(), path)
    files = sorted((tmp_path / "in put%2F+").glob("*.parquet"))
    files[0].unlink()
    for name in (files[1].name, f".{files[1].name}.crc"):  # rewritten in place
        shutil.copy(files[1].parent / name, files[1].parent / name.replace(files[1].name, files[2].name))
    third = matview.refresh(spark, root, view(), path)
    spark.catalog.clearCache()
    assert (third["files"], third["files_read"]) == (2, 1)
    assert rows(matview.read_view(spark, root, "v")) == direct(spark, path)


def test_a_changed_other_table_reads_all_files_again(spark, place, tmp_path):
    root, path = place
    put(spark, path, [("a", 1)])
    put(spark, path, [("b", 2)])
    other = str(tmp_path / "other")
    put(spark, other, [("x", 1)])
    matview.refresh(spark, root, view(), path, [other])
    put(spark, other, [("y", 1)])
    assert matview.refresh(spark, root, view(), path, [other])["files_read"] == 2


def test_a_second_session_reads_the_view_by_name(spark, place):
    root, path = place
    put(spark, path, [("a", 1), ("b", 2)])
    matview.refresh(spark, root, view(), path)
    again = spark.newSession()
    assert rows(matview.read_view(again, root, "v")) == direct(spark, path)
    assert matview.refresh(again, root, view(), path)["version"] == 1
    with pytest.raises(LookupError):
        matview.read_view(again, root, "unknown")


def test_an_unfinished_refresh_leaves_the_old_version(spark, place):
    root, path = place
    put(spark, path, [("a", 1)])
    matview.refresh(spark, root, view(), path)
    put(spark, path, [("a", 2)])
    broken = View("v", ("g",), view().rows, view().partial, {"rows": F.raise_error(F.lit("stop"))})
    with pytest.raises(Exception, match="stop"):
        matview.refresh(spark, root, broken, path)
    assert rows(matview.read_view(spark, root, "v")) == [("a", 1, 1.0)]
    assert matview.refresh(spark, root, view(), path)["files_read"] == 1
    assert rows(matview.read_view(spark, root, "v")) == direct(spark, path)


def test_job_refreshes_in_place(spark):
    a = rows(jobs()["regional_stats"](spark, SF_SMALL))
    assert a == rows(jobs()["regional_stats"](spark, SF_SMALL)) and len(a) == 5
