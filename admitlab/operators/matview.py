"""A stored view that is re-read by name and refreshed part by part.

The input is a set of files.  A view keeps, for every input file, a partial
result that can be added up (counts and sums by group), a list of the files that
make up each version, the finished result of each version, and a pointer.

``refresh`` lists the input files, reads only those that are new or changed,
stores their partial results, adds up the partial results of all files of the
version and stores the finished rows.  Files that are gone leave the list.  Every
refresh writes under a name of its own and the pointer last: a refresh that dies
leaves the old version in force, and readers of an older version keep its files.
When one of the tables that the input is joined with has changed, every file is
read again.

    <root>/<name>/state/<run>          part, groups, partial aggregates of the files read
    <root>/<name>/parts/<run>          part, length, modified, state_run of all files
    <root>/<name>/result/<run>         the finished rows
    <root>/<name>/current/version=N    the pointer: run, fingerprint of the other tables, files
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_POINTER = "run string, fingerprint string, files_read long, files long, version long"


@dataclass(frozen=True)
class View:
    """``rows`` derives the rows from a DataFrame of input files (it must keep the
    column ``_part``), ``partial`` has aggregates that may be summed over
    files, ``finish`` turns the sums into the columns of the view."""
    name: str
    by: tuple[str, ...]
    rows: Callable[[DataFrame], DataFrame]
    partial: dict[str, Column]
    finish: dict[str, Column]


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(part, path, length, modified) of the Parquet files below ``path``; their
    content is not read.  ``part`` is the path as Spark's file metadata spells it."""
    found = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(path))
    return found.select(F.col("_metadata.file_path").alias("part"), "path", "length", F.col("modificationTime").alias("modified"))


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Changes when a file of the tables is added, removed or rewritten."""
    total = [list_files(spark, p).agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("part", "length", "modified"))).first()
             for p in paths]
    return ";".join(f"{n}:{h}" for n, h in total)


def current(spark: SparkSession, root: str, name: str) -> dict | None:
    """The pointer of the version in force, or None."""
    try:
        found = spark.read.schema(_POINTER).json(f"{root}/{name}/current").orderBy(F.col("version").desc()).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found.asDict() if found else None


def read_view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of the version in force."""
    now = current(spark, root, name)
    if now is None:
        raise LookupError(f"no stored view {name}")
    return spark.read.parquet(f"{root}/{name}/result/{now['run']}")


def refresh(spark: SparkSession, root: str, view: View, input_path: str, other_paths: list[str] | None = None) -> dict:
    """Bring the view up to date and return its pointer.

    ``files_read`` tells how many input files were read; without any change
    nothing is written and the pointer stays.  Two refreshes at a time do not mix:
    the second to write a version fails."""
    base = f"{root}/{view.name}"
    now, others = current(spark, root, view.name), fingerprint(spark, other_paths or [])
    files = list_files(spark, input_path)
    same = ["part", "length", "modified"]
    if now and now["fingerprint"] == others:
        old = spark.read.parquet(f"{base}/parts/{now['run']}")
        files = files.join(old, same, "left")
        gone = old.join(files.select(*same), same, "left_anti")
    else:
        old, gone = None, None
        files = files.withColumn("state_run", F.lit(None).cast("string"))
    # one path per new file: as many as the listing of the next read holds anyway
    new = [r[0] for r in files.where("state_run is null").select("path").collect()]
    if old is not None and not new and gone.isEmpty():
        return now
    if files.isEmpty():
        raise FileNotFoundError(f"no Parquet files below {input_path}")
    run = uuid.uuid4().hex
    if new:
        raw = spark.read.parquet(*new).withColumn("_part", F.col("_metadata.file_path"))
        state = view.rows(raw).groupBy(F.col("_part").alias("part"), *view.by).agg(
            *[c.alias(k) for k, c in view.partial.items()])
        state.withColumn("state_run", F.lit(run)).write.parquet(f"{base}/state/{run}")
    files.select(*same, F.coalesce("state_run", F.lit(run)).alias("state_run")).write.parquet(f"{base}/parts/{run}")
    parts = spark.read.parquet(f"{base}/parts/{run}")
    # as many as there were refreshes whose files are still there
    runs = [r[0] for r in parts.select("state_run").distinct().collect()]
    states = spark.read.parquet(*[f"{base}/state/{r}" for r in runs])
    sums = (states.join(parts, ["part", "state_run"], "left_semi")
            .groupBy(*view.by).agg(*[F.sum(k).alias(k) for k in view.partial]))
    sums.select(*view.by, *[c.alias(k) for k, c in view.finish.items()]).write.parquet(f"{base}/result/{run}")
    pointer = spark.range(1).select(F.lit(run).alias("run"), F.lit(others).alias("fingerprint"),
                                    F.lit(len(new)).cast("long").alias("files_read"),
                                    F.lit(parts.count()).cast("long").alias("files"))
    pointer.write.json(f"{base}/current/version={(now['version'] if now else 0) + 1}")
    return current(spark, root, view.name)
