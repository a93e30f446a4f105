"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The only characters that separate words in this subpackage.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
#: Rows per Arrow batch: whole documents travel in a batch, so keep it small.
ARROW_ROWS = 2000


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once per application:
    executors need not have it installed (the driver serves the archive)."""
    sc = spark.sparkContext
    if getattr(sc, "_admitlab_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="admitlab-code-"), "admitlab_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._admitlab_shipped = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table; also readies the session for Python on whole documents."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession, tag: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def store(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage there, so a lost executor costs a re-read and not a recomputation.
    The files live as long as the shared folder keeps them."""
    spark = df.sparkSession
    path = shared_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def crc_mod(col: str, mod: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``mod`` (NULL id: text '')."""
    return F.crc32(F.coalesce(F.col(f"`{col}`").cast("string"), F.lit("")).cast("binary")) % mod


def ascii_lower_words(text: str) -> list[bytes]:
    """Words between the ASCII white space 0x20, 0x09-0x0D, with A-Z in lower
    case and every other character kept (``bytes.split`` and ``bytes.lower``
    know exactly these)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def file_bytes(path: str, limit: int = 64 << 20) -> bytes:
    """A vocabulary file, read on the driver; broadcast only below ``limit``."""
    with open(path, "rb") as f:
        data = f.read(limit + 1)
    if len(data) > limit:
        raise ValueError(f"{path} is larger than {limit} bytes")
    return data


def column_texts(batch: pa.RecordBatch, i: int = 0) -> Iterable[str]:
    return (x or "" for x in batch.column(i).to_pylist())


def batches(schema: pa.Schema, rows: Iterator[tuple], size: int = 4096, weigh: Callable[[tuple], int] | None = None,
            limit: int = 0) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of at most ``size`` rows; with ``weigh``, a batch
    also ends with the row that brings its weight to ``limit``."""
    buf: list[tuple] = []
    weight = 0
    for r in rows:
        buf.append(r)
        weight += weigh(r) if weigh else 0
        if len(buf) >= size or (weigh and weight >= limit):
            yield _batch(schema, buf)
            buf, weight = [], 0
    if buf:
        yield _batch(schema, buf)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)],
                                      schema=schema)
