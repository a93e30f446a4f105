"""Encounters stored in parts by patient, changed by copy-on-write.

The table is a folder of Parquet files, one subfolder per part (a hash of the
patient).  A change reads the parts that hold a patient it names, writes their
new rows beside the table and swaps these parts in (dynamic partition
overwrite); the files of all other parts stay as they are.  Rows of a part are
dealt over several files by id, so a patient that holds a third of the rows is
not one task or one file.

The new rows are complete in the staging folder before the first part is
swapped.  A job that dies before that leaves the table as it was; one that dies
in between is finished by running the same change again, as the changes of this
library set values and do not add to them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PartTable:
    """Where a table lies and how it is cut; ``key`` decides the part of a row."""
    path: str
    parts: int
    key: str = "patient_key"
    files_per_part: int = 4

    def part_of(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.parts)).cast("int")

    def save(self, df: DataFrame) -> DataFrame:
        """Store ``df`` as the whole table."""
        self._write(df.withColumn("part", self.part_of()), "overwrite")
        return self.read(df.sparkSession)

    def _write(self, df: DataFrame, mode: str) -> None:
        spread = F.pmod(F.xxhash64("id"), F.lit(self.files_per_part))
        (df.repartition(F.col("part"), spread).write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy("part").parquet(self.path))

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("part")

    def change(self, requests: DataFrame, new_rows: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Replace the rows of the parts that hold a key of ``requests`` by
        ``new_rows(rows, requests)`` and return these parts.  Only the keys are
        read to find them; the list has at most ``parts`` numbers."""
        spark = requests.sparkSession
        wanted = requests.select(F.col(self.key).alias("_key")).distinct()
        stored = spark.read.parquet(self.path)
        near = [r[0] for r in requests.select(self.part_of().alias("p")).distinct().collect()]
        rows = stored.where(F.col("part").isin(near)) if near else stored.limit(0)
        touched = sorted(r[0] for r in rows.join(wanted, F.col(self.key) == F.col("_key"), "left_semi")
                         .select("part").distinct().collect())
        if not touched:
            return []
        hit = stored.where(F.col("part").isin(touched)).drop("part")
        staging = f"{self.path.rstrip('/')}.staging-{uuid.uuid4().hex}"
        new_rows(hit, requests).withColumn("part", self.part_of()).write.parquet(staging)
        self._write(spark.read.parquet(staging), "overwrite")
        return touched
