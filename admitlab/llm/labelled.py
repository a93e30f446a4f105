"""A bounded sample of labelled training rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, text_or_empty

STEPS = 1_000_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, held_mod: int = 1, held_rest: int = 1,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, y) of labelled documents that are not held out
    (crc32(id) % held_mod != held_rest): one row per id, about ``max_rows`` ids
    and never more than twice as many.

    Ids are chosen by a hash, so reruns agree.  An id with several labels takes
    the larger; of several texts under one id, that of the least hash; so
    repeated rows count once and no id fills the sample.  NULL ids and labels are
    left out, NULL texts are empty; other columns are not read; an empty table
    gives no rows.  Only the chosen ids are sent to the document scan.
    """
    train = (labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label}`").isNotNull()
                          & (crc_mod(id_col, held_mod) != held_rest))
             .groupBy(F.col(f"`{id_col}`").cast("long").alias("doc_id"))
             .agg(F.max(F.col(f"`{label}`").cast("int")).alias("y")))
    n = train.count()
    if n > max_rows:
        train = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(STEPS)) < STEPS * max_rows // n).limit(2 * max_rows)
    found = docs.select(F.col(f"`{id_col}`").cast("long").alias("d"), text_or_empty(text_col).alias("text"))
    met = found.join(F.broadcast(train), F.col("d") == F.col("doc_id")).select("doc_id", "text", "y")
    # one text per id and task goes to the shuffle, however often the id occurs
    return met.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t")).select("doc_id", "t.text", "y")
