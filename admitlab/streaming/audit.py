"""The bill-audit trigger as a Structured Streaming job.

The reference logs (patient, old bill, new bill) AFTER UPDATE, row by row.
Here the updates arrive as a stream of (id, new_amount) events; each event is
joined with the current table version (a stream-static join: the static side
is re-read per micro-batch, no state is kept), rows whose bill really changes
are appended to the audit log.  Exactly-once: the file sink and the
checkpoint location live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

UPDATE_SCHEMA = "id bigint, new_amount decimal(12,2), changed_at timestamp"


def audit_changes(updates: DataFrame, current: DataFrame, null_safe: bool = False) -> DataFrame:
    """Log rows for a (streaming or static) DataFrame of bill updates."""
    old = current.select("id", "patient_id", F.col("total_bill_amount").alias("old_amount"))
    j = updates.join(old, "id")
    changed = (~F.col("old_amount").eqNullSafe(F.col("new_amount"))) if null_safe \
        else (F.col("old_amount") != F.col("new_amount"))
    return j.filter(changed).select("id", "patient_id", "old_amount", "new_amount",
                                    F.col("changed_at").alias("change_date"))


def start_audit_stream(spark, updates_path: str, current: DataFrame, log_path: str,
                       checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Read update files as they land, append audit rows to ``log_path``."""
    base = checkpoint or f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/bill_audit_stream"
    updates = spark.readStream.schema(UPDATE_SCHEMA).parquet(updates_path)
    w = (audit_changes(updates, current).writeStream.format("parquet")
         .option("path", log_path).option("checkpointLocation", base).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
