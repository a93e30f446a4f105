"""The streaming audit log equals the batch snapshot diff."""

import os
import tempfile

from pyspark.sql import functions as F

from admitlab.plans import changes
from admitlab.sources.tables import delinquency, encounters
from admitlab.streaming.audit import audit_changes, start_audit_stream
from sf_dirs import SF_SMALL


def test_stream_matches_batch_diff(spark):
    enc = encounters(spark, SF_SMALL)
    req = delinquency(spark, SF_SMALL).select(F.col("customer_id").alias("patient_id"))
    new = changes.set_bill(enc, req)
    batch = {(r["id"], float(r["old_amount"]), float(r["new_amount"]))
             for r in changes.bill_audit(enc, new).collect()}
    work = tempfile.mkdtemp(prefix="audit-", dir=os.environ.get("TMPDIR", "/tmp"))
    upd = (new.join(enc.select("id"), "id").select("id", F.col("total_bill_amount").alias("new_amount"),
                                                   F.current_timestamp().alias("changed_at")))
    upd.write.parquet(f"{work}/updates")
    q = start_audit_stream(spark, f"{work}/updates", enc, f"{work}/log", checkpoint=f"{work}/ckpt")
    q.awaitTermination(120)
    got = {(r["id"], float(r["old_amount"]), float(r["new_amount"]))
           for r in spark.read.parquet(f"{work}/log").collect()}
    assert got == batch and batch


def test_null_safe_logs_null_changes(spark):
    cur = spark.createDataFrame([(1, "PAT0000001", None), (2, "PAT0000002", 10.0)],
                                "id long, patient_id string, total_bill_amount double")
    upd = spark.createDataFrame([(1, 5.0), (2, 10.0)], "id long, new_amount double") \
               .withColumn("changed_at", F.current_timestamp())
    assert audit_changes(upd, cur).count() == 0
    assert audit_changes(upd, cur, null_safe=True).count() == 1
