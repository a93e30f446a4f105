"""Table-changing jobs.  DataFrames are immutable: each job
returns the new version of the table; ``bill_audit`` diffs two versions the
way the row trigger logged single updates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Income factors per payer.
INCOME_FACTORS = {"Medicaid": 0.4, "Medicare": 0.8, "Private": 1.4}


def scale_income_by_payer(enc: DataFrame, factors: dict | None = None) -> DataFrame:
    factors = factors or INCOME_FACTORS
    inc = F.col("household_income")
    new = None
    for payer, f in factors.items():
        v = F.round(inc * F.lit(f).cast("decimal(3,1)"), 2)
        new = F.when(F.col("insurance_type") == payer, v) if new is None else new.when(F.col("insurance_type") == payer, v)
    return enc.withColumn("household_income", new.otherwise(inc).cast(enc.schema["household_income"].dataType))


def _key_of(patients: DataFrame) -> str:
    """The numeric key, by which the fact join is partitioned, if the list has it."""
    return "patient_key" if "patient_key" in patients.columns else "patient_id"


def discharge_patients(enc: DataFrame, requests: DataFrame, days: int = 5) -> DataFrame:
    """For every (patient_id, disposition) request: set the disposition and a
    discharge date ``days`` after admission on all the patient's rows.  The
    request list is joined (left outer) on the numeric key, not collected; of
    several requests for a patient the first disposition in text order holds."""
    key = _key_of(requests)
    req = requests.groupBy(F.col(key).alias("_pid")).agg(F.min("disposition").alias("_disp"))
    j = enc.join(req, enc[key] == req._pid, "left")
    hit = F.col("_pid").isNotNull()
    cols = []
    for c in enc.columns:
        if c == "discharge_disposition":
            cols.append(F.when(hit, F.col("_disp")).otherwise(F.col(c)).alias(c))
        elif c == "discharge_date":
            cols.append(F.when(hit, F.date_add(F.col("admission_date"), days)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def set_bill(enc: DataFrame, patients: DataFrame, amount: float = 50000.00) -> DataFrame:
    """New version with the bill of the given patients set to ``amount``."""
    key = _key_of(patients)
    p = patients.select(F.col(key).alias("_pid")).distinct()
    j = enc.join(p, enc[key] == p._pid, "left")
    dtype = enc.schema["total_bill_amount"].dataType
    return j.select(*[F.when(F.col("_pid").isNotNull(), F.lit(amount).cast(dtype)).otherwise(F.col(c)).alias(c)
                      if c == "total_bill_amount" else F.col(c) for c in enc.columns])


def _bill_buckets(version: DataFrame, buckets: int) -> DataFrame:
    """``version`` narrowed to id, patient and bill, with a bucket of the id."""
    return version.select("id", "patient_id", "total_bill_amount",
                          F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int").alias("_bucket"))


def changed_buckets(old: DataFrame, new: DataFrame, buckets: int = 4096) -> list[int]:
    """Buckets of ids whose rows or bills differ between two versions, by their
    row count, XOR and sum of hashes.  One partial aggregate per version; at most
    ``buckets`` rows meet and reach the driver."""
    def sums(version: DataFrame, tag: str) -> DataFrame:
        h = F.xxhash64("id", F.col("total_bill_amount").isNull(), "total_bill_amount")
        return _bill_buckets(version, buckets).groupBy("_bucket").agg(
            F.struct(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(20,0)"))).alias(tag))
    both = sums(old, "_old").join(sums(new, "_new"), "_bucket", "full")
    return sorted(r[0] for r in both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select("_bucket").collect())


def bill_audit(old: DataFrame, new: DataFrame, null_safe: bool = False, buckets: int = 4096) -> DataFrame:
    """(id, patient_id, old_amount, new_amount) for rows whose bill changed.

    Default compares with ``<>`` like the trigger (changes from or to NULL are
    not logged); ``null_safe=True`` logs them too.  Checksums per bucket of ids
    come first: only rows of buckets that differ are joined, and two equal
    versions are not joined at all."""
    differ = changed_buckets(old, new, buckets)
    o, n = (_bill_buckets(v, buckets) for v in (old, new))
    if len(differ) < buckets:
        o, n = (v.where(F.col("_bucket").isin(differ) if differ else F.lit(False)) for v in (o, n))
    j = (o.select("id", "patient_id", F.col("total_bill_amount").alias("old_amount"))
         .join(n.select("id", F.col("total_bill_amount").alias("new_amount")), "id"))
    changed = (~F.col("old_amount").eqNullSafe(F.col("new_amount"))) if null_safe \
        else (F.col("old_amount") != F.col("new_amount"))
    return j.filter(changed).select("id", "patient_id", F.col("old_amount").cast("double").alias("old_amount"),
                                    F.col("new_amount").cast("double").alias("new_amount"))


def append_log(log: DataFrame, path: str, change_date: dt.date | None = None) -> None:
    """INSERT ... SELECT into the audit table: append to Parquet, with the
    given change date or else the time of the append."""
    when = F.current_timestamp() if change_date is None else F.lit(change_date)
    log.withColumn("change_date", when).write.mode("append").parquet(path)
