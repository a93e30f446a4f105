"""Joins and hierarchy."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.closure import ancestors


def delinquent_in(enc: DataFrame, keys: DataFrame) -> DataFrame:
    """Admissions whose patient is IN the key list: a left-semi join on the
    numeric key, by which the fact join is already partitioned.  The key
    list grows with the customer table, so no broadcast is forced; adaptive
    execution broadcasts it at run time only when its real size is small."""
    k = keys.select(F.col("patient_key").alias("_key"))
    return enc.join(k, enc.patient_key == k._key, "left_semi")


def delinquent_exists(enc: DataFrame, keys: DataFrame) -> DataFrame:
    """The same through a correlated EXISTS in SQL; Catalyst rewrites it to
    the same left-semi join as ``delinquent_in``."""
    spark = enc.sparkSession
    enc.createOrReplaceTempView("hospital_readmission")
    keys.createOrReplaceTempView("delinquency_prediction")
    return spark.sql("""
        SELECT * FROM hospital_readmission h
        WHERE EXISTS (SELECT 1 FROM delinquency_prediction d WHERE d.patient_key = h.patient_key)""")


def diagnosis_pairs(enc: DataFrame, top: int = 5) -> DataFrame:
    """Pairs of different diagnoses seen in the same patient, by frequency.

    The self join of admissions would make n_a * n_b rows per patient and
    diagnosis pair.  It is collapsed first to (patient, diagnosis, n), at most
    one row per diagnosis code per patient, and the pair weight n_a * n_b is
    summed: the same counts, with join input and output bounded by the code
    list instead of by the number of visits."""
    per = enc.groupBy("patient_key", "primary_diagnosis").agg(F.count(F.lit(1)).alias("n"))
    a, b = per.alias("a"), per.alias("b")
    pairs = a.join(b, (F.col("a.patient_key") == F.col("b.patient_key"))
                   & (F.col("a.primary_diagnosis") < F.col("b.primary_diagnosis")))
    return (pairs.groupBy(F.col("a.primary_diagnosis").alias("condition_1"),
                          F.col("b.primary_diagnosis").alias("condition_2"))
                 .agg(F.sum(F.col("a.n") * F.col("b.n")).alias("frequency"))
                 .orderBy(F.col("frequency").desc(), "condition_1", "condition_2")
                 .limit(top))


def referral_chain(doctors: DataFrame, start_id: int) -> DataFrame:
    """From one doctor up to the root, with level 1 for the start: the path by
    binary lifting, then its rows by a join."""
    start = doctors.sparkSession.range(1).select(F.lit(int(start_id)).alias("start"))
    return referral_chains(doctors, start).drop("start")


def referral_chains(doctors: DataFrame, starts: DataFrame) -> DataFrame:
    """The same for every doctor of ``starts`` (column ``start``) at once."""
    path = ancestors(doctors, starts, "doctor_id", "referred_by_id")
    return doctors.join(path, doctors.doctor_id == path.node).drop("node")


_PID = re.compile(r"^PAT(\d{7}|[1-9]\d{7,})$")


def patient_lookup(enc: DataFrame, patient_id: str) -> DataFrame:
    """Admissions of one patient.  The id is also turned into its numeric key,
    a predicate Catalyst pushes into the Parquet scans (orders and customers)."""
    cond = F.col("patient_id") == patient_id
    m = _PID.match(patient_id)
    if m:
        cond = (F.col("patient_key") == int(m.group(1))) & cond
    return enc.filter(cond)


def referral_chain_sql(doctors: DataFrame, start_id: int) -> DataFrame:
    """The same walk as Spark SQL's recursive CTE (Spark 4.1+): the recursion
    carries only the node number and its level, the other columns are looked up
    at the end.  Spark allows 100 levels by default and has no cycle guard: a
    cycle fails at the limit, where ``referral_chain`` stops at the repeated
    node."""
    view = f"_referral_doctors_{abs(hash((id(doctors), start_id)))}"
    doctors.createOrReplaceTempView(view)
    return doctors.sparkSession.sql(f"""
        WITH RECURSIVE steps(node, depth) AS (
          SELECT CAST({int(start_id)} AS BIGINT), 1
          UNION ALL
          SELECT v.referred_by_id, s.depth + 1
          FROM steps s JOIN {view} v ON v.doctor_id = s.node WHERE v.referred_by_id IS NOT NULL)
        SELECT v.*, s.depth AS level FROM {view} v JOIN steps s ON s.node = v.doctor_id""")
