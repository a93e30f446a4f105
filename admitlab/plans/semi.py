"""Semi-structured data: JSON and lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rdiv
from ..operators.lists import CHUNK, chunked_lists, joined, positions
from .intervals import patient_sequence

_KEEP_NULLS = {"ignoreNullFields": "false"}


def json_filter(logs: DataFrame, field: str = "k", threshold: float = 50) -> DataFrame:
    """A field of a JSON payload as text, for rows where its number exceeds
    the threshold (``->>`` then a numeric cast that yields NULL on junk)."""
    txt = F.get_json_object(F.col("vitals"), f"$.{field}")
    return (logs.select("patient_id", txt.alias("temperature"))
                .filter(F.col("temperature").try_cast("decimal(38,10)") > threshold))


def json_filter_variant(logs: DataFrame, field: str = "k", threshold: float = 50) -> DataFrame:
    """``json_filter`` on the parsed payload: the text is parsed once into a
    VARIANT, further fields are read from it without parsing again.  A payload
    that is not JSON is NULL.  The field comes back in the variant's spelling
    (1.50 as 1.5)."""
    parsed = logs.select("patient_id", F.try_parse_json("vitals").alias("v"))
    text = F.try_variant_get("v", f"$.{field}", "string")
    return (parsed.select("patient_id", text.alias("temperature"))
                  .filter(F.col("temperature").try_cast("decimal(38,10)") > threshold))


def diagnosis_history(enc: DataFrame, chunk: int = CHUNK, max_rows: int | None = None) -> DataFrame:
    """The comma list of each patient's diagnoses in visit order (date, id).

    One row per patient with up to ``chunk`` visits; a longer history goes on in
    further parts, each with the number of its first visit, so no cell and no
    task grows with a patient.  Positions come from the hot-key-safe sequence
    (``max_rows``: visits above which a patient is spread over tasks).  NULL
    diagnoses are left out of the text, as STRING_AGG does."""
    rows = patient_sequence(enc.select("patient_key", "patient_id", "admission_date", "id", "primary_diagnosis"), max_rows=max_rows)
    lists = chunked_lists(rows, ["patient_key", "patient_id"], "_seq", F.col("primary_diagnosis"), chunk)
    return lists.select("patient_id", "part", "first_position", F.col("n").alias("visits"),
                        joined(F.col("items")).alias("diagnosis_history"))


def diagnosis_positions(enc: DataFrame) -> DataFrame:
    """The same history as rows: one per visit with its place."""
    return patient_sequence(enc).select("patient_id", F.col("_seq").cast("bigint").alias("position"),
                                        F.col("primary_diagnosis").alias("diagnosis"))


def unnest_counts(surveys: DataFrame) -> DataFrame:
    return (surveys.select(F.explode(F.split(F.col("diagnosis_list"), ",")).alias("single_diagnosis"))
                   .groupBy("single_diagnosis").agg(F.count(F.lit(1)).alias("mentions")))


def unnest_history(enc: DataFrame) -> DataFrame:
    """Per diagnosis, visits of patients with more than one visit.  The
    reference builds a text list per patient and splits it again; counting
    the rows of those patients directly gives the same numbers without
    building any list."""
    multi = enc.groupBy("patient_key").agg(F.count(F.lit(1)).alias("_visits")).filter(F.col("_visits") > 1)
    return (enc.join(multi, "patient_key", "left_semi")
               .groupBy(F.trim(F.col("primary_diagnosis")).alias("single_diagnosis"))
               .agg(F.count(F.lit(1)).alias("patient_count"))
               .orderBy(F.col("patient_count").desc()))


def regex_match(enc: DataFrame, pattern: str = "heart|stroke") -> DataFrame:
    """Case-insensitive regular expression on the diagnosis."""
    return enc.filter(F.col("primary_diagnosis").rlike(f"(?i){pattern}"))


def json_summary(enc: DataFrame) -> DataFrame:
    summary = F.struct(F.sum("total_bill_amount").alias("total_spent"),
                       F.count(F.lit(1)).alias("visits"))
    return (enc.groupBy("patient_key", "patient_id")
               .agg(F.to_json(summary, _KEEP_NULLS).alias("patient_summary"))
               .drop("patient_key"))


def json_patients_by_payer(enc: DataFrame) -> DataFrame:
    """The elements {patient_id, total_bill} of each payer's JSON array, one row
    per admission, in the order (payer, id).  A payer holds a fixed share of ALL
    admissions, so the array itself would be one row and one task without bound."""
    obj = F.struct("patient_id", F.col("total_bill_amount").alias("total_bill"))
    return enc.select("insurance_type", "id", F.to_json(obj, _KEEP_NULLS).alias("patient")).orderBy("insurance_type", "id")


def json_patient_lists(enc: DataFrame, chunk: int = 1000) -> DataFrame:
    """``json_agg`` of the elements {patient_id, total_bill} per payer in the order
    of ids: JSON arrays of up to ``chunk`` elements with the place of their first
    one.  Put one after the other they are the payer's whole array."""
    obj = F.to_json(F.struct("patient_id", F.col("total_bill_amount").alias("total_bill")), _KEEP_NULLS)
    rows = positions(enc.select("insurance_type", "id", obj.alias("element")), "insurance_type", "id")
    lists = chunked_lists(rows, ["insurance_type"], "_pos", F.col("element"), chunk)
    return lists.select("insurance_type", "part", "first_position", F.col("n").alias("elements"),
                        F.concat(F.lit("["), F.array_join("items", ","), F.lit("]")).alias("patients"))


def json_profile(enc: DataFrame) -> DataFrame:
    """Nested JSON per (patient, age, gender): demographics, financial,
    clinical.  Averages are rounded exactly (cost to cents, rates to 4
    places) and written as decimals."""
    bill, flag, com = F.col("total_bill_amount"), F.col("readmitted_30_days"), F.col("comorbidity_score")
    cents = F.sum((bill * 100).cast("decimal(18,0)"))
    profile = F.struct(
        F.struct(F.col("age").alias("age"), F.col("gender").alias("gender")).alias("demographics"),
        F.struct(F.sum(bill).alias("total_spent"),
                 rdiv(cents, F.count(bill) * 100, 2).cast("decimal(18,2)").alias("avg_visit_cost")).alias("financial"),
        F.struct(rdiv(F.sum(flag), F.count(flag), 4).cast("decimal(10,4)").alias("readmission_rate"),
                 rdiv(F.sum(com), F.count(com), 4).cast("decimal(10,4)").alias("avg_comorbidity")).alias("clinical"))
    return (enc.groupBy("patient_key", "patient_id", "age", "gender")
               .agg(F.to_json(profile, _KEEP_NULLS).alias("complete_profile"))
               .drop("patient_key"))
