"""Data quality and cleaning jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expr as X
from ..functions import fixed as FX
from ..functions.numeric import money, rdiv


#: Pieces that one patient's rows are dealt over in the first step of a minimum.
SALTS = 16


def column_profile(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """Per column in schema order: position, name, Spark type, nullability
    (the catalogue query), plus rows, NULLs and distinct values from the data.

    One scan: every value becomes a narrow row (column number, number or text).
    Integers, dates, booleans and decimals of up to 18 digits travel as one
    bigint, other types as text; equal values of a column meet in a partial
    (map-side) aggregate, and the counts follow from its groups.
    ``exact_distinct=False`` uses HyperLogLog++ sketches instead (no exchange
    of values)."""
    cols = df.columns
    fields = {f.name: f for f in df.schema.fields}
    meta = df.sparkSession.createDataFrame(
        [(i + 1, c, fields[c].dataType.simpleString(), "YES" if fields[c].nullable else "NO")
         for i, c in enumerate(cols)],
        "ordinal_position int, column_name string, data_type string, is_nullable string")
    if exact_distinct:
        slots = ", ".join(f"{i + 1}, {_value_slots(fields[c])}" for i, c in enumerate(cols))
        seen = (df.selectExpr(f"stack({len(cols)}, {slots}) AS (ordinal_position, num, txt)")
                  .groupBy("ordinal_position", "num", "txt").agg(F.count(F.lit(1)).alias("n")))
        is_null = F.col("num").isNull() & F.col("txt").isNull()
        counts = seen.groupBy("ordinal_position").agg(
            F.sum("n").alias("row_count"), F.sum(F.when(is_null, F.col("n"))).alias("null_count"),
            F.count_if(~is_null).alias("distinct_count"))
    else:
        one = df.agg(F.count(F.lit(1)).alias("rows"),
                     *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)],
                     *[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(cols)])
        counts = one.selectExpr(f"stack({len(cols)}, " + ", ".join(
            f"{i + 1}, rows, n{i}, d{i}" for i in range(len(cols)))
            + ") AS (ordinal_position, row_count, null_count, distinct_count)")
    # two tables of one row per column: a small join (an empty table has no groups)
    return (meta.join(counts, "ordinal_position", "left")
                .select("ordinal_position", "column_name", "data_type", "is_nullable",
                        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
                          for c in ("row_count", "null_count", "distinct_count")]))


def _value_slots(field: T.StructField) -> str:
    """SQL for (bigint, text): the value in the one that fits its type, NULL in
    the other."""
    c, t = f"`{field.name}`", field.dataType
    if isinstance(t, T.IntegralType | T.BooleanType):
        return f"CAST({c} AS BIGINT), CAST(NULL AS STRING)"
    if isinstance(t, T.DateType):
        return f"CAST(unix_date({c}) AS BIGINT), CAST(NULL AS STRING)"
    if isinstance(t, T.DecimalType) and t.precision <= 18:
        return f"CAST({c} * {10 ** t.scale}BD AS BIGINT), CAST(NULL AS STRING)"
    return f"CAST(NULL AS BIGINT), CAST({c} AS STRING)"


def table_scan(df: DataFrame) -> DataFrame:
    return df


def table_sample(df: DataFrame, n: int = 10) -> DataFrame:
    """A repeatable sample of ``n`` rows: the lowest ids (TakeOrderedAndProject,
    a per-partition top-n before one small merge)."""
    return df.orderBy("id").limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def impute_income(df: DataFrame, fill: int = FX.FILL_INCOME) -> DataFrame:
    return (df.filter(F.col("household_income").isNull())
              .select("patient_id", "insurance_type",
                      money(F.col("household_income")).alias("raw_income"),
                      money(F.coalesce(F.col("household_income"), F.lit(fill))).alias("cleaned_income")))


def standardize_labels(df: DataFrame, column: str = "insurance_raw") -> DataFrame:
    return (df.select(F.col(column).alias("raw_input")).distinct()
              .select("raw_input", X.pg_initcap(F.trim(F.col("raw_input"))).alias("standardized_insurance")))


def age_brackets(df: DataFrame, young_label: str = FX.AGE_YOUNG_LABELS[0], descending: bool | None = True,
                 distinct: bool = True) -> DataFrame:
    """Age bracket per (patient, age): ``distinct`` as the GROUP BY forms,
    every admission when False (the ungrouped form); ``descending`` None
    leaves the rows unsorted."""
    out = df.select("patient_id", "age", X.age_bracket(young_label).alias("age_bracket"))
    if distinct:
        out = out.distinct()
    if descending is None:
        return out
    return out.orderBy(F.col("age").desc() if descending else F.col("age").asc())


def length_of_stay(df: DataFrame) -> DataFrame:
    return df.select("patient_id", "admission_date", "discharge_date",
                     X.length_of_stay().cast("bigint").alias("length_of_stay"))


def impute_multi(df: DataFrame, income: int = FX.FILL_INCOME, comorbidity: int = FX.FILL_COMORBIDITY,
                 bill: int = FX.FILL_BILL) -> DataFrame:
    """Fill three columns.  ``data_quality_flag`` says 'Imputed' when any of them
    was NULL (the stated meaning); ``data_quality_flag_literal`` keeps the
    reference's test, which is always 'Complete'."""
    inc, com, b = F.col("household_income"), F.col("comorbidity_score"), F.col("total_bill_amount")
    any_null = inc.isNull() | com.isNull() | b.isNull()
    return df.select(
        "patient_id",
        money(F.coalesce(inc, F.lit(income))).alias("income"),
        F.coalesce(com, F.lit(comorbidity)).alias("comorbidity"),
        money(F.coalesce(b, F.lit(bill))).alias("bill_amount"),
        F.when(any_null, "Imputed").otherwise("Complete").alias("data_quality_flag"),
        F.when(F.coalesce(inc, F.lit(income)).isNotNull(), "Complete").otherwise("Imputed")
         .alias("data_quality_flag_literal"))


def threshold_outliers(df: DataFrame, max_age: int = 100, max_bill: int = 100000) -> DataFrame:
    return (df.filter((F.col("age") > max_age) | (F.col("total_bill_amount") > max_bill))
              .select("patient_id", "age", money(F.col("total_bill_amount")).alias("total_bill_amount"))
              .orderBy(F.col("total_bill_amount").desc_nulls_first()))


def duplicate_encounters(df: DataFrame) -> DataFrame:
    return (df.groupBy("patient_key", "patient_id", "admission_date")
              .agg(F.count(F.lit(1)).alias("duplicate_count"))
              .filter(F.col("duplicate_count") > 1)
              .drop("patient_key"))


def first_encounters(df: DataFrame) -> DataFrame:
    """(id): the lowest id per (patient, admission_date), in two narrow steps.

    The first step groups by a salt of the id too, so a patient that holds a
    third of the rows is spread over tasks even where the rows already lie by
    patient.  NULL patients and dates group like values."""
    keys = ["patient_key", "admission_date"]
    salted = df.select(*keys, "id", F.pmod("id", F.lit(SALTS)).alias("_salt"))
    return (salted.groupBy(*keys, "_salt").agg(F.min("id").alias("id"))
            .groupBy(*keys).agg(F.min("id").alias("id")).select("id"))


def drop_duplicate_encounters(df: DataFrame, narrow: DataFrame | None = None) -> DataFrame:
    """New table version keeping the lowest id per (patient, admission_date).

    The ids to keep come from three narrow columns, of ``narrow`` where the same
    rows can be had without ``df``'s joins; whole rows are then fetched by id (a
    semi join), so no aggregate carries or sorts them."""
    keep = first_encounters(df if narrow is None else narrow).withColumnRenamed("id", "_keep")
    return df.join(keep, F.col("id") == F.col("_keep"), "left_semi")


def delete_duplicate_encounters(df: DataFrame, narrow: DataFrame | None = None) -> DataFrame:
    """The same as the DELETE says it: an anti join against the ids that go, the
    rows of a (patient, admission_date) that has a lower id."""
    ids = (df if narrow is None else narrow).select("id")
    gone = ids.join(first_encounters(df if narrow is None else narrow), "id", "left_anti").withColumnRenamed("id", "_gone")
    return df.join(gone, F.col("id") == F.col("_gone"), "left_anti")


def missing_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("household_income").isNull()).alias("missing_income"),
                  F.count_if(F.col("comorbidity_score").isNull()).alias("missing_comorbidity"),
                  F.count_if(F.col("total_bill_amount").isNull()).alias("missing_bill"))


def category_profile(df: DataFrame, columns=("insurance_type", "primary_diagnosis")) -> DataFrame:
    """Per categorical column: distinct count and the sorted list of values.

    One pass: the columns are unpivoted to (column, value) and grouped by
    column; each set is merged map-side and is bounded by the column's code
    list."""
    pairs = df.selectExpr(f"stack({len(columns)}, " + ", ".join(
        f"'{c}', CAST(`{c}` AS STRING)" for c in columns) + ") AS (column_name, v)")
    return pairs.groupBy("column_name").agg(
        F.count_distinct("v").alias("distinct_count"),
        F.array_join(F.array_sort(F.collect_set("v")), ", ").alias("distinct_values"))


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("admission_date").alias("first_admission"),
                  F.max("admission_date").alias("last_admission"))


def numeric_ranges(df: DataFrame) -> DataFrame:
    return df.agg(F.min("age").alias("min_age"), F.max("age").alias("max_age"),
                  rdiv(F.sum("age"), F.count("age"), 1).alias("avg_age"),
                  money(F.min("household_income")).alias("min_income"),
                  money(F.max("household_income")).alias("max_income"))
