"""Ordered lists of any length, in bounded chunks that know their place.

``listagg`` and ``json_agg`` build a group's list in one task and one cell.  Here
every row first gets its position in the group without a window over the group:
ranges of the order column are numbered on their own and shifted by the rows of
the group in earlier ranges.  Runs of ``chunk`` consecutive positions are then
gathered and sorted on their own.  A group of at most ``chunk`` rows is one row
with the whole list; a longer one has further parts, in order.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .order import OrderSpec, plan_order

CHUNK = 10_000


def positions(df: DataFrame, key: str, order_col: str, n_ranges: int | None = None) -> DataFrame:
    """``df`` plus ``_pos``: the 1-based place of a row among the rows of its
    ``key`` by ``order_col`` (unique, numeric, not NULL).  A key that holds any
    share of the rows is spread over the ranges; NULL is a key like any other."""
    plan = plan_order(df, OrderSpec(order_col, order_col), n_ranges)
    cuts = sorted(set(plan.cuts))
    place = df.withColumn("_at", F.col(order_col).cast("double"))
    if cuts:
        place = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_at", outputCol="_range").transform(place)
    else:
        place = place.withColumn("_range", F.lit(0.0))
    place = place.drop("_at")
    inside = place.withColumn("_rn", F.row_number().over(Window.partitionBy(key, "_range").orderBy(order_col)))
    # at most one row per key and range
    earlier = Window.partitionBy("_key").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    before = (place.groupBy(F.col(key).alias("_key"), F.col("_range").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
              .select("_key", "_r", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    met = inside.join(before, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_r")))
    return met.withColumn("_pos", F.col("_before") + F.col("_rn")).drop("_key", "_r", "_range", "_rn", "_before")


def chunked_lists(df: DataFrame, keys: list[str], position: str, value: Column, chunk: int = CHUNK) -> DataFrame:
    """(keys..., part, first_position, n, items): the values of each group in the
    order of ``position`` (1, 2, ... without gaps), ``chunk`` of them a row.
    ``n`` counts the rows of the part; a NULL value is an item that is NULL."""
    part = F.floor((F.col(position) - 1) / chunk).cast("long")
    rows = df.select(*keys, (part + 1).alias("part"), F.struct(F.col(position).alias("p"), value.alias("v")).alias("x"))
    return rows.groupBy(*keys, "part").agg(
        F.min("x.p").cast("long").alias("first_position"), F.count(F.lit(1)).alias("n"),
        F.transform(F.array_sort(F.collect_list("x")), lambda x: x["v"]).alias("items"))


def joined(items: Column, sep: str = ", ") -> Column:
    """The text of ``STRING_AGG``: NULL items are left out, NULL if none is left."""
    known = F.filter(items, lambda x: x.isNotNull())
    return F.when(F.size(known) > 0, F.array_join(known, sep))
