"""Order statistics from a value histogram instead of a rank per row.

``counts`` collapses the rows to one row per value (a partial aggregate; a value
that holds a third of the rows is one row).  ``running_counts`` adds how many
rows lie at or below each value: an exclusive prefix scan over ranges of values
(``operators.order``), so no task sees the whole histogram.  Ranks, cumulative
distributions, tiles and quantiles follow from these counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .order import OrderSpec, ordered


def counts(df: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., value, n): how often each value occurs, NULL like any other."""
    return df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def running_counts(df: DataFrame, value: str) -> tuple[DataFrame, int]:
    """(value, n, below, upto) over all rows of ``df``, NULLs last, and the number
    of rows.  ``below`` rows lie before the value, ``upto`` at or before it.

    The histogram is written once (``checkpoint`` in the shared folder), so the
    rows are read once."""
    hist = counts(df, value).checkpoint(eager=True)
    total = hist.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    scan = ordered(hist, OrderSpec(value, "n", nulls_first=False), sums=("n",))
    upto = F.col("_range_n")
    return scan.select(value, "n", (upto - F.col("n")).alias("below"), upto.alias("upto")), int(total)


def tiles(scan: DataFrame, total: int, n_tiles: int) -> DataFrame:
    """``running_counts`` with the columns ``tile`` and ``rows``: NTILE(n_tiles)
    over the rows in value order.  A value that spans several tiles has a row
    for each, with the number of its rows there."""
    small, larger = divmod(total, n_tiles)
    ends = [k * small + min(k, larger) for k in range(n_tiles + 1)]
    bounds = F.array(*[F.struct(F.lit(k).alias("tile"), F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi"))
                       for k, (lo, hi) in enumerate(zip(ends, ends[1:], strict=False), 1)])
    met = F.filter(bounds, lambda b: (b["lo"] < F.col("upto")) & (b["hi"] > F.col("below")))
    cut = scan.withColumn("_t", F.explode(met))
    return cut.select(*scan.columns, F.col("_t.tile").alias("tile"),
                      (F.least("upto", "_t.hi") - F.greatest("below", "_t.lo")).alias("rows"))


def grouped_running_counts(df: DataFrame, value: str, by: str) -> DataFrame:
    """(by, value, n, upto, total) over the non-NULL values of each group.

    One window per group over its different values, so the values of a group
    must come from a bounded set, such as days; its rows may be any number."""
    order = Window.partitionBy(by).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts(df.where(F.col(value).isNotNull()), value, (by,)).select(
        by, value, "n", F.sum("n").over(order).alias("upto"), F.sum("n").over(Window.partitionBy(by)).alias("total"))


def percentile_cont(value: str, p: float) -> Column:
    """PERCENTILE_CONT(p) as an aggregate over ``grouped_running_counts``: the
    two values around place (total - 1) * p, interpolated."""
    place = (F.col("total") - 1) * F.lit(float(p))

    def at(k: Column) -> Column:
        return F.min(F.when(F.col("upto") > k, F.col(value)))
    low, high = at(F.floor(place)), at(F.ceil(place))
    part = F.max(place - F.floor(place))
    return low + (high - low) * part


def percentile_disc(value: str, p: float) -> Column:
    """PERCENTILE_DISC(p): the first value whose cumulative share reaches p."""
    return F.min(F.when(F.col("upto") / F.col("total") >= F.lit(float(p)), F.col(value)))
