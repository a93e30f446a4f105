"""Per-key visit sequence (row number, previous / next values) that splits hot keys.

A window ``PARTITION BY key ORDER BY date, id`` sends every row of a key to one
task.  That is right for ordinary keys, but one key may hold a large share of
all rows.  Keys with more than ``max_rows_per_key`` rows are found by an exact
count per key and take a second path:

* the rows of hot keys get one sortable number per (hot key, date) and go
  through the bucketed global order (``operators.order``): range buckets split
  even a single key's rows over many tasks;
* previous / next values come from blocks of consecutive row numbers with a
  one-row halo on each side, so no block needs a neighbour's data;
* the row number inside the key is the global row number minus the first row
  number of the key (one row per hot key, broadcast).

All other rows use the plain window.  The union of both paths is the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .order import OrderSpec, ordered

_DAY_SPAN = 1 << 22   # days per hot key in the composite order number
_DAY_SHIFT = 1 << 21  # dates before 1970 stay positive


_HOT_MEMO: dict = {}


def clear_hot_keys() -> None:
    """Forget remembered hot-key lists (after the input data changed)."""
    _HOT_MEMO.clear()


def hot_keys(df: DataFrame, key: str, max_rows_per_key: int) -> list:
    """Keys with more than ``max_rows_per_key`` rows: one exact count per key,
    combined on the map side (the shuffle holds a key once per task).  At most
    n / max_rows_per_key keys can qualify, so the list is bounded.

    The answer is remembered per (semantic plan, key, limit) for the life of
    the process: jobs over the same input plan pay for the detection once."""
    memo_key = (df.semanticHash(), key, max_rows_per_key)
    if memo_key in _HOT_MEMO:
        return _HOT_MEMO[memo_key]
    _HOT_MEMO[memo_key] = out = _detect_hot(df, key, max_rows_per_key)
    return out


def _detect_hot(df: DataFrame, key: str, max_rows_per_key: int) -> list:
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).count()
    return sorted(r[0] for r in counts.filter(F.col("count") > max_rows_per_key).select(key).collect())


def sequence(df: DataFrame, key: str, date_col: str, tiebreak: str,
             lag_cols: tuple[str, ...] = (), lead_cols: tuple[str, ...] = (),
             range_sums: tuple[str, ...] = (),
             max_rows_per_key: int = 2_000_000, hot: list | None = None,
             rows_per_block: int = 5_000_000) -> DataFrame:
    """``df`` plus ``_seq`` (1-based position in the key's (date, tiebreak)
    order), ``_prev_<c>`` for ``lag_cols``, ``_next_<c>`` for ``lead_cols`` and
    ``_cum_<c>`` for ``range_sums``: the sum of c over the key's rows up to
    this row's date (default RANGE frame: same-date rows share it).  Rows
    without a date come first in their key, on both paths."""
    if hot is None:
        hot = hot_keys(df, key, max_rows_per_key)
    w = Window.partitionBy(key).orderBy(date_col, tiebreak)

    def plain(d: DataFrame) -> DataFrame:
        d = d.withColumn("_seq", F.row_number().over(w).cast("bigint"))
        for c in lag_cols:
            d = d.withColumn(f"_prev_{c}", F.lag(c).over(w))
        for c in lead_cols:
            d = d.withColumn(f"_next_{c}", F.lead(c).over(w))
        for c in range_sums:
            d = d.withColumn(f"_cum_{c}", F.sum(c).over(Window.partitionBy(key).orderBy(date_col)))
        return d

    if not hot:
        return plain(df)

    spark = df.sparkSession
    # bounded: hot keys are at most rows / max_rows_per_key
    hot_df = F.broadcast(spark.createDataFrame([(k, i) for i, k in enumerate(hot)],
                                               f"{key} {df.schema[key].dataType.simpleString()}, _hidx long"))
    cold = plain(df.join(hot_df, key, "left_anti"))

    h = df.join(hot_df, key).withColumn(
        "_hv", F.col("_hidx") * _DAY_SPAN + F.coalesce(F.unix_date(F.col(date_col)) + _DAY_SHIFT, F.lit(0)))
    o = ordered(h, OrderSpec("_hv", tiebreak), sums=tuple(range_sums)).drop("_rank", "_dense_rank", "_le")
    # one row per hot key: first row number and the sums of all earlier hot keys
    per_key = h.groupBy("_hidx").agg(*[F.sum(c).alias(f"_ks_{c}") for c in range_sums],
                                     F.count(F.lit(1)).alias("_kc"))
    wk = Window.orderBy("_hidx").rowsBetween(Window.unboundedPreceding, -1)
    per_key = per_key.select("_hidx", (F.coalesce(F.sum("_kc").over(wk), F.lit(0)) + 1).alias("_first"),
                             *[F.coalesce(F.sum(f"_ks_{c}").over(wk), F.lit(0)).alias(f"_kb_{c}") for c in range_sums])
    o = o.join(F.broadcast(per_key), "_hidx").withColumn("_seq", (F.col("_rn") - F.col("_first") + 1).cast("bigint"))
    for c in range_sums:
        o = o.withColumn(f"_cum_{c}", F.col(f"_range_{c}") - F.col(f"_kb_{c}"))

    if not lag_cols and not lead_cols:  # no neighbour values needed: no blocks
        return cold.unionByName(o.select(*cold.columns))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = F.greatest(F.lit(2), F.least(F.ceil(F.col("_n") / F.lit(parts)), F.lit(rows_per_block)))
    blk = F.floor((F.col("_rn") - 1) / block).cast("bigint")
    pos = (F.col("_rn") - 1) - blk * block
    targets = F.array(blk)
    if lag_cols:
        targets = F.when(pos == block - 1, F.array_union(targets, F.array(blk + 1))).otherwise(targets)
    if lead_cols:
        targets = F.when(pos == 0, F.array_union(targets, F.array(blk - 1))).otherwise(targets)
    u = o.withColumn("_own", blk).withColumn("_blk", F.explode(targets))
    wb = Window.partitionBy("_blk").orderBy("_rn")
    same_prev = F.lag("_hidx").over(wb) == F.col("_hidx")
    same_next = F.lead("_hidx").over(wb) == F.col("_hidx")
    for c in lag_cols:
        u = u.withColumn(f"_prev_{c}", F.when(same_prev, F.lag(c).over(wb)))
    for c in lead_cols:
        u = u.withColumn(f"_next_{c}", F.when(same_next, F.lead(c).over(wb)))
    hot_out = u.filter(F.col("_blk") == F.col("_own"))
    cols = cold.columns
    return cold.unionByName(hot_out.select(*cols))
