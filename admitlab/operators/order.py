"""Global order without a single-task window ("bucketed order").

``row_number() OVER (ORDER BY v)`` with no PARTITION BY makes Spark move every
row into one partition.  Here the order is cut into value ranges instead:

1. ``percentile_approx`` on v gives cut values (any cuts give an exact result;
   they only steer balance).  A value that fills more than one quantile is
   "hot": its rows are split again into equal-width ranges of the unique
   tie-break column, which keeps the (v, tiebreak) order.  NULLs form their
   own range, split the same way when large.
2. ``Bucketizer`` (binary search in the JVM) maps each row to its range; the
   range key (b1, b2) sorts like (v, tiebreak).
3. Inside a range, ordinary windows give local row numbers, ranks, counts and
   running sums.
4. One small aggregate gives per-range counts and sums; a window over that
   table (one row per range: bounded by the number of ranges we chose) gives
   offsets, which are broadcast back and added.

Results equal Spark's own global ``row_number``, ``rank``, ``dense_rank``,
``cume_dist``, ``ntile`` and running sums (ROWS and RANGE frames) for the
order (v [desc], tiebreak asc) - see tests/test_order.py.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


@dataclass(frozen=True)
class OrderSpec:
    value: str                      # column giving the order
    tiebreak: str = "id"            # unique integer column breaking ties (ascending)
    descending: bool = False
    nulls_first: bool | None = None  # default as PostgreSQL: last for ASC, first for DESC

    @property
    def nulls_go_first(self) -> bool:
        return self.descending if self.nulls_first is None else self.nulls_first


def _as_double(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    if isinstance(t, T.DateType):
        return F.unix_date(F.col(c)).cast("double")
    if isinstance(t, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    return F.col(c).cast("double")


def _default_buckets(spark, n_rows: int, rows_per_bucket: int) -> int:
    """About four ranges per shuffle partition (range ids are hash-partitioned,
    so several small ranges per task even out collisions), more when ranges
    would exceed ``rows_per_bucket`` rows."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, 4 * parts, math.ceil(n_rows / max(1, rows_per_bucket)))


@dataclass
class OrderPlan:
    """What the planning pass learned: sizes, cut values, hot values."""
    n_rows: int
    n_val: int
    cuts: list
    hot_info: dict
    null_split: tuple | None


def plan_order(df: DataFrame, spec: OrderSpec, n_buckets: int | None = None,
               rows_per_bucket: int = 5_000_000) -> OrderPlan:
    """One aggregate gives the row counts, the tie-break range of the NULL
    group and ``percentile_approx`` cut values (one per range); only when the
    data is larger than the first guess of ranges, or a value fills several
    ranges, a second small job follows.  Everything returned to the driver is
    bounded by the number of ranges."""
    spark = df.sparkSession
    v, tb = spec.value, spec.tiebreak
    vd = F.col("_vd")
    base = df.select(_as_double(df, v).alias("_vd"), F.col(tb))
    k0 = n_buckets or _default_buckets(spark, 0, rows_per_bucket)

    def quantiles(k: int):
        probs = F.array(*[F.lit(i / k) for i in range(1, k)]) if k > 1 else F.array(F.lit(0.5))
        return F.percentile_approx(vd, probs, max(10000, 4 * k))

    s0 = base.agg(F.count(F.lit(1)).alias("n"), F.count(vd).alias("nv"),
                  F.min(F.when(vd.isNull(), F.col(tb))).alias("nmin"),
                  F.max(F.when(vd.isNull(), F.col(tb))).alias("nmax"),
                  quantiles(k0).alias("q")).first()
    n_rows, n_val = int(s0["n"]), int(s0["nv"])
    k = n_buckets or _default_buckets(spark, n_rows, rows_per_bucket)
    if k == k0:
        cuts = list(s0["q"] or []) if k > 1 else []
    else:
        cuts = list(base.agg(quantiles(k).alias("q")).first()["q"] or [])
    target = max(1, math.ceil(n_rows / k))
    mult: dict = {}
    for c in cuts:
        mult[c] = mult.get(c, 0) + 1
    hot = [c for c in sorted(mult) if mult[c] >= 2]
    hot_info = {}
    if hot:
        # hot values are at most the number of ranges: a table, not literals
        values = F.broadcast(spark.createDataFrame([(h,) for h in hot], "_ord_v double"))
        found = (base.join(values, vd == F.col("_ord_v")).groupBy("_ord_v")
                 .agg(F.min(tb).alias("lo"), F.max(tb).alias("hi"), F.count(F.lit(1)).alias("c")))
        hot_info = {r["_ord_v"]: (int(r["lo"]), int(r["hi"]), max(1, math.ceil(r["c"] / target)))
                    for r in found.collect()}
    null_split = None
    if n_rows - n_val > 0:
        null_split = (int(s0["nmin"]), int(s0["nmax"]), max(1, math.ceil((n_rows - n_val) / target)))
    return OrderPlan(n_rows, n_val, cuts, hot_info, null_split)


def ordered(df: DataFrame, spec: OrderSpec, sums: tuple[str, ...] = (),
            n_buckets: int | None = None, rows_per_bucket: int = 5_000_000,
            plan: OrderPlan | None = None,
            keep_ranges: bool = False, materialize: bool = False, dense: bool = False) -> DataFrame:
    """``df`` plus the global order columns:

    ``_rn`` row number, ``_rank``, ``_dense_rank`` (only with ``dense=True``),
    ``_le`` (rows up to the end
    of the row's tie group: ``cume_dist = _le / _n``), ``_n`` (rows), and for
    every column s in ``sums``: ``_rows_<s>`` (running sum, ROWS frame) and
    ``_range_<s>`` (running sum, RANGE frame: ties share), NULL while no
    non-NULL value has been seen, like SQL's SUM; ``_rangen_<s>`` counts the
    non-NULL values in the RANGE frame.

    Planning (``plan_order``) is one small job in the common case; the plan
    itself has one exchange for the rows (hash-partitioned by range).  The
    input is read by both; when it is an expensive derivation (a large join),
    ``materialize=True`` first checkpoints it to the shared checkpoint folder
    so both read the stored rows - pass a narrow projection.

    Ties are detected on the value as a double, so splitting a tied value by
    id ranges assumes distinct values stay distinct as doubles (integers,
    dates, decimals below 2**53 in their last digit); any value order is kept
    either way."""
    if materialize and plan is None:
        df = df.checkpoint(eager=True)
    v, tb = spec.value, spec.tiebreak
    vd = "_vd"
    base = df.withColumn(vd, _as_double(df, v))
    op = plan or plan_order(df, spec, n_buckets, rows_per_bucket)
    distinct_cuts = sorted(set(op.cuts))
    hot_info, null_split = op.hot_info, op.null_split

    # -- range key
    splits = [-math.inf] + distinct_cuts + [math.inf]
    jmax = len(distinct_cuts)  # bucket indices 0..jmax
    if distinct_cuts:
        bkt = Bucketizer(splits=splits, inputCol=vd, outputCol="_major", handleInvalid="keep")
        b = bkt.transform(base.withColumn(vd, F.coalesce(F.col(vd), F.lit(0.0))))
        b = b.withColumn(vd, _as_double(df, v))
    else:
        b = base.withColumn("_major", F.lit(0.0))
    major = F.col("_major").cast("int")
    if spec.descending:
        pos = F.lit(jmax) - major
    else:
        pos = major
    null_pos = F.lit(-1) if spec.nulls_go_first else F.lit(jmax + 1)
    b1 = F.when(F.col(vd).isNull(), null_pos).otherwise(pos)

    def piece(lo: int, hi: int, m: int) -> Column:
        return F.floor((F.col(tb) - F.lit(lo)) * F.lit(m) / F.lit(hi - lo + 1)).cast("int")

    # b2 orders rows inside a major range; hp: 0 plain, 1 first piece of a
    # hot value, 2 later piece
    b2 = F.lit(0)
    hp = F.lit(0)
    if null_split and null_split[2] > 1:
        lo, hi, m = null_split
        p = piece(lo, hi, m)
        b2 = F.when(F.col(vd).isNull(), p).otherwise(b2)
        hp = F.when(F.col(vd).isNull(), F.when(p == 0, 1).otherwise(2)).otherwise(hp)
    split_cols = ["_ord_at", "_ord_v", "_ord_lo", "_ord_hi", "_ord_m"]
    if hot_info:
        # one row per hot value (at most the number of ranges), met by range:
        # bucket i covers [splits[i], splits[i+1]), so a hot value opens its range
        at = {c: i + 1 for i, c in enumerate(distinct_cuts)}
        hot = df.sparkSession.createDataFrame([(at[h], h, *split) for h, split in hot_info.items()],
                                              "_ord_at int, _ord_v double, _ord_lo long, _ord_hi long, _ord_m int")
        b = b.join(F.broadcast(hot), F.col(vd).isNotNull() & (major == F.col("_ord_at")), "left")
        lo, hi, m = (F.col(c) for c in split_cols[2:])
        eq = F.col(vd) == F.col("_ord_v")
        p = F.floor((F.col(tb) - lo) * m / (hi - lo + 1)).cast("int")
        # descending: larger values of the range come first
        inside = F.when(eq, p + 1).otherwise(0) if spec.descending else F.when(eq, p).otherwise(m)
        b2 = F.when(F.col("_ord_v").isNotNull(), inside).otherwise(b2)
        hp = F.when(eq, F.when(p == 0, 1).otherwise(2)).otherwise(hp)
    b = (b.withColumn("_b1", b1).withColumn("_b2", b2.cast("int")).withColumn("_hp", hp.cast("int"))
          .drop("_major", *split_cols))
    keyed = b  # rows with their range key (feeds the small range table)

    # -- local windows
    vcol = F.col(v)
    if spec.descending:
        vo = vcol.desc_nulls_first() if spec.nulls_go_first else vcol.desc_nulls_last()
    else:
        vo = vcol.asc_nulls_first() if spec.nulls_go_first else vcol.asc_nulls_last()
    part = Window.partitionBy("_b1", "_b2")
    w_full = part.orderBy(vo, F.col(tb).asc())
    w_val = part.orderBy(vo)
    w_val_range = w_val.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    w_full_rows = w_full.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    loc = (b.withColumn("_lrn", F.row_number().over(w_full))
             .withColumn("_lrank", F.rank().over(w_val))
             .withColumn("_ldense", F.dense_rank().over(w_val))
             .withColumn("_lle", F.count(F.lit(1)).over(w_val_range)))
    for s in sums:
        loc = (loc.withColumn(f"_lsr_{s}", F.sum(s).over(w_full_rows))
                  .withColumn(f"_lcr_{s}", F.count(s).over(w_full_rows))
                  .withColumn(f"_lsg_{s}", F.sum(s).over(w_val_range))
                  .withColumn(f"_lcg_{s}", F.count(s).over(w_val_range)))

    # -- per-range table (<= number of ranges rows) and its offsets.  Counts
    # and sums are a partial aggregate of the rows (one row per range and
    # task is shuffled).  Dense ranks also need distinct values per range:
    # then the table is aggregated from the local windows (already
    # partitioned by range), their largest row number and dense rank.
    sum_aggs = []
    for s in sums:
        sum_aggs += [F.sum(s).alias(f"_bs_{s}"), F.count(s).alias(f"_bn_{s}")]
    if dense:
        st = loc.groupBy("_b1", "_b2").agg(F.max("_lrn").alias("_bc"), F.max("_ldense").alias("_bd"),
                                           F.max("_hp").alias("_bhp"), *sum_aggs)
    else:
        st = keyed.groupBy("_b1", "_b2").agg(F.count(F.lit(1)).alias("_bc"), F.lit(0).alias("_bd"),
                                         F.max("_hp").alias("_bhp"), *sum_aggs)
    wo = Window.orderBy("_b1", "_b2")  # over the range table only
    before = wo.rowsBetween(Window.unboundedPreceding, -1)
    dadj = F.when(F.col("_bhp") == 2, 0).otherwise(F.col("_bd"))
    st = (st.withColumn("_off", F.coalesce(F.sum("_bc").over(before), F.lit(0)))
            .withColumn("_doff", F.coalesce(F.sum(dadj).over(before), F.lit(0)))
            .withColumn("_n", F.sum("_bc").over(Window.partitionBy())))
    for s in sums:
        st = (st.withColumn(f"_soff_{s}", F.coalesce(F.sum(f"_bs_{s}").over(before), F.lit(0)))
                .withColumn(f"_noff_{s}", F.coalesce(F.sum(f"_bn_{s}").over(before), F.lit(0))))
    # a hot value (or the NULL group) spans the pieces of one major range
    wm = Window.partitionBy("_b1")
    hotp = F.col("_bhp") > 0
    st = (st.withColumn("_hstart", F.min(F.when(hotp, F.col("_off"))).over(wm))
            .withColumn("_hdstart", F.min(F.when(hotp, F.col("_doff"))).over(wm))
            .withColumn("_hend", F.max(F.when(hotp, F.col("_off") + F.col("_bc"))).over(wm)))
    for s in sums:
        # running sums need not grow (negative values): take the last piece
        last = F.when(hotp, F.col("_b2"))
        st = (st.withColumn(f"_hsend_{s}", F.max_by(F.col(f"_soff_{s}") + F.coalesce(F.col(f"_bs_{s}"), F.lit(0)), last).over(wm))
                .withColumn(f"_hnend_{s}", F.max(F.when(hotp, F.col(f"_noff_{s}") + F.col(f"_bn_{s}"))).over(wm)))
    keep = ["_b1", "_b2", "_off", "_doff", "_n", "_hstart", "_hdstart", "_hend"]
    for s in sums:
        keep += [f"_soff_{s}", f"_noff_{s}", f"_hsend_{s}", f"_hnend_{s}"]
    # the range table has one row per range: its size is bounded by our own
    # choice of ranges (k plus the pieces of hot values), so broadcasting it is safe
    st = F.broadcast(st.select(*keep))

    j = loc.join(st, ["_b1", "_b2"])
    hot_row = F.col("_hp") > 0
    out = (j.withColumn("_rn", F.col("_off") + F.col("_lrn"))
            .withColumn("_rank", F.when(hot_row, F.col("_hstart") + 1).otherwise(F.col("_off") + F.col("_lrank")))
            .withColumn("_dense_rank", F.when(hot_row, F.col("_hdstart") + 1).otherwise(F.col("_doff") + F.col("_ldense")))
            .withColumn("_le", F.when(hot_row, F.col("_hend")).otherwise(F.col("_off") + F.col("_lle"))))
    for s in sums:
        rows_n = F.col(f"_noff_{s}") + F.col(f"_lcr_{s}")
        rows_s = F.col(f"_soff_{s}") + F.coalesce(F.col(f"_lsr_{s}"), F.lit(0))
        rng_n = F.when(hot_row, F.col(f"_hnend_{s}")).otherwise(F.col(f"_noff_{s}") + F.col(f"_lcg_{s}"))
        rng_s = F.when(hot_row, F.col(f"_hsend_{s}")).otherwise(
            F.col(f"_soff_{s}") + F.coalesce(F.col(f"_lsg_{s}"), F.lit(0)))
        out = (out.withColumn(f"_rows_{s}", F.when(rows_n > 0, rows_s))
                  .withColumn(f"_range_{s}", F.when(rng_n > 0, rng_s))
                  .withColumn(f"_rangen_{s}", rng_n))
    keep = list(df.columns) + ["_rn", "_rank", "_le", "_n"] + (["_dense_rank"] if dense else [])
    if keep_ranges:  # the range key, for balance checks
        keep += ["_b1", "_b2"]
    for s_ in sums:
        keep += [f"_rows_{s_}", f"_range_{s_}", f"_rangen_{s_}"]
    return out.select(*keep)


def ntile(n_buckets: int, rn: Column, total: Column) -> Column:
    """NTILE(n) from a 1-based row number and the row count: the first
    N mod n tiles get one extra row."""
    i = rn - 1
    q = F.floor(total / n_buckets)
    r = total - q * n_buckets
    big = r * (q + 1)
    return F.when(q == 0, i + 1).when(i < big, F.floor(i / (q + 1)) + 1).otherwise(
        r + F.floor((i - big) / F.greatest(q, F.lit(1))) + 1).cast("int")


def moving_frame(df: DataFrame, order_col: str, value_cols: list[str], preceding: int,
                 n_buckets: int | None = None, rows_per_block: int = 5_000_000) -> DataFrame:
    """Sums and counts over ``ROWS BETWEEN preceding PRECEDING AND CURRENT
    ROW`` ordered by a unique numeric column without NULLs, without a single-task
    window.

    Rows are cut into blocks by ranges of the column (quantile cuts); the last
    ``preceding`` rows of each block, found by a top-k per task and block, are
    copied into the next block as a halo; the window runs per block and halo rows
    are dropped.  So the rows move once.  Blocks are few enough that each has at
    least ``preceding`` rows: quantile cuts are off by at most a quarter of a
    block, and a block is eight times that long.  Adds ``_win_sum_<c>`` and
    ``_win_cnt_<c>`` per value column."""
    spec = OrderSpec(order_col, tiebreak=order_col)
    plan = plan_order(df, spec, n_buckets, rows_per_block)
    most = max(1, plan.n_rows // (8 * max(1, preceding)))
    step = math.ceil((len(plan.cuts) + 1) / most)  # so many ranges make a block
    cuts = sorted(set(plan.cuts[step - 1::step]))
    at = df.withColumn("_vd", F.col(order_col).cast("double"))
    if cuts:
        at = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_vd", outputCol="_blk").transform(at)
    else:
        at = at.withColumn("_blk", F.lit(0.0))
    at = at.withColumn("_halo", F.lit(False)).drop("_vd")
    if cuts and preceding:
        last = Window.partitionBy("_blk").orderBy(F.col(order_col).desc())
        tail = (at.select(order_col, *value_cols, "_blk", F.row_number().over(last).alias("_last"))
                .where(F.col("_last") <= preceding).drop("_last"))
        at = at.unionByName(tail.withColumn("_blk", F.col("_blk") + 1).withColumn("_halo", F.lit(True)), allowMissingColumns=True)
    w = Window.partitionBy("_blk").orderBy(order_col).rowsBetween(-preceding, 0)
    for c in value_cols:
        at = at.withColumn(f"_win_sum_{c}", F.sum(c).over(w)).withColumn(f"_win_cnt_{c}", F.count(c).over(w))
    return at.filter(~F.col("_halo")).drop("_blk", "_halo")
