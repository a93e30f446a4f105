"""Mixing sources to target weights by Pareto order sampling (operator 6).

Each source gets a target in words: a share of all words by its weight, capped
at ``max_copies`` times its size, the excess shared again among the others
(one water level, found from prefix sums over the sources).  A document's
expected copies are target / size of its source, or in proportion to an
optional weight.  The whole part is certain; the fraction p is its inclusion
probability for one copy more.  Pareto order sampling ranks documents by
(u / (1 - u)) / (p / (1 - p)) with u uniform, and takes the sample of fixed
size from the front; size is counted in words here, so the sample ends at the
document whose end is nearest to its target.  The few documents that hold more
than 1/200 of their source's words are sampled first, the longest before the
rest, each tier for its share of the words and what earlier tiers left over;
all other documents are then sampled for what is left of the target.

Rows equal in source, id and text are one group of m: of the m * p rows that are
to get a copy more, the whole part is certain and only the remainder is a
document of its own in the sample; which of the equal rows get it goes by their
place in the input.

u is a hash of seed, id and text, so reruns agree however rows are spread.  No
source is sorted in one place: words are summed per (source, bucket of the
rank), only the bucket that holds the end is ranked row by row.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lists import positions
from .common import SPACE_CLASS, fresh, store

#: Buckets of the rank per source: the one that holds the end is sorted.
BUCKETS = 1 << 14
#: A document of more than 1/LONG_PARTS of its source's words is long, so a
#: source has fewer long documents than this.
LONG_PARTS = 200


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; NULL text: 0."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, SPACE_CLASS))).otherwise(0).cast("long")


def _uniform(h: Column) -> Column:
    """(0, 1) from the upper 52 bits of a hash."""
    return (F.shiftrightunsigned(h, 12).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_copies: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per
    source.  Sources in code-point order, NULL last, take the weights in turn."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    w = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn))
    w = w.withColumn("cap", F.col("source_size") * float(max_copies))
    w = w.withColumn("level", F.col("cap") / F.col("w"))  # the water level at which a source is full
    up = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("water", (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(up), F.lit(0.0)))
                     / F.sum("w").over(rest))
    # sources that are not full at the level they and the rest would share
    open_level = F.min(F.when(F.col("water") <= F.col("level"), F.struct("level", "water"))).over(every)["water"]
    return w.select("source", "source_size", F.least("cap", F.coalesce(open_level, F.col("level")) * F.col("w"))
                    .alias("target"))


def _prepare(docs: DataFrame, id_col: str, source_col: str, text_col: str, weight_col: str | None, seed: int):
    """Adds one struct column with what the sampling needs."""
    rank = fresh(docs, "mix_rank")
    source, text = F.col(f"`{source_col}`").cast("string"), F.col(f"`{text_col}`").cast("string")
    ident = F.col(f"`{id_col}`")
    weight = F.lit(1.0) if weight_col is None else F.greatest(
        F.coalesce(F.col(f"`{weight_col}`").cast("double"), F.lit(0.0)), F.lit(0.0))
    return docs.withColumn(rank, F.struct(
        source.alias("source"), word_count(text).alias("size"), weight.alias("w"),
        F.xxhash64(F.lit(seed), ident, text).alias("h1"), F.xxhash64(F.lit(seed + 1), ident, text).alias("h2"),
        F.lit(1).cast("long").alias("m"))), rank


def _count_equal(ranked: DataFrame, r: str) -> tuple[DataFrame, DataFrame]:
    """(``ranked`` with the number of equal rows in field m of the rank column,
    one stored rank per group of equal rows)."""
    groups = store(ranked.select(f"{r}.*").groupBy("source", "size", "w", "h1", "h2").agg(F.count("*").alias("m")).select(
        F.struct("source", "size", "w", "h1", "h2", "m").alias(r)), "mix-sizes")
    repeated = store(groups.where(F.col(f"{r}.m") > 1).select(
        F.col(f"{r}.source").alias("eq_source"), F.col(f"{r}.h1").alias("eq_h1"), F.col(f"{r}.h2").alias("eq_h2"),
        F.col(f"{r}.w").alias("eq_w"), F.col(f"{r}.m").alias("eq_m")), "mix-repeated")
    if repeated.isEmpty():
        return ranked, groups
    same = (F.col(f"{r}.h1") == F.col("eq_h1")) & (F.col(f"{r}.h2") == F.col("eq_h2")) & (
        F.col(f"{r}.source").eqNullSafe(F.col("eq_source")) & (F.col(f"{r}.w") == F.col("eq_w")))
    counted = ranked.join(repeated, same, "left").withColumn(r, F.col(r).withField("m", F.coalesce("eq_m", F.lit(1).cast("long"))))
    return counted.drop("eq_source", "eq_h1", "eq_h2", "eq_w", "eq_m"), groups


def _expected(r: str) -> Column:
    """Expected copies of a row joined to its source's plan (aliases in ``r``)."""
    return F.least(F.col("max_copies").cast("double"), F.when(
        F.col("source_size") > 0, F.col("target") / F.col("weighted_size") * F.col(f"{r}.w")).otherwise(F.lit(0.0)))


def _ranked(df: DataFrame, r: str) -> DataFrame:
    """Adds whole copies of a row, the certain copies more of its group of equal
    rows, the chance of one more, and the Pareto rank."""
    out = df.withColumn("_e", _expected(r)).withColumn("_whole", F.floor("_e").cast("long"))
    out = out.withColumn("_more", (F.col("_e") - F.col("_whole")) * F.col(f"{r}.m"))
    out = out.withColumn("_sure", F.floor("_more").cast("long")).withColumn("_p", F.col("_more") - F.col("_sure"))
    u = _uniform(F.col(f"{r}.h1"))
    odds = (u / (F.lit(1.0) - u)) / (F.col("_p") / (F.lit(1.0) - F.col("_p")))
    out = out.withColumn("_q", F.when(F.col("_p") > 0, odds / (F.lit(1.0) + odds)))  # monotone in the odds, in (0, 1)
    part = F.col("source_size") / F.greatest(F.col(f"{r}.size"), F.lit(1))
    out = out.withColumn("_tier", F.floor(F.log2(F.greatest(part, F.lit(1.0)))))
    out = out.withColumn("_long", F.col(f"{r}.size") * LONG_PARTS > F.col("source_size"))
    return out.withColumn("_b", F.least(F.floor(F.col("_q") * BUCKETS), F.lit(BUCKETS - 1)).cast("long"))


def _long_sample(rows: pd.DataFrame) -> pd.DataFrame:
    """One source's long documents (fewer than LONG_PARTS rows): the place
    where each tier's sample ends.  Larger tiers come first, and each makes up
    for what the tiers before it took too much or too little."""
    room, cuts, words = 0.0, [], 0
    for tier, part in rows.sort_values(["_tier", "q", "h2"]).groupby("_tier"):
        room += float((part["p"] * part["size"]).sum())
        took = part[part["size"].cumsum() - part["size"] / 2 <= room]
        if len(took):
            cuts.append({"tier": int(tier), "q": float(took["q"].iloc[-1]), "h2": int(took["h2"].iloc[-1])})
            room -= float(took["size"].sum())
            words += int(took["size"].sum())
    return pd.DataFrame({"long_source": [rows["plan_source"].iloc[0]], "long_cut": [cuts], "long_words": [words]})


def _same_source(r: str) -> Column:
    return F.col(f"{r}.source").eqNullSafe(F.col("plan_source"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
             weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_copies: int = 3, seed: int = 17,
             weight_col: str | None = None) -> tuple[DataFrame, DataFrame, str]:
    """(documents with a rank column, one row per source with its target and
    the place where its sample ends, name of the rank column).

    Nulls, empty texts, repeated rows and an empty table as in ``mix_documents``.
    Sources are ordered and filled in one task, a row each: that suits named
    sources, not a source per host of a crawl."""
    ranked, r = _prepare(docs, id_col, source_col, text_col, weight_col, seed)
    ranked, narrow = _count_equal(ranked, r)
    words = F.col(f"{r}.size") * F.col(f"{r}.m")
    sums = narrow.groupBy(F.col(f"{r}.source").alias("source")).agg(
        F.sum(words).alias("source_size"), F.sum(words * F.col(f"{r}.w")).alias("weighted_size"))
    sums = store(sums, "mix-sources")
    goal = targets(sums.select("source", "source_size"), weights, max_copies).join(
        sums.select(F.col("source").alias("s2"), "weighted_size"), F.col("source").eqNullSafe(F.col("s2"))).select(
        F.col("source").alias("plan_source"), "source_size", "target",
        F.when(F.col("weighted_size") > 0, F.col("weighted_size")).otherwise(1.0).alias("weighted_size"),
        F.lit(max_copies).alias("max_copies"))
    goal = store(goal, "mix-targets")
    rows = _ranked(narrow.join(goal, _same_source(r)), r)
    size = F.col(f"{r}.size")
    long_ = rows.where("_long and _q is not null").select(
        "plan_source", "_tier", F.col("_q").alias("q"), f"{r}.h2", size.alias("size"), F.col("_p").alias("p"))
    long_end = store(long_.groupBy("plan_source").applyInPandas(
        _long_sample, "long_source string, long_cut array<struct<tier:long,q:double,h2:long>>, long_words long"),
        "mix-long")
    by_bucket = rows.groupBy("plan_source", "target", F.when(~F.col("_long"), F.col("_b")).alias("_b")).agg(
        F.sum((F.col("_whole") * F.col(f"{r}.m") + F.col("_sure")) * size).alias("sure"),
        F.sum(F.when(F.col("_q").isNotNull(), size).otherwise(0)).alias("words"))
    by_bucket = by_bucket.join(long_end, F.col("plan_source").eqNullSafe(F.col("long_source")), "left")
    per = Window.partitionBy("plan_source")
    upto = per.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    level = by_bucket.withColumn("left", F.col("target") - F.sum("sure").over(per) - F.coalesce("long_words", F.lit(0)))
    level = level.where("_b is not null").withColumn("cum", F.sum("words").over(upto))
    cut = store(level.where("cum > left").groupBy("plan_source").agg(
        F.min(F.struct("_b", (F.col("left") - F.col("cum") + F.col("words")).alias("room"))).alias("c")).select(
        F.col("plan_source").alias("cut_source"), F.col("c._b").alias("cut_bucket"), F.col("c.room").alias("room")),
        "mix-cut")
    edge = rows.where(~F.col("_long")).join(cut, F.col("plan_source").eqNullSafe(F.col("cut_source")) & (F.col("_b") == F.col("cut_bucket")))
    before = Window.partitionBy("cut_source").orderBy("_q", f"{r}.h2").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.select("cut_source", "_q", f"{r}.h2", F.col(f"{r}.size").alias("size"), "room",
                       F.coalesce(F.sum(f"{r}.size").over(before), F.lit(0)).alias("ahead"))
    last = edge.where(F.col("ahead") + F.col("size") / 2 <= F.col("room")).groupBy("cut_source").agg(
        F.max(F.struct("_q", "h2")).alias("cut_at"))
    ends = cut.select("cut_source", "cut_bucket").join(
        last.withColumnRenamed("cut_source", "s3"), F.col("cut_source").eqNullSafe(F.col("s3")), "left").drop("s3")
    plan = goal.join(ends, F.col("plan_source").eqNullSafe(F.col("cut_source")), "left").join(
        long_end, F.col("plan_source").eqNullSafe(F.col("long_source")), "left")
    plan = store(plan.drop("cut_source", "long_source", "long_words"), "mix-plan")
    return ranked, plan, r


def with_copies(ranked: DataFrame, plan: DataFrame, r: str, out_col: str) -> DataFrame:
    """``ranked`` with the number of copies each row gets in ``out_col``.  Of
    equal rows, the first ones by their place in the input get one copy more;
    rows without words get copies by rank and add nothing; every row of
    ``ranked`` is in the result, a column named ``out_col`` is replaced; an empty
    table gives an empty one."""
    rows = _ranked(ranked.join(plan, _same_source(r)), r)
    here = F.struct(F.col("_q"), F.col(f"{r}.h2").alias("h2"))
    short = F.col("cut_bucket").isNull() | (F.col("_b") < F.col("cut_bucket")) | (
        (F.col("_b") == F.col("cut_bucket")) & F.coalesce(here <= F.col("cut_at"), F.lit(False)))
    long_ = F.coalesce(F.exists("long_cut", lambda c: (c["tier"] == F.col("_tier")) & (
        here <= F.struct(c["q"].alias("_q"), c["h2"].alias("h2")))), F.lit(False))
    more = F.col("_q").isNotNull() & F.when(F.col("_long"), long_).otherwise(short)
    rows = rows.withColumn("_sure", F.col("_sure") + F.when(more, 1).otherwise(0)).drop(
        "_e", "_more", "_p", "_q", "_b", "_tier", "_long")
    single = rows.where(F.col(f"{r}.m") == 1).withColumn(out_col, F.col("_whole") + F.col("_sure"))
    single = single.drop("_whole", "_sure")
    equal = rows.where(F.col(f"{r}.m") > 1)
    if equal.isEmpty():
        return single
    # written once, so that a row's place is the same in all that follows
    equal = store(equal.withColumn("_place", F.monotonically_increasing_id()), "mix-equal")
    group = F.concat_ws("|", f"{r}.h1", f"{r}.h2", f"{r}.w", F.coalesce(f"{r}.source", F.lit("")), F.col(f"{r}.source").isNull())
    placed = positions(equal.withColumn("_group", group), "_group", "_place")
    first = F.when(F.col("_pos") <= F.col("_sure"), 1).otherwise(0)
    return single.unionByName(placed.withColumn(out_col, F.col("_whole") + first).select(*single.columns))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix: every document as often as it is taken, with its own columns.

    NULL texts have size 0, NULL sources form one source that comes last.
    Documents without words are taken by rank like others and add nothing.
    Of rows equal in source, id and text some may get one copy more than others,
    so that a row which makes up much of a source still meets the target; ties of
    the rank do not occur otherwise.  Texts of any length are counted whole; one
    that is longer than its source's target may miss it by up to its length.
    Input columns of any name are kept as they are; an empty table gives an empty
    one.
    """
    slim = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(docs.columns)])
    at = {k: f"in_{docs.columns.index(options.pop(k, d))}"
          for k, d in (("id_col", "doc_id"), ("source_col", "source"), ("text_col", "text"))}
    if options.get("weight_col"):
        options["weight_col"] = f"in_{docs.columns.index(options['weight_col'])}"
    ranked, plan, r = mix_plan(slim, **at, **options)
    out = with_copies(ranked, plan, r, "_copies").where("_copies > 0")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return out.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)])
