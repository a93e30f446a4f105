"""Walk a parent-pointer tree upwards (the recursive CTE, as a loop of joins).

``ancestors`` lifts by powers of two: after round k every node knows its ancestor
2^k levels up, and the paths found so far are extended by their whole length at
once, so a path of n levels needs about log2(n) rounds.  ``walk_up`` is the plain
walk, one join a level; ``roots`` finds the top of every node.  Each round is
stored in the shared folder, so none recomputes the joins before it.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def walk_up(nodes: DataFrame, start: DataFrame, node_col: str, parent_col: str) -> DataFrame:
    """All ancestors of the ``start`` rows (rows of ``nodes``), with ``level``
    1 for the start row itself, 2 for its parent, ... whatever the depth.

    ``_path`` keeps the visited node keys so a cycle ends the walk instead of
    looping for ever.  Every level is one join, at every size."""
    cols = nodes.columns
    frontier = start.select(*cols, F.lit(1).alias("level"),
                            F.array(F.col(node_col)).alias("_path"))
    result, depth = frontier, 1
    while True:
        depth += 1
        step = (frontier.alias("rc")
                .join(nodes.alias("d"), F.col(f"d.{node_col}") == F.col(f"rc.{parent_col}"))
                .filter(~F.array_contains(F.col("rc._path"), F.col(f"d.{node_col}")))
                .select(*[F.col(f"d.{c}").alias(c) for c in cols],
                        F.lit(depth).alias("level"),
                        F.concat(F.col("rc._path"), F.array(F.col(f"d.{node_col}"))).alias("_path")))
        # the frontier is written to the shared checkpoint folder: the next
        # step reads it instead of recomputing all earlier joins
        step = step.checkpoint(eager=True)
        if step.isEmpty():
            break
        result = result.unionByName(step)
        frontier = step
    return result.drop("_path")


def ancestors(nodes: DataFrame, starts: DataFrame, node_col: str, parent_col: str) -> DataFrame:
    """(start, node, level) for every node on the way up from each start: level 1
    is the start itself.  ``starts`` has a column ``start``; those without a row
    in ``nodes`` have no path.

    A round is one stored table that holds the jumps of 2^k levels (``n`` NULL)
    and the paths (``n`` levels above ``node``'s start), so nothing but its
    numbers of jumps and path rows reaches the driver.  No path is gathered in a row: a
    cycle shows as a node met before, keeps its lowest level and ends the loop.
    Parents that have no row end a path; repeated rows of a node count once."""
    spark = nodes.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ancestors-{uuid.uuid4().hex}"
    known = nodes.where(F.col(node_col).isNotNull()).groupBy(F.col(node_col).cast("long").alias("node")).agg(
        F.min(F.col(parent_col).cast("long")).alias("up"))
    up = known.join(known.select(F.col("node").alias("up")), "up", "left_semi")  # parents that have a row
    none = F.lit(None).cast("long")
    begin = starts.select(F.col("start").cast("long").alias("node")).distinct().join(known.select("node"), "node", "left_semi")
    rows = up.select("node", "up", none.alias("start"), none.alias("n")).unionByName(
        begin.select("node", none.alias("up"), F.col("node").alias("start"), F.lit(0).cast("long").alias("n")))
    size, k = -1, 0
    while True:
        counted = Observation()
        rows.observe(counted, F.count("n").alias("paths"), F.count("up").alias("jumps")).write.parquet(f"{folder}/{k}")
        rows = spark.read.schema(rows.schema).parquet(f"{folder}/{k}")
        # no node has an ancestor that far up, or no path grew: what is left runs in a cycle
        if counted.get["jumps"] == 0 or counted.get["paths"] == size:
            break
        size = counted.get["paths"]
        jump, path = rows.where("n is null"), rows.where("n is not null")
        over = jump.select(F.col("node").alias("at"), F.col("up").alias("to"))
        longer = (path.join(over, path.node == over.at)
                  .select(F.col("to").alias("node"), "start", (F.col("n") + (1 << k)).alias("n")))
        paths = (path.select("node", "start", "n").unionByName(longer).groupBy("node", "start").agg(F.min("n").alias("n"))
                 .select("node", none.alias("up"), "start", "n"))
        rows = jump.join(over, jump.up == over.at).select("node", F.col("to").alias("up"), "start", "n").unionByName(paths)
        k += 1
    return rows.where("n is not null").select("start", "node", (F.col("n") + 1).cast("int").alias("level"))


def roots(nodes: DataFrame, node_col: str, parent_col: str) -> DataFrame:
    """Top-level ancestor and depth of EVERY node (pointer doubling).

    Each node keeps a pointer ``up`` (its parent; a root points to itself)
    and the distance ``d`` to it.  Every round replaces the pointer by the
    pointer's pointer (one join of the table with itself on ``up = node``)
    and adds the distances, so after k rounds a node has jumped 2^k levels:
    a tree of depth D needs about log2(D) joins instead of D.  Rounds stop
    when no pointer moves; each round is
    checkpointed to the shared folder.  A root is a node without a parent in
    the table; a node whose pointer does not end on a root (it is in, or
    leads into, a cycle) gets a NULL root and depth.

    Output: node, root, depth (a root has depth 0)."""
    n, p = F.col(node_col), F.col(parent_col)
    ids = nodes.select(n.alias("_pid"))
    # a parent missing from the table ends the chain like a NULL parent
    base = nodes.join(ids, p == F.col("_pid"), "left").select(n.alias("node"), F.col("_pid").alias("parent"))
    cur = base.select("node", F.coalesce("parent", "node").alias("up"),
                      F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("d"),
                      F.col("parent").isNull().alias("is_root")).checkpoint(eager=True)
    for _ in range(math.ceil(math.log2(cur.count() + 1)) + 1):
        nxt = (cur.alias("a").join(cur.alias("b"), F.col("a.up") == F.col("b.node"))
                  .select(F.col("a.node").alias("node"), F.col("b.up").alias("up"),
                          (F.col("a.d") + F.col("b.d")).alias("d"), F.col("a.is_root").alias("is_root"),
                          (F.col("b.up") != F.col("a.up")).alias("_moved")))
        nxt = nxt.checkpoint(eager=True)
        cur = nxt.drop("_moved")
        if nxt.filter("_moved").isEmpty():
            break
    top = cur.alias("a").join(cur.select(F.col("node").alias("_r"), F.col("is_root").alias("_ok")),
                              F.col("a.up") == F.col("_r"))
    ok = F.col("_ok")
    return top.select(F.col("a.node").alias(node_col), F.when(ok, F.col("a.up")).alias("root"),
                      F.when(ok, F.col("a.d")).alias("depth"))
