"""Embedding near-duplicates by an epsilon grid order join (operator 9).

Unit vectors with cosine >= t lie within eps = sqrt(2 - 2 t) of each other.
They are put in the order of their grid cells of width eps on the leading
principal dimensions.  The order is cut into intervals of equal length; two
intervals whose boxes in those dimensions are further apart than eps hold no
link and are never joined.  Each remaining pair of intervals is one group: its
sequences are halved again and again, pieces that are provably distant are
skipped, and what is left is multiplied block by block in double precision.

Equal vectors are one row with a count.  A group returns one row per vector
that has a link in it (its number of links and the smallest vector of its
component there), never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store
from .components import connected_components

PRINCIPAL = 8
#: Vectors of an interval, and of a block that is not halved further.
INTERVAL_ROWS = 8192
BLOCK_ROWS = 512
#: Products this near the threshold are computed again, pair by pair.
DOUBT = 1e-12


def _vectors(col: pa.Array, width: int) -> np.ndarray:
    flat = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)  # large components must not overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, width: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and leading axes of the unit vectors: sums over all rows, of which
    width * (width + 1) + 1 numbers reach the driver."""
    schema = pa.schema([("at", pa.int32()), ("v", pa.float64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, one, two = 0, np.zeros(width), np.zeros((width, width))
        for b in parts:
            if b.num_rows:
                x = _unit(_vectors(b.column(0), width))
                n, one, two = n + len(x), one + x.sum(axis=0), two + x.T @ x
        if n:
            v = np.concatenate([[n], one, two.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)], schema=schema)

    got = vectors.select("embedding").mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
    v = got.sort_values("at")["v"].to_numpy()
    n, one, two = v[0], v[1:width + 1], v[width + 1:].reshape(width, width)
    mean = one / n
    _, axes = np.linalg.eigh(two / n - np.outer(mean, mean))
    return mean, axes[:, ::-1][:, :k]


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row number in the component of each of ``n`` rows."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            return label
        label = low


class SequenceJoin:
    """The recursive join of two intervals of the grid order (or of one with
    itself: ``split`` is then the number of rows)."""

    def __init__(self, unit: np.ndarray, places: np.ndarray, counts: np.ndarray, threshold: float, eps: float):
        self.x, self.y, self.n, self.t, self.eps = unit, places, counts, threshold, eps
        self.links = np.zeros(len(unit), np.int64)
        self.edges: list[np.ndarray] = []
        self.multiplied = 0

    def _far(self, a: slice, b: slice) -> bool:
        ya, yb = self.y[a], self.y[b]
        gap = np.maximum(0.0, np.maximum(yb.min(axis=0) - ya.max(axis=0), ya.min(axis=0) - yb.max(axis=0)))
        return float(gap @ gap) > self.eps * self.eps * (1 + 1e-9) + 1e-12

    def join(self, a: slice, b: slice) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            same = a == b
            na, nb = a.stop - a.start, b.stop - b.start
            if not na or not nb or (not same and self._far(a, b)):
                continue
            if na <= BLOCK_ROWS and nb <= BLOCK_ROWS:
                self._block(a, b)
                continue
            if same:
                m = a.start + na // 2
                p, q = slice(a.start, m), slice(m, a.stop)
                todo += [(p, p), (p, q), (q, q)]
            elif na >= nb:
                m = a.start + na // 2
                todo += [(slice(a.start, m), b), (slice(m, a.stop), b)]
            else:
                m = b.start + nb // 2
                todo += [(a, slice(b.start, m)), (a, slice(m, b.stop))]

    def _block(self, a: slice, b: slice) -> None:
        s = self.x[a] @ self.x[b].T
        self.multiplied += s.size
        hit = s >= self.t
        for i, j in zip(*np.nonzero(np.abs(s - self.t) < DOUBT), strict=True):
            hit[i, j] = math.fsum(self.x[a.start + i] * self.x[b.start + j]) >= self.t
        if a == b:
            np.fill_diagonal(hit, False)
            self.links[a] += hit @ self.n[b]
        else:
            self.links[a] += hit @ self.n[b]
            self.links[b] += self.n[a] @ hit
        i, j = np.nonzero(hit)
        if len(i):
            i, j = i + a.start, j + b.start
            rows, at = np.unique(np.concatenate([i, j]), return_inverse=True)
            low = components(len(rows), at[:len(i)], at[len(i):])
            away = low != np.arange(len(rows))
            self.edges.append(np.column_stack([rows[away], rows[low[away]]]))

    def labels(self) -> np.ndarray:
        e = np.concatenate(self.edges) if self.edges else np.empty((0, 2), np.int64)
        return components(len(self.x), e[:, 0], e[:, 1])


def near_vectors(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding",
                 interval_rows: int = INTERVAL_ROWS, principal: int = PRINCIPAL) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row.

    ``n_links`` counts the other rows at cosine >= ``threshold`` in double
    precision, ``component_id`` is the smallest id that links reach.  Vectors
    that are NULL, empty, zero, or hold NULL or non-finite components link with
    nothing; vectors of different lengths never link, and each length that two
    rows share is joined on its own, one after another (lengths are few).  A row
    with a NULL id counts as a link of others and has the component of its
    equals.  Repeated rows are rows of their own; extra columns are ignored; an
    empty table gives an empty one.
    """
    eps = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    vec = F.col("embedding")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce((F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("embedding"))
    rows = store(rows.withColumn("width", F.when(usable, F.size(vec))), "ego-rows")
    counts = rows.where("width is not null").groupBy("width").count().where("count > 1")
    widths = sorted(r["width"] for r in counts.collect())
    rest = rows.where(~F.col("width").isin(widths) | F.col("width").isNull()) if widths else rows
    out = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                      F.lit(True).alias("kept"))
    for width in widths:
        used = rows.where(F.col("width") == width)
        out = out.unionByName(_linked(used, width, threshold, eps, interval_rows, principal))
    return out


def _linked(used: DataFrame, width: int, threshold: float, eps: float, interval_rows: int, principal: int) -> DataFrame:
    """``near_vectors`` of usable vectors of one length, rows (vec_id, embedding)."""
    # one row per different vector; "low" is NULL if none of its rows has an id
    reps = store(used.groupBy("embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"))
                 .withColumn("rep", F.monotonically_increasing_id()), "ego-reps")
    mean, axes = principal_axes(reps, width, min(principal, width))
    sc = used.sparkSession.sparkContext
    frame = sc.broadcast((mean, axes))

    @F.arrow_udf("array<double>")
    def place(v: pa.Array) -> pa.Array:
        m, w = frame.value
        y = (_unit(_vectors(v, width)) - m) @ w
        return pa.FixedSizeListArray.from_arrays(pa.array(y.ravel()), y.shape[1]).cast(pa.list_(pa.float64()))

    placed = reps.select("rep", "n", "embedding", place("embedding").alias("y"))
    cells = [F.floor(F.get("y", F.lit(i)) / eps if eps else F.get("y", F.lit(i))).alias(f"c{i}") for i in range(axes.shape[1])]
    placed = placed.select("*", *cells)
    keys = [f"c{i}" for i in range(axes.shape[1])] + ["rep"]
    order = store(placed.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "rep", "n", "embedding", "y", "c0", F.monotonically_increasing_id().alias("at")), "ego-order")
    part = F.shiftright("at", 33)
    # one row per partition: its rows before it
    starts = order.groupBy(part.alias("part")).count().select("part", F.coalesce(F.sum("count").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    rank = F.col("start") + F.col("at") - F.shiftleft("part", 33)
    order = store(order.withColumn("part", part).join(starts, "part").select(
        "rep", "n", "embedding", "y", "c0", rank.alias("rank"), F.floor(rank / interval_rows).cast("long").alias("interval")),
        "ego-intervals")
    dims = range(axes.shape[1])
    boxes = store(order.groupBy("interval").agg(
        F.min("c0").alias("first"), F.max("c0").alias("last"),
        F.array(*[F.min(F.get("y", F.lit(i))) for i in dims]).alias("lo"),
        F.array(*[F.max(F.get("y", F.lit(i))) for i in dims]).alias("hi")), "ego-boxes")
    left = boxes.select(F.col("interval").alias("i"), F.col("lo").alias("lo1"), F.col("hi").alias("hi1"),
                        F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)).alias("cell"))
    right = boxes.select(F.col("interval").alias("j"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"),
                         F.explode(F.sequence("first", "last")).alias("cell"))
    gaps = [F.greatest(F.lit(0.0), F.get("lo2", F.lit(d)) - F.get("hi1", F.lit(d)),
                       F.get("lo1", F.lit(d)) - F.get("hi2", F.lit(d))) for d in dims]
    near = sum((g * g for g in gaps), F.lit(0.0)) <= eps * eps * (1 + 1e-9) + 1e-12
    pairs = left.join(right, "cell").where((F.col("i") <= F.col("j")) & near).select("i", "j").distinct()
    pairs = store(pairs, "ego-pairs")
    sides = pairs.select("i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("interval"))
    tiles = order.select("rep", "n", "embedding", "rank", "interval").join(sides, "interval")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        rep, n = table["rep"].to_numpy(), table["n"].to_numpy()
        x = _unit(_vectors(table["embedding"], width))
        m, w = frame.value
        job = SequenceJoin(x, (x - m) @ w, n, threshold, eps)
        every, i, j = slice(0, len(rep)), table["i"][0].as_py(), table["j"][0].as_py()
        if i == j:
            job.join(every, every)
        else:
            cut = int((table["interval"].to_numpy() == i).sum())
            job.join(slice(0, cut), slice(cut, len(rep)))
        hit = np.flatnonzero(job.links)
        label = job.labels()
        return pa.table({"rep": rep[hit], "links": job.links[hit], "peer": rep[label[hit]]})

    found = store(tiles.groupBy("i", "j").applyInArrow(run, "rep long, links long, peer long"), "ego-found")
    comp = connected_components(found.select("rep", "peer"), "rep", "peer")
    named = reps.join(found.groupBy(F.col("rep").alias("r1")).agg(F.sum("links").alias("links")),
                      F.col("rep") == F.col("r1"), "left")
    named = named.join(comp.select(F.col("node").alias("r2"), "component"), F.col("rep") == F.col("r2"), "left")
    named = named.select("embedding", "low", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                         F.coalesce("component", "rep").alias("group"))
    lowest = named.groupBy("group").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "group").select("embedding", "n_links", "component_id")
    return used.join(named, "embedding").select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"),
                                                        F.col("component_id").isNull()).alias("kept"))
