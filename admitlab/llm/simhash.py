"""SimHash near-duplicates by pigeonhole blocks (operator 3).

A 64-bit fingerprint sums the bits of the XXH64 hashes of a text's word
shingles.  It is cut into ``max_bits + 2`` blocks; two fingerprints that differ
in ``max_bits`` bits or fewer agree in two blocks at least, so each pair of
blocks is a join key and every joined pair is verified by its Hamming distance.
Equal fingerprints are one row before the join.

A key that more than ``hot_key`` different fingerprints share is not paired off:
its fingerprints emit themselves and their 64 one-bit neighbours.  Fingerprints
that emit a common value lie within two bits of each other, and those within
two bits do emit one, so linking the at most 65 emitters of a value to the
smallest of them loses no component and needs no pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower_words, fresh, store, text_or_empty
from .components import connected_components

HASHES_AT_ONCE = 1 << 14


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of a text; a text without words has 0, one of
    fewer words than ``shingle`` hashes its whole word sequence."""
    words = ascii_lower_words(text)
    if not words:
        return 0
    if len(words) < shingle:
        parts = iter([b" ".join(words)])
        n = 1
    else:
        parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
        n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    left = n
    while left:
        m = min(left, HASHES_AT_ONCE)
        h = np.fromiter((digest(next(parts), seed) for _ in range(m)), np.uint64, m)
        ones += np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        left -= m
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t or "", shingle, seed) for t in texts.to_pylist()], pa.int64())
    return run(text)


def _key(fp: Column, blocks: list[tuple[int, int]]) -> Column:
    """The bits of some blocks (offset, width), the others zero."""
    mask = sum(((1 << w) - 1) << o for o, w in blocks)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask).cast("long"))


def links(points: DataFrame, max_bits: int = 2, hot_key: int = 256) -> DataFrame:
    """Links (a, b) among rows (node, fp) of different fingerprints such that
    the components of all pairs within ``max_bits`` are those of the links."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    n = max_bits + 2
    edge = [64 * i // n for i in range(n + 1)]
    blocks = [(edge[i], edge[i + 1] - edge[i]) for i in range(n)]
    keys = F.array(*[F.struct(F.lit(i).alias("no"), _key(F.col("fp"), list(p)).alias("key"))
                     for i, p in enumerate(combinations(blocks, 2))])
    keyed = store(points.where("node is not null").select("node", "fp", F.explode(keys).alias("k"))
                  .select("node", "fp", "k.no", "k.key"), "simhash-keys")
    sizes = keyed.groupBy("no", "key").agg(F.count("*").alias("size")).where("size > 1")
    shared = store(keyed.join(sizes, ["no", "key"]), "simhash-shared")
    cold = shared.where(F.col("size") <= hot_key)
    left = cold.select("no", "key", F.col("node").alias("a"), F.col("fp").alias("fa"))
    right = cold.select("no", "key", F.col("node").alias("b"), F.col("fp").alias("fb"))
    near = F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= max_bits
    pairs = left.join(right, ["no", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()
    hot = shared.where(F.col("size") > hot_key).select("node", "fp").distinct()
    around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i)
                                                           .cast("long")) for i in range(64)])
    meet = (hot.select(F.struct("node", "fp").alias("m"), F.explode(around).alias("at"))
            .groupBy("at").agg(F.collect_set("m").alias("ms")).where(F.size("ms") > 1))  # 65 members at most
    if max_bits == 2:
        stars = meet.select(F.array_min("ms.node").alias("a"), F.explode("ms.node").alias("b"))
    else:
        both = meet.select("ms", F.explode("ms").alias("x")).select("x", F.explode("ms").alias("y"))
        stars = both.where(F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits).select(
            F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    return pairs.unionByName(stars.where("a < b"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, seed: int) -> DataFrame:
    """Rows doc_id, mark (hash of the text), fp, group (smallest fingerprint
    that links reach), component_id."""
    text, ident = text_or_empty(text_col), F.col(f"`{id_col}`").cast("long")
    return grouped(store(docs.select(ident.alias("doc_id"), F.xxhash64(text).alias("mark"),
                                     fingerprints(text, shingle, seed).alias("fp")), "simhash-fps"), max_bits)


def grouped(fps: DataFrame, max_bits: int) -> DataFrame:
    """Rows (doc_id, fp, ...) with group and component_id; fingerprints are the
    nodes, so rows without ids link like any other."""
    reps = store(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-reps")
    comp = connected_components(links(reps.select(F.col("fp").alias("node"), "fp"), max_bits))
    named = reps.join(comp.select(F.col("node").alias("n2"), "component"), F.col("fp") == F.col("n2"), "left")
    named = store(named.select("fp", "low", F.coalesce("component", "fp").alias("group")), "simhash-groups")
    lowest = named.groupBy("group").agg(F.min("low").alias("component_id"))
    return fps.join(named.select("fp", "group").join(lowest, "group"), "fp")


def kept_rows(rows: DataFrame) -> DataFrame:
    """(doc_id, mark, n) of each group's row of smallest id, of equal ids the one
    of the smallest mark; a row without id only where no row has one.  ``n`` rows
    are equal in both."""
    equal = rows.groupBy("group", "doc_id", "mark").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark", "n"))
    return equal.groupBy("group").agg(first.alias("k")).select("k.doc_id", "k.mark", "k.n")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id), one row per input row.

    ``component_id`` is the smallest id that links reach, also through rows
    without ids; it is NULL where they reach no id.  NULL and empty texts have
    fingerprint 0 and link like any other.  An id with different texts is in the
    component of each of its texts, and groups that are not linked may then have
    the same smallest id.  Repeated rows stay; extra columns are ignored; an
    empty table gives an empty one.
    """
    return _grouped(docs, id_col, text_col, shingle, max_bits, seed).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         max_bits: int = 2, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` that keep one document of each group: the one with
    the group's smallest id; of rows with that id the one whose text has the
    smallest XXH64 hash, and of repeated rows one.  Different texts under one id
    are documents of their own.  A group of rows without ids keeps the one of
    the smallest hash.
    """
    kept = store(kept_rows(_grouped(docs, id_col, text_col, shingle, max_bits, seed)), "simhash-kept")
    i, m, own = fresh(docs, "kept_id"), fresh(docs, "kept_mark"), fresh(docs, "text_mark")
    ident = F.col(f"`{id_col}`").cast("long")
    marked = docs.withColumn(own, F.xxhash64(text_or_empty(text_col)))

    def found(keys: DataFrame) -> DataFrame:
        return marked.join(keys.select(F.col("doc_id").alias(i), F.col("mark").alias(m)),
                           ident.eqNullSafe(F.col(i)) & (F.col(own) == F.col(m)), "left_semi")
    # texts move once; only rows that have an equal are put together
    repeated = kept.where("n > 1")
    out = found(kept.where("n = 1"))
    if not repeated.isEmpty():
        out = out.unionByName(found(repeated).dropDuplicates([id_col, own]))
    return out.drop(own)
