"""Spelling variant grouping (operator 13): blocked Gram matrices.

Words that one inserted, deleted or replaced letter turns into each other have
letter counts at a squared distance of at most two, in the same or the next
length.  The words are cut into cells by the counts of ``GROUPS`` groups of
letters, whose sum is the length; one edit changes at most one count by one (the
next length) or moves one letter between two groups, so a cell meets only these
neighbours.  A large cell is split by a hash of the word; a pair of parts is a
tile, the unit of work of a task.

In a tile the rows of letter counts are split into boxes of at most ``BOX`` like
rows.  Boxes further apart than the limit are skipped; for the others a product
of the count matrices gives all squared distances at once.  Pairs within the
limit are verified letter by letter.  A tile returns one row per word that has a
near word (how many, and the best of them), never the pairs.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, store, text_or_empty

MIN_CHARS, MIN_COUNT = 5, 3
#: A run's letter is deleted where the hash of document and run divides by this.
DELETE_MOD = 97
GROUPS = 3
#: Words and letters of one side of a tile, at most (one word may be longer).
TILE_WORDS, TILE_LETTERS = 32_768, 4 << 20
BOX = 32
#: Bytes of counted words that a task holds before it hands them on.
HELD_BYTES = 32 << 20

#: One byte per code point up to U+00FF: A-Z in lower case, letters kept, all else a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))
_LETTERS = bytes(b for b in range(256) if _FOLD[b] == b and b != 0x20)
_PLACE = np.zeros(256, np.int64)
_PLACE[np.frombuffer(_LETTERS, np.uint8)] = np.arange(len(_LETTERS))

WORD_COUNT = pa.schema([("word", pa.string()), ("n", pa.int64())])


def document_words(doc_id: str, text: str, delete_mod: int = DELETE_MOD, min_chars: int = MIN_CHARS) -> Counter:
    """Words (Latin-1 bytes) of one text with their counts, after deletions."""
    found: Counter = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(text.encode("latin-1", "replace").translate(_FOLD).split()).items():
        if len(run) < min_chars:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % delete_mod == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < min_chars:
                continue
        found[run] += n
    return found


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all texts: maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z
    in lower case, after the deletions that the hash of document and run asks
    for; words of at least ``MIN_CHARS`` letters.  NULL texts have no words, a
    NULL id stands for an empty text; a repeated row counts each time."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        size = 0

        def rows() -> Iterator[tuple[str, int]]:
            return ((w.decode("latin-1"), n) for w, n in held.items())

        for b in parts:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for w, n in document_words(i, t).items():
                    if w not in held:
                        size += len(w) + 120
                    held[w] += n
                if size > HELD_BYTES:
                    yield from batches(WORD_COUNT, rows(), weigh=lambda r: len(r[0]), limit=4 << 20)
                    held, size = Counter(), 0
        yield from batches(WORD_COUNT, rows(), weigh=lambda r: len(r[0]), limit=4 << 20)

    pairs = docs.select(text_or_empty(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return pairs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# tiles


def _cell(word: Column) -> Column:
    """Letters of each group, by code point modulo the number of groups."""
    kinds = [bytes(b for b in _LETTERS if b % GROUPS == g).decode("latin-1") for g in range(GROUPS)]
    return F.array(*[F.length(word) - F.length(F.translate(word, k, "")) for k in kinds])


def _neighbours(cell: Column) -> Column:
    """The cell itself, the longer cells and the cells one replacement away."""
    def moved(*steps: tuple[int, int]) -> Column:
        by = dict(steps)
        return F.array(*[cell[g] + by.get(g, 0) for g in range(GROUPS)])
    return F.array(cell, *[moved((g, 1)) for g in range(GROUPS)],
                   *[moved((a, -1), (b, 1)) for a in range(GROUPS) for b in range(GROUPS) if a != b])


def _routed(vocabulary: DataFrame) -> DataFrame:
    """(tile, side, word, n): every word once for each tile it belongs to."""
    words = vocabulary.withColumn("cell", _cell(F.col("word")))
    room = F.greatest(F.lit(1), F.least(F.lit(TILE_WORDS), F.lit(TILE_LETTERS) / F.length("word"))).cast("long")
    cells = store(words.groupBy("cell").agg(F.ceil(F.count("*") / F.max(room)).cast("int").alias("parts")), "spelling-cells")
    size = F.aggregate("cell", F.lit(0), lambda a, x: a + x)
    other = F.aggregate("other", F.lit(0), lambda a, x: a + x)
    pairs = (cells.select("cell", "parts", F.explode(_neighbours(F.col("cell"))).alias("other"))
             .where((other > size) | (F.col("other") >= F.col("cell")))
             .join(cells.select(F.col("cell").alias("other"), F.col("parts").alias("other_parts")), "other"))
    # one row per cell and side: which cells stand on the other side
    one = pairs.select("cell", F.lit(0).alias("side"), "other", "parts", F.col("other_parts").alias("across"))
    two = pairs.select(F.col("other").alias("cell"), F.lit(1).alias("side"), F.col("cell").alias("other"),
                       F.col("other_parts").alias("parts"), F.col("parts").alias("across"))
    met = words.join(one.unionByName(two), "cell")
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    same = F.col("cell") == F.col("other")
    met = (met.withColumn("part", part).withColumn("facing", F.explode(F.sequence(F.lit(0), F.col("across") - 1)))
           .where(~same | F.when(F.col("side") == 0, F.col("facing") >= F.col("part")).otherwise(F.col("facing") < F.col("part"))))
    here, there = (F.concat_ws(".", F.concat_ws(",", c), p) for c, p in (("cell", F.col("part")), ("other", F.col("facing"))))
    return met.select(F.when(F.col("side") == 0, F.concat_ws("|", here, there)).otherwise(F.concat_ws("|", there, here))
                      .alias("tile"), "side", "word", "n")


class Words:
    """Words of one length with their weights, letters and counts of the letters
    in ``columns``, in boxes of at most ``BOX`` words of like counts."""

    def __init__(self, words: list[bytes], n: np.ndarray, columns: np.ndarray):
        self.length = len(words[0])
        letters, counts = _counted(words)
        counts = counts[:, columns].astype(np.int16 if self.length < 1 << 14 else np.int64)
        order, self.starts = _boxes(counts)
        self.words = [words[k] for k in order.tolist()]
        self.letters, self.n = letters[order], n[order]
        self.low = np.minimum.reduceat(counts[order], self.starts)
        self.high = np.maximum.reduceat(counts[order], self.starts)
        # products of whole and half numbers below 2 ** 23 are exact in single precision
        self.counts = counts[order].astype(np.float32 if self.length < 2000 else np.float64)
        self.square = (self.counts ** 2).sum(axis=1)
        self.rank = np.empty(len(words), np.int64)
        self.rank[sorted(range(len(words)), key=self.words.__getitem__)] = np.arange(len(words))

    def widened(self, left: bool) -> np.ndarray:
        """Counts with two more columns, so that the product of two sides is
        minus half the squared distance of their rows."""
        half, one = -self.square[:, None] / 2, np.ones((len(self.words), 1), self.counts.dtype)
        return np.hstack([self.counts, *((half, one) if left else (one, half))])


def _counted(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Letters and letter counts of words of one length."""
    letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
    at = np.arange(len(words))[:, None] * len(_LETTERS) + _PLACE[letters]
    counts = np.bincount(at.ravel(), minlength=len(words) * len(_LETTERS))
    return letters, counts.reshape(len(words), len(_LETTERS))


def letters_used(*sides: list[bytes]) -> np.ndarray:
    """Places of the letters that occur in any of the words."""
    return _PLACE[np.frombuffer(bytes(sorted(set().union(*(w for s in sides for w in s)))), np.uint8)]


def _boxes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows and where its boxes start: rows are halved by the
    count that varies most among them, where its value changes next to the
    middle, until at most ``BOX`` are left."""
    order, starts, at = [], [], 0
    stack = [np.arange(len(counts))]
    while stack:
        rows = stack.pop()
        if len(rows) <= BOX:
            order.append(rows)
            starts.append(at)
            at += len(rows)
            continue
        mine = counts[rows]
        value = mine[:, mine.var(axis=0).argmax()]
        by = np.argsort(value, kind="stable")
        value, half = value[by], len(rows) // 2
        below, above = np.searchsorted(value, value[half], "left"), np.searchsorted(value, value[half], "right")
        cut = below if half - below <= above - half else above
        cut = int(cut) if 0 < cut < len(rows) else half
        stack += [rows[by[cut:]], rows[by[:cut]]]
    return np.concatenate(order), np.array(starts)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of letters of equal or next length: does one edit part them?"""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    length = a.shape[1]
    differs = a != b[:, :length]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), length)
    wrong = (a != b[:, 1:]) & (np.arange(length) >= first[:, None])
    return ~wrong.any(axis=1)


def near_pairs(a: Words, b: Words, made: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``a`` and ``b`` that one edit parts, a box of ``a`` at a time;
    ``b`` has the length of ``a`` or the next one.  With ``a`` on both sides
    every pair comes once, the lesser row first.  ``made`` counts the distances
    computed and all distances."""
    limit = 2 if a.length == b.length else 1
    left, right = a.widened(True), b.widened(False)
    sizes = np.diff(np.r_[b.starts, len(b.words)])
    step = max(1, TILE_LETTERS // b.length)
    for k, (lo, hi) in enumerate(zip(a.starts.tolist(), [*a.starts[1:].tolist(), len(a.words)], strict=True)):
        # counts are whole numbers: a squared distance of at most 2 is the sum of the differences
        gap = np.maximum(0, np.maximum(a.low[k] - b.high, b.low - a.high[k])).sum(axis=1)
        close = gap <= limit
        if a is b:
            close[:k] = False
        rows = np.flatnonzero(np.repeat(close, sizes))
        if made is not None:
            made[0] += (hi - lo) * len(rows)
            made[1] += (hi - lo) * len(b.words)
        at = np.flatnonzero(left[lo:hi] @ right[rows].T >= -limit / 2)
        for s in range(0, len(at), step):
            i, j = np.divmod(at[s:s + step], len(rows))
            i, j = i + lo, rows[j]
            if a is b:
                i, j = i[i < j], j[i < j]
            good = _one_edit(a.letters[i], b.letters[j])
            yield i[good], j[good]


def _best(own: Words, other: Words, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, largest n, its word) for each row of ``own`` in ``i``."""
    if not len(i):
        return
    order = np.lexsort((other.rank[j], -other.n[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    for k, many in zip(first.tolist(), np.diff(np.r_[first, len(i)]).tolist(), strict=True):
        yield own.words[i[k]].decode("latin-1"), many, int(other.n[j[k]]), other.words[j[k]].decode("latin-1")


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _tile(group: pa.Table) -> pa.Table:
    side = group.column("side").to_numpy()
    n = group.column("n").to_numpy()
    words = [w.encode("latin-1") for w in group.column("word").to_pylist()]
    ends = group.column("tile")[0].as_py().split("|")
    split = [[words[k] for k in np.flatnonzero(side == s).tolist()] for s in (0, 1)]
    rows: list[tuple] = []
    mirrored = ends[0] == ends[1]
    if mirrored or all(split):
        columns = letters_used(*split)
        a, b = (Words(x, n[side == s], columns) if x else None for s, x in enumerate(split))
        b = a if mirrored else b
        found = [*near_pairs(a, b)]
        if found:
            i, j = np.concatenate([p[0] for p in found]), np.concatenate([p[1] for p in found])
            if mirrored:
                rows += _best(a, a, np.r_[i, j], np.r_[j, i])
            else:
                rows += [*_best(a, b, i, j), *_best(b, a, j, i)]
    return pa.Table.from_batches(list(batches(NEAR, iter(rows), 1 << 16)), NEAR)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) for the words of (word, n) that have a near
    word: one inserted, deleted or replaced letter apart.  ``best`` is the near
    word of largest n, the smallest in code-point order among equals."""
    tiles = _routed(vocabulary).groupBy("tile").applyInArrow(_tile, "word string, n_near long, best_n long, best string")
    found = tiles.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                      F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
    return found.select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def follow_forms(forms: DataFrame) -> DataFrame:
    """(word, root) for each row of (word, form): the end of its chain of forms,
    by pointer doubling (joins in the logarithm of the longest chain).  Chains
    have no rings, as a form has at least twice its word's n."""
    cur = store(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        cur = store(cur.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                          F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if cur.where("moved").isEmpty():
            return cur.select("word", "root")
        cur = cur.drop("moved")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_count: int = MIN_COUNT) -> DataFrame:
    """One row per word with at least ``min_count`` occurrences: word, form, root,
    n, n_near, form_n.

    ``form`` is the near word of largest n (ties: smallest in code-point order)
    if that n is at least twice the word's, else NULL; ``root`` the last word of
    the chain of forms, the word itself without one.  NULL and empty texts have
    no words; texts and words of any length are taken whole; repeated rows count
    each time; extra columns are not read; an empty table gives an empty result.
    """
    words = store(word_counts(docs, id_col, text_col).where(F.col("n") >= min_count), "spelling-words")
    near = store(near_words(words), "spelling-near")
    out = words.join(near, "word", "left").withColumn(
        "form", F.when(F.col("best_n") >= 2 * F.col("n"), F.col("best")))
    out = store(out.select("word", "form", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                           F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = follow_forms(out.where("form is not null").select("word", "form"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
