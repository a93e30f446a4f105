"""Cross-tokenizer alignment (operator 11): galloping intersection of token ends.

A text is encoded twice, as a space and the text by a byte-level BPE (A) and as
the text by a sentence-piece model (B), which adds the space itself.  Both give
ascending lists of byte offsets at which tokens end.  The shorter list drives:
each of its ends is looked up in the longer one by steps of doubling width from
a guessed place and a binary search in the bracket found, all ends in lock-step.
Ends found in both lists cut the tokens into groups.  The difference of the
places of two consecutive ends is the range of tokens on the other side that
overlap the token between them: its links.

How many documents hold an id pair linked is counted over the corpus; a document
then gets the sum of these counts over its links and the number of links whose
pair is the most frequent one of its A id.

Texts are encoded word by word, cut at single spaces between two other
characters: neither tokenizer has a token that runs from such a character into
a space, so the ids are those of the whole text.  A worker keeps the ids of the
words it met in a bounded memo; the texts are aligned whole, long ones in parts
that end with a word.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, file_bytes, store, text_or_empty

#: Characters after which a text is cut, and that are encoded at a time.
PART_CHARS, CHUNK_CHARS = 1 << 16, 1 << 17
DOCS_AT_ONCE = 2000
#: About so many bytes of words and ids are kept by a worker.
MEMO_BYTES = 96 << 20
WORDS_AT_ONCE = 2000
#: Id pairs whose counts are broadcast (17 bytes each); the others meet their
#: counts in a join.
FREQUENT_PAIRS = 1 << 20
#: Distinct pairs that a counting task holds before it hands them on.
HELD_PAIRS = 1 << 21
SPACE_MARK = "▁"

_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")


def gallop(short: np.ndarray, long: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each value of ``short`` the first place in the ascending ``long`` that
    is not below it, searched from ``guess``; the last of ``long`` is the
    largest value of all."""
    low = guess.copy()
    high = guess.copy()
    below = long[guess] < short
    low[~below] = -1
    # invariant at the end: long[low] < value <= long[high]; low may be -1
    open_, step = np.flatnonzero(below), 1
    while len(open_):
        at = np.minimum(guess[open_] + step, len(long) - 1)
        found = long[at] >= short[open_]
        high[open_[found]] = at[found]
        open_, at = open_[~found], at[~found]
        low[open_] = at
        step *= 2
    open_, step = np.flatnonzero(~below & (guess > 0)), 1
    while len(open_):
        at = np.maximum(guess[open_] - step, 0)
        found = long[at] < short[open_]
        low[open_[found]] = at[found]
        open_, at = open_[~found], at[~found]
        high[open_] = at
        open_ = open_[at > 0]
        step *= 2
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        right = long[middle] < short[open_]
        low[open_[right]] = middle[right]
        high[open_[~right]] = middle[~right]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


def aligned(ends_a: np.ndarray, ends_b: np.ndarray, parts_a: np.ndarray, parts_b: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cuts of A, cuts of B, links' A places, links' B places).

    The cuts mark the tokens at whose end both sides end.  ``parts_a`` and
    ``parts_b`` count the tokens of the parts, whose ends are common: within a
    part the guessed places are proportional."""
    swap = len(ends_b) < len(ends_a)
    short, long, n_short, n_long = (ends_b, ends_a, parts_b, parts_a) if swap else (ends_a, ends_b, parts_a, parts_b)
    part = np.repeat(np.arange(len(n_short)), n_short)
    first_short, first_long = np.cumsum(n_short) - n_short, np.cumsum(n_long) - n_long
    inside = np.arange(len(short)) - first_short[part]
    guess = first_long[part] + np.minimum(inside * n_long[part] // n_short[part], n_long[part] - 1)
    place = gallop(short, long, guess)
    common = long[place] == short
    # a token overlaps from the token after the last end passed to the one that holds its own end
    start = np.concatenate([[0], (place + common)[:-1]]) if len(place) else place
    many = place - start + 1
    driver = np.repeat(np.arange(len(short)), many)
    other = np.arange(len(driver)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start, many)
    met = np.zeros(len(long), bool)
    met[place[common]] = True
    return (met, common, other, driver) if swap else (common, met, driver, other)


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: the
    printable Latin-1 ones for themselves, the others from U+0100 on in order."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(0x100 + k): b for k, b in enumerate(moved)}


def text_parts(text: str, size: int) -> Iterator[str]:
    """Parts of about ``size`` characters, cut at single inner spaces, which are
    left out; nothing for an empty text."""
    at = 0
    while len(text) - at > size and (cut := _INNER_SPACE.search(text, at + size)):
        yield text[at:cut.start()]
        at = cut.end()
    if text:
        yield text[at:]


class Document:
    """What is known of one document while its parts are aligned."""

    __slots__ = ("good", "n_a", "n_b", "n_groups", "n_links", "text", "pairs", "times")

    def __init__(self):
        self.good, self.n_a, self.n_b, self.n_groups, self.n_links = True, 0, 0, 0, 0
        self.text = hashlib.sha256()
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, n_a: int, n_b: int, groups: int, text: bytes, pairs: np.ndarray, times: np.ndarray) -> None:
        self.text.update((b";" if self.n_a else b"") + text[:-1])
        self.n_a, self.n_b, self.n_groups = self.n_a + n_a, self.n_b + n_b, self.n_groups + groups
        self.n_links += int(times.sum())
        self.pairs.append(pairs)
        self.times.append(times)

    def row(self) -> tuple:
        """(n_a, n_b, n_groups, n_links, digest, pairs, times)."""
        if not self.good or not self.n_a:
            return 0, 0, 0, 0, "", b"", b""
        pairs, times = summed(self.pairs, self.times)
        return (self.n_a, self.n_b, self.n_groups, self.n_links, self.text.hexdigest(),
                pairs.astype("<i8").tobytes(), times.astype("<i4").tobytes())


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    if len(keys) == 1:
        return keys[0], counts[0]
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(n, first)


class Pair:
    """The two tokenizers and the tables that a task needs of them."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_buffer(a_file)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        byte = byte_characters()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # a piece that ran into a space would make the cuts of long texts wrong
        self.cuts = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        texts = [b"%d%s" % (i, end) for n, ends in ((len(self.bytes_a), b",|"), (len(self.bytes_b), b",;"))
                 for end in (ends[:1], ends[1:]) for i in range(n)]
        self.texts = np.array(texts, object)
        self.memo: dict[str, tuple[bytes, bytes] | None] = {}
        self.held = 0

    def parts(self, text: str) -> Iterator[str]:
        return text_parts(text, PART_CHARS if self.cuts else len(text))

    def words(self, text: str) -> list[str]:
        return _INNER_SPACE.split(text) if self.cuts else [text]

    def _learn(self, words: set[str]) -> None:
        """Ids of new words (little-endian int32, A and B), None for those that are
        not given back byte for byte."""
        plain = [w for w in words if w and not (w[0].isspace() or w[-1].isspace() or SPACE_MARK in w)] if self.cuts else []
        odd = list(words.difference(plain))
        for lo in range(0, len(plain), WORDS_AT_ONCE):
            part = plain[lo:lo + WORDS_AT_ONCE]
            whole = " " + " ".join(part)
            raw = [w.encode() for w in part]
            ends = np.cumsum([len(w) + 1 for w in raw])
            a, b = self._ids([whole[1:]])[0]
            cut_a, cut_b = self._ends(a, self.bytes_a, self.size_a, raw, ends), self._ends(b, self.bytes_b, self.size_b, raw, ends)
            if cut_a is None or cut_b is None:
                odd += part
                continue
            a, b = (np.array(x, "<i4").tobytes() for x in (a, b))
            for w, a0, a1, b0, b1 in zip(part, [0, *cut_a], cut_a, [0, *cut_b], cut_b):
                self.memo[w] = a[a0:a1], b[b0:b1]
        for w, (a, b) in zip(odd, self._ids(odd), strict=True):
            whole = b" " + w.encode()
            good = b"".join([self.bytes_a[i] for i in a]) == whole == b"".join([self.bytes_b[i] for i in b])
            self.memo[w] = (np.array(a, "<i4").tobytes(), np.array(b, "<i4").tobytes()) if good else None
        self.held += sum(200 + 6 * len(w) for w in words)

    def _ids(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return list(zip(a, self.b.encode(texts, num_threads=1), strict=True)) if texts else []

    @staticmethod
    def _ends(ids: list[int], tokens: list[bytes], sizes: np.ndarray, words: list[bytes], ends: np.ndarray) -> list[int] | None:
        """Byte offsets among the ids at which the words end; None if the tokens
        are not the words' bytes."""
        if b"".join([tokens[i] for i in ids]) != b" " + b" ".join(words):
            return None
        at = np.cumsum(sizes[np.array(ids)])
        k = np.searchsorted(at, ends)
        return (4 * (k + 1)).tolist() if (at[k] == ends).all() else None

    def align(self, work: list[tuple[Document, str]]) -> None:
        """Add each part to its document."""
        if not work:
            return
        if self.held > MEMO_BYTES:  # the older half goes
            for w in list(itertools.islice(self.memo, len(self.memo) // 2)):
                del self.memo[w]
            self.held //= 2
        cut = [self.words(text) for _, text in work]
        new = set().union(*cut).difference(self.memo)
        if new:
            self._learn(new)
        live, ids_a, ids_b = [], [], []
        for k, ((doc, _), ws) in enumerate(zip(work, cut, strict=True)):
            found = [self.memo[w] for w in ws]
            doc.good = doc.good and None not in found
            if doc.good:
                live.append(k)
                ids_a.append(np.frombuffer(b"".join([f[0] for f in found]), "<i4"))
                ids_b.append(np.frombuffer(b"".join([f[1] for f in found]), "<i4"))
        if not live:
            return
        n_a, n_b = (np.array(list(map(len, ids))) for ids in (ids_a, ids_b))
        a, b = (np.concatenate(ids).astype(np.int64) for ids in (ids_a, ids_b))
        cut_a, cut_b, link_a, link_b = aligned(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), n_a, n_b)
        text, at = self._groups(a, b, cut_a, cut_b), np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        part = np.repeat(np.arange(len(live)), n_a)
        groups = np.bincount(part[cut_a], minlength=len(live)).tolist()
        room = len(self.bytes_a) * len(self.bytes_b)
        keys, times = np.unique(part[link_a] * room + a[link_a] * len(self.bytes_b) + b[link_b], return_counts=True)
        edge = np.searchsorted(keys, np.arange(len(live) + 1) * room).tolist()
        for x, k in enumerate(live):
            span = slice(edge[x], edge[x + 1])
            work[k][0].add(int(n_a[x]), int(n_b[x]), groups[x], b"".join(text[at[x]:at[x + 1]]), keys[span] - x * room,
                           times[span])

    def _groups(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> list[bytes]:
        """The tokens' texts in the order of the groups, A before B."""
        last_a, last_b = np.flatnonzero(cut_a) + 1, np.flatnonzero(cut_b) + 1
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + np.concatenate([[0], last_b])[group_a]] = a + len(self.bytes_a) * cut_a
        code[np.arange(len(b)) + last_a[group_b]] = 2 * len(self.bytes_a) + b + len(self.bytes_b) * cut_b
        return self.texts[code].tolist()


_PAIRS: dict[int, Pair] = {}


def _pair(key: int, a_file, b_file) -> Pair:
    """One pair of tokenizers per worker process, built at first use."""
    if key not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[key] = Pair(a_file.value, b_file.value)
    return _PAIRS[key]


DOCUMENT = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                      ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                      ("pairs", pa.binary()), ("times", pa.binary())])
COUNTED = pa.schema([("key", pa.int64()), ("n", pa.int64())])


def aligned_rows(pair: Pair, rows: Iterator[tuple[int | None, str]]) -> Iterator[tuple]:
    """(id, n_a, n_b, n_groups, n_links, digest, pairs, times) per (id, text), in order."""
    ready: list[tuple[int | None, Document]] = []
    work: list[tuple[Document, str]] = []
    chars = 0
    for i, text in rows:
        ready.append((i, Document()))
        for part in pair.parts(text):
            work.append((ready[-1][1], part))
            chars += len(part)
            if chars >= CHUNK_CHARS:
                pair.align(work)
                work, chars = [], 0
        if not work or len(ready) >= DOCS_AT_ONCE:
            pair.align(work)
            yield from ((k, *d.row()) for k, d in ready)
            ready, work, chars = [], [], 0
    pair.align(work)
    yield from ((k, *d.row()) for k, d in ready)


def align_documents(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One stored row per document: an address ``row``, doc_id, n_a, n_b,
    n_groups, n_links, groups_sha256, and its linked id pairs as binary columns
    ``pairs`` (little-endian int64, A id times the size of B's vocabulary plus B
    id) and ``times`` (int32)."""
    sc = docs.sparkSession.sparkContext
    a, b = sc.broadcast(file_bytes(a_file)), sc.broadcast(file_bytes(b_file))
    key = hash((a_file, b_file))

    def align(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, base = _pair(key, a, b), TaskContext.get().partitionId() << 40

        def rows() -> Iterator[tuple[int | None, str]]:
            for batch in parts:
                for k in range(batch.num_rows):
                    yield batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
        found = ((base + k, *r) for k, r in enumerate(aligned_rows(pair, rows())))
        yield from batches(DOCUMENT, found, 2048, lambda r: len(r[-1]) * 3, 16 << 20)

    pairs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return store(pairs.mapInArrow(align, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                         "groups_sha256 string, pairs binary, times binary"), "aligned")


def pair_counts(documents: DataFrame, size_b: int) -> DataFrame:
    """(key, n, top): how many documents hold each id pair linked, and whether
    that is the most of all pairs of its A id (ties included)."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        size = 0
        for batch in parts:
            for x in batch.column(0):
                held.append(np.frombuffer(x.as_buffer(), "<i8"))
                counts.append(np.ones(len(held[-1]), np.int64))
                size += len(held[-1])
                if size > HELD_PAIRS:
                    held, counts = ([x] for x in summed(held, counts))
                    size = len(held[0])
                    if size > HELD_PAIRS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(counts[0])], schema=COUNTED)
                        held, counts, size = [], [], 0
        if held:
            keys, n = summed(held, counts)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], schema=COUNTED)

    found = documents.select("pairs").where(F.length("pairs") > 0).mapInArrow(count, "key long, n long")
    found = store(found.groupBy("key").agg(F.sum("n").alias("n")).withColumn("a", F.floor(F.col("key") / size_b)),
                  "pair-counts")
    most = found.groupBy("a").agg(F.max("n").alias("most"))
    return store(found.join(most, "a").select("key", "n", (F.col("n") == F.col("most")).alias("top")), "pair-counts")


def frequent_from(counts: DataFrame, limit: int) -> int:
    """The smallest power of two such that at most ``limit`` pairs have that
    count or more."""
    levels = {r[0]: r[1] for r in counts.groupBy(F.floor(F.log2("n")).alias("level")).count().collect()}
    at = max(levels, default=0) + 1
    while at > 0 and sum(c for k, c in levels.items() if k >= at - 1) <= limit:
        at -= 1
    return 1 << at


def align_tokens(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text",
                 frequent: int = FREQUENT_PAIRS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts the links whose pair is held by the most documents of all
    pairs of its A id (ties included), ``count_sum`` sums over the links how many
    documents hold their pair.  A text that is NULL or empty, or that either
    tokenizer does not give back byte for byte after a space (a text that holds
    U+2581), has no tokens: zeros, and an empty digest.  Texts of any length are
    aligned whole; a repeated row is a document of its own and counts each time;
    a NULL id is kept; extra columns are not read; an empty table gives an empty
    result.

    Counts of pairs held by many documents (at most ``frequent`` pairs) are
    broadcast; the links of all others meet their counts in a join, whose keys
    are rare by that choice.
    """
    spark = docs.sparkSession
    documents = align_documents(docs, a_file, b_file, id_col, text_col)
    counts = pair_counts(documents, Pair(file_bytes(a_file), file_bytes(b_file)).b.get_piece_size())
    bound = frequent_from(counts, frequent)
    known = counts.where(F.col("n") >= bound).orderBy("key").toPandas()
    table = spark.sparkContext.broadcast(tuple(known[c].to_numpy() for c in ("key", "n", "top")))

    def looked_up(pairs: pa.Scalar, times: pa.Scalar) -> tuple[np.ndarray, ...]:
        key, n, top = table.value
        pair, many = np.frombuffer(pairs.as_buffer(), "<i8"), np.frombuffer(times.as_buffer(), "<i4").astype(np.int64)
        at = np.minimum(np.searchsorted(key, pair), max(0, len(key) - 1))
        hit = key[at] == pair if len(key) else np.zeros(len(pair), bool)
        at, own = at[hit], many[hit]
        return int(own[top[at]].sum()) if len(at) else 0, int((own * n[at]).sum()) if len(at) else 0, pair[~hit], many[~hit]

    def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            found = [looked_up(p, t)[:2] if len(p.as_buffer()) else (0, 0) for p, t in zip(b.column("pairs"), b.column("times"))]
            best, total = (pa.array([x[k] for x in found], pa.int64()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(7)), best, total], schema=pa.schema(
                [*list(DOCUMENT)[:7], ("n_best", pa.int64()), ("count_sum", pa.int64())]))

    out = documents.mapInArrow(sums, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                     "groups_sha256 string, n_best long, count_sum long")
    last = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if bound == 1:
        return out.select(last)

    def rest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for r, p, t in zip(b.column("row").to_pylist(), b.column("pairs"), b.column("times"), strict=True):
                if len(p.as_buffer()):
                    _, _, key, many = looked_up(p, t)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), r)), pa.array(key), pa.array(many)],
                                                     names=["row", "key", "times"])

    rare = documents.select("row", "pairs", "times").mapInArrow(rest, "row long, key long, times long")
    more = (rare.join(counts.where(F.col("n") < bound), "key").groupBy("row")
            .agg(F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("more_best"),
                 F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    both = out.join(more, "row", "left")
    return both.withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
                             "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}).select(last)
