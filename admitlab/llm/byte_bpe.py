"""Byte-level BPE encoding and decoding (operator 1).

The pieces of a text (matches of the splitting pattern) are merged in numpy:
pieces of like length form a padded matrix of token ids, and every round merges
the leftmost pair of least rank of every row.  Pair ranks come from an open
addressing hash table; rows without a pair leave the matrix (compaction), and
each merge closes the gap in its row.  A piece too long for a matrix keeps its
pair ranks in blocks with one minimum per block, so a round costs one block.

Repeated words are merged once per task: a bounded memo maps the text between
two single spaces to its ids.  That cut is exact, as no match of the pattern
runs from a non-space character into a space.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import file_bytes, fresh, text_or_empty

NO_RANK = np.iinfo(np.int32).max
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a piece beyond which it is merged alone, by blocks.
TALL = 512
MEMO_ENTRIES = 100_000
ROWS_AT_ONCE = 20_000
#: Characters of text cut into words at a time (a longer text is cut alone).
CHARS_AT_ONCE = 1 << 20


class PairTable:
    """(left id, right id) -> rank, by open addressing with linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(8, int(np.ceil(np.log2(max(1, len(left)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_RANK, np.int32)
        todo = self._key(left, right)
        at, rank = self._slot(todo), rank.astype(np.int32)
        while len(todo):
            free = np.flatnonzero(self.keys[at] == -1)
            slots, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[slots], self.ranks[slots] = todo[put], rank[put]
            rest = np.ones(len(todo), bool)
            rest[put] = False
            todo, rank, at = todo[rest], rank[rest], (at[rest] + 1) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * MIX) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NO_RANK where there is none or an id is -1."""
        shape = left.shape
        key = self._key(left, right).ravel()
        key[(left.ravel() < 0) | (right.ravel() < 0)] = -2
        at = self._slot(key)
        out = np.full(len(key), NO_RANK, np.int32)
        open_ = np.flatnonzero(key >= 0)
        while len(open_):
            slot = at[open_]
            held = self.keys[slot]
            hit = held == key[open_]
            out[open_[hit]] = self.ranks[slot[hit]]
            open_ = open_[~hit & (held != -1)]
            at[open_] = (at[open_] + 1) & self.mask
        return out.reshape(shape)


class ByteBPE:
    """A rank file (base64 token, space, rank per line) with its pattern."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ids = {base64.b64decode(t): int(r) for t, r in map(bytes.split, rank_file.splitlines()) if t}
        self.tokens: list[bytes] = [b""] * (max(self.ids.values()) + 1)
        for t, r in self.ids.items():
            self.tokens[r] = t
        self.byte_id = np.array([self.ids[bytes([i])] for i in range(256)], np.int32)
        self.pattern = regex.compile(pattern)
        self.after_space: dict[str, bytes] = {}
        self.at_start: dict[str, bytes] = {}

    @cached_property
    def table(self) -> PairTable:
        """Every pair of tokens that joins to a token (decoding needs none)."""
        pairs = [(self.ids[t[:i]], self.ids[t[i:]], r) for t, r in self.ids.items()
                 for i in range(1, len(t)) if t[:i] in self.ids and t[i:] in self.ids]
        return PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)

    # merging

    def _merge_matrix(self, rows: np.ndarray) -> list[bytes]:
        """Ids of each row of a matrix of ids padded with -1."""
        out: list[bytes] = [b""] * len(rows)
        name = np.arange(len(rows))
        ranks = self.table.find(rows[:, :-1], rows[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NO_RANK)
            done = best == NO_RANK
            if done.any():
                ended = rows[done]
                for k, row, n in zip(name[done].tolist(), ended.astype("<u4"), (ended >= 0).sum(axis=1).tolist(),
                                     strict=True):
                    out[k] = row[:n].tobytes()
                live = ~done
                rows, ranks, name, at, best = rows[live], ranks[live], name[live], at[live], best[live]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            rows[each, at] = best
            gap = at[:, None]
            col = np.arange(rows.shape[1] - 1)
            rows = np.take_along_axis(rows, col + (col > gap), axis=1)
            col = np.arange(ranks.shape[1] - 1)
            ranks = np.take_along_axis(ranks, col + (col >= gap), axis=1)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.table.find(rows[left, at[left] - 1], rows[left, at[left]])
            right = np.flatnonzero(at < ranks.shape[1])
            ranks[right, at[right]] = self.table.find(rows[right, at[right]], rows[right, at[right] + 1])
        return out

    def _merge_tall(self, piece: bytes) -> bytes:
        """One long piece: pair ranks in blocks, the least of each block kept."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].copy()
        n = len(ids)
        width = 1 << max(5, (n.bit_length() + 1) // 2)
        ranks = np.full(-(-n // width) * width, NO_RANK, np.int32)
        ranks[:n - 1] = self.table.find(ids[:-1], ids[1:])
        blocks = ranks.reshape(-1, width)
        least = blocks.min(axis=1)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        one = np.empty(1, np.int32)

        def rank(i: int, j: int) -> int:
            return int(self.table.find(ids[i:i + 1], ids[j:j + 1])[0])

        while True:
            b = int(least.argmin())
            if least[b] == NO_RANK:
                break
            i = b * width + int(blocks[b].argmin())
            j = int(after[i])
            one[0] = ranks[i]
            ids[i], ids[j], ranks[j] = one[0], -1, NO_RANK
            k, p = int(after[j]), int(before[i])
            after[i] = k
            if k < n:
                before[k] = i
            ranks[i] = rank(i, k) if k < n else NO_RANK
            if p >= 0:
                ranks[p] = rank(p, i)
            for x in {b, j // width, max(p, 0) // width}:
                least[x] = blocks[x].min()
        return ids[ids >= 0].astype("<u4").tobytes()

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of each piece."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            known = self.ids.get(p)
            if known is not None:
                out[k] = known.to_bytes(4, "little")
            elif len(p) > TALL:
                out[k] = self._merge_tall(p)
            elif p:
                n = len(p)
                buckets.setdefault(n if n <= 16 else 1 << (n - 1).bit_length(), []).append(k)
        for width, names in buckets.items():
            for lo in range(0, len(names), ROWS_AT_ONCE):
                part = names[lo:lo + ROWS_AT_ONCE]
                raw = np.frombuffer(b"".join(pieces[k].ljust(width, b"\0") for k in part), np.uint8)
                rows = self.byte_id[raw.reshape(len(part), width)]
                size = np.array([len(pieces[k]) for k in part])
                rows[np.arange(width) >= size[:, None]] = -1
                for k, ids in zip(part, self._merge_matrix(rows), strict=True):
                    out[k] = ids
        return out

    # texts

    def _fill(self, memo: dict[str, bytes], wanted: set[str], lead: str) -> None:
        names = [w for w in wanted if w not in memo]
        split = [self.pattern.findall(lead + w) for w in names]
        flat = list({p for ps in split for p in ps})
        ids = dict(zip(flat, self.merge([p.encode("utf-8", "surrogatepass") for p in flat]), strict=True))
        for w, ps in zip(names, split, strict=True):
            memo[w] = b"".join([ids[p] for p in ps])

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        group: list[str] = []
        chars = 0
        for t in texts:
            if group and chars + len(t) > CHARS_AT_ONCE:
                out += self._encode_group(group)
                group, chars = [], 0
            group.append(t)
            chars += len(t)
        return out + self._encode_group(group) if group else out

    def _encode_group(self, texts: list[str]) -> list[bytes]:
        if len(self.after_space) > MEMO_ENTRIES or len(self.at_start) > MEMO_ENTRIES:
            self.after_space, self.at_start = {}, {}
        cut = [_cut(t, self.after_space) for t in texts]
        self._fill(self.at_start, {c[0] for c in cut}, "")
        self._fill(self.after_space, {w for c in cut for w in c[1:]}, " ")
        start, rest = self.at_start, self.after_space
        out = [start[c[0]] + b"".join([rest[w] for w in c[1:]]) for c in cut]
        for c in cut:  # white space at an end: right for this text's cut only
            if len(c) > 1 and (c[-1][:1].isspace() or c[-1][-1:].isspace()):
                rest.pop(c[-1], None)
        return out

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")


def _cut(text: str, memo: dict[str, bytes]) -> list[str]:
    """``text`` cut at single spaces between two non-space characters."""
    parts = text.split(" ")
    for p in parts:
        if p not in memo and (not p or p[0].isspace() or p[-1].isspace()):
            return _INNER_SPACE.split(text)
    return parts


_MODELS: dict[int, ByteBPE] = {}


def _model(key: int, data, pattern: str) -> ByteBPE:
    """One model per worker process, built at first use."""
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = ByteBPE(data.value, pattern)
    return _MODELS[key]


def encode_bytes(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text",
                 out_col: str = "token_ids") -> DataFrame:
    """``df`` with the ids of ``text_col`` as little-endian unsigned 32-bit
    integers in the binary column ``out_col``.

    Every match of ``pattern`` is encoded separately and no special token is
    known.  NULL and empty texts give no ids (an empty value, never NULL);
    texts of any length and pieces of any length are encoded whole; repeated
    rows stay repeated; an empty table gives an empty one.  A column of the
    name ``out_col`` is replaced, all others are kept.
    """
    data = df.sparkSession.sparkContext.broadcast(file_bytes(rank_file))
    key = hash((rank_file, pattern))

    @F.arrow_udf("binary")
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _model(key, data, pattern)
        for a in parts:
            yield pa.array(model.encode(a.to_pylist()), pa.binary())

    return df.withColumn(out_col, encode(text_or_empty(text_col)))


def decode_bytes(df: DataFrame, rank_file: str, pattern: str, ids_col: str = "token_ids",
                 out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids of ``ids_col`` stand for in the
    binary column ``out_col`` (NULL ids: empty).  An id outside the vocabulary
    is an error."""
    data = df.sparkSession.sparkContext.broadcast(file_bytes(rank_file))
    key = hash((rank_file, pattern))

    @F.arrow_udf("binary")
    def decode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _model(key, data, pattern)
        for a in parts:
            yield pa.array([model.decode(x or b"") for x in a.to_pylist()], pa.binary())

    return df.withColumn(out_col, decode(F.col(f"`{ids_col}`")))


def round_trip(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text", out_col: str = "bpe") -> DataFrame:
    """``df`` with a struct column (``ids``, ``decoded``), both binary: the ids
    as ``encode_bytes`` gives them and the bytes decoded from those ids, made by
    one worker per task.  The memo of words ends with the task.

    NULL and empty texts give two empty values; texts and pieces of any length are
    taken whole (a piece of 80,000 bytes takes about 4 seconds, longer ones in
    proportion); repeated rows stay repeated; a column named ``out_col`` is
    replaced, all others are kept; an empty table gives an empty one."""
    data = df.sparkSession.sparkContext.broadcast(file_bytes(rank_file))
    key = hash((rank_file, pattern))
    kind = pa.struct([("ids", pa.binary()), ("decoded", pa.binary())])

    @F.arrow_udf("ids binary, decoded binary")
    def both(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _model(key, data, pattern)
        for a in parts:
            ids = model.encode(a.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(map(model.decode, ids), pa.binary())],
                                             fields=list(kind))
        model.after_space, model.at_start = {}, {}

    return df.withColumn(out_col, both(text_or_empty(text_col)))


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text") -> DataFrame:
    """The documents with ``token_ids`` (binary), ``n_tokens`` and ``decoded``
    (string read back from the ids); a clashing input column is replaced.  NULL
    and empty texts, long texts, repeated rows and an empty table as in
    ``round_trip``."""
    at = fresh(docs, "bpe")
    out = round_trip(docs, rank_file, pattern, text_col, at)
    return (out.withColumn("token_ids", F.col(f"{at}.ids")).withColumn("n_tokens", (F.length(f"{at}.ids") / 4).cast("long"))
            .withColumn("decoded", F.col(f"{at}.decoded").cast("string")).drop(at))
