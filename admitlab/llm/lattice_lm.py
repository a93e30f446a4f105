"""LM scoring by subword lattice likelihood (operator 2).

A word is the string " word"; the pieces of an existing subword vocabulary
(and single bytes) span its lattice.  Pieces carry unigram log probabilities
that sum to one, so the log-space forward recursion over all segmentations
gives the marginal probability of the word, and these sum to one over words:
only a piece that begins with the space can begin a word.  The vocabulary's
own order gives the first probabilities (its scores are ranks); EM over the
distinct training words re-estimates them from expected piece counts.

A text is its words and an end token.  A seen token's relative frequency is
one more path: counts are discounted by D, and the mass this frees goes to the
lattice, P(w) = max(c - D, 0) / N + (D V / N) P_lattice(w).  From the second
token on, a word of the text so far may also be copied: with probability L the
next token is one of the earlier ones, so P_i(w) = (1 - L) P(w) + L n(w) / i with
n of the i tokens so far.  The product over the text sums to one over texts.

Corpus counts cover every training document and stay distributed: word counts
are one aggregate, the lattice runs once per distinct word, and documents meet
the scored words in a join.  Only the most frequent words, whose number is
bounded, are broadcast to the document scan, so no frequent word is shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower_words, batches, file_bytes, store, text_or_empty

EM_ROUNDS = 3
#: Words that may be broadcast, and their longest form in bytes.
FREQUENT_WORDS = 100_000
FREQUENT_BYTES = 64
#: Probability of copying an earlier word of the same text.
COPY = 0.15
#: The end token: holds a space, so it is no word.
END = b" end"
FLUSH_WORDS = 200_000
LATTICE_ROWS = 4096
#: Bytes of a word whose arcs are held at a time.
WINDOW = 4096


def load_pieces(model: bytes) -> tuple[list[bytes], np.ndarray]:
    """(surface bytes, initial log probability) of a sentencepiece vocabulary.

    The word mark is a space; control pieces and pieces with a space elsewhere
    are dropped; byte pieces and one-byte pieces are one entry each.  Scores
    that are ranks (0, -1, -2 ...) become Zipf weights, others are taken as log
    probabilities.
    """
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    found: dict[bytes, float] = {}
    scores = [sp.get_score(i) for i in range(sp.get_piece_size())]
    ranks = min(scores) < -1000
    for i, score in enumerate(scores):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            continue
        piece = sp.id_to_piece(i)
        raw = bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode()
        weight = (1.0 / (1.0 - score) if ranks else math.exp(score)) if not sp.is_byte(i) else 0.0
        if b" " not in raw[1:]:
            found[raw] = max(found.get(raw, 0.0), weight)
    for i in range(256):
        found.setdefault(bytes([i]), 0.0)
    surfaces = sorted(found)
    w = np.array([found[s] for s in surfaces])
    w = np.maximum(w, w[w > 0].min() * 0.1)
    return surfaces, np.log(w / w.sum())


class Lattice:
    """A byte trie of the pieces as one transition table, and the recursions."""

    def __init__(self, surfaces: list[bytes]):
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for pid, s in enumerate(surfaces):
            at = 0
            for byte in s:
                at = nodes.setdefault((at, byte), len(nodes) + 1)
            ends[at] = pid
        self.next = np.zeros((len(nodes) + 1, 256), np.int32)
        for (a, byte), b in nodes.items():
            self.next[a, byte] = b
        self.piece = np.full(len(nodes) + 1, -1, np.int32)
        self.piece[list(ends)] = list(ends.values())
        self.size = len(surfaces)

    def _arcs(self, rows: np.ndarray, size: np.ndarray, first: int = 0,
              last: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, row numbers, piece ids) of all arcs, or of those that start
        in [first, last), starts ascending."""
        width = rows.shape[1]
        for s in range(first, width if last is None else min(last, width)):
            live = np.flatnonzero(size > s)
            state = np.zeros(len(live), np.int32)
            for e in range(s, width):
                inside = size[live] > e
                live, state = live[inside], state[inside]
                state = self.next[state, rows[live, e]]
                on = state > 0
                live, state = live[on], state[on]
                if not len(live):
                    break
                pid = self.piece[state]
                hit = pid >= 0
                if hit.any():
                    yield s, e + 1, live[hit], pid[hit]

    @staticmethod
    def _matrix(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(w) for w in words])
        width = int(size.max())
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        return raw, size

    def forward(self, words: list[bytes], logp: np.ndarray) -> np.ndarray:
        """Natural log of the marginal probability of each string."""
        rows, size = self._matrix(words)
        alpha = np.full((len(words), rows.shape[1] + 1), -np.inf)
        alpha[:, 0] = 0.0
        for s, e, at, pid in self._arcs(rows, size):
            alpha[at, e] = np.logaddexp(alpha[at, e], alpha[at, s] + logp[pid])
        return alpha[np.arange(len(words)), size]

    def expected(self, words: list[bytes], logp: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece over the strings (each once)."""
        rows, size = self._matrix(words)
        n = np.arange(len(words))
        alpha = np.full((len(words), rows.shape[1] + 1), -np.inf)
        beta = alpha.copy()
        alpha[:, 0] = 0.0
        beta[n, size] = 0.0
        windows = range(0, rows.shape[1], WINDOW)
        held: list = []
        for w in windows:
            held = list(self._arcs(rows, size, w, w + WINDOW))
            for s, e, at, pid in held:
                alpha[at, e] = np.logaddexp(alpha[at, e], alpha[at, s] + logp[pid])
        total = alpha[n, size]
        out = np.zeros(self.size)
        # backwards, the arcs of a window are made again: only one window's are held
        for w in reversed(windows):
            arcs = held if w == windows[-1] else list(self._arcs(rows, size, w, w + WINDOW))
            for s, e, at, pid in reversed(arcs):
                through = logp[pid] + beta[at, e]
                beta[at, s] = np.logaddexp(beta[at, s], through)
                out += np.bincount(pid, np.exp(alpha[at, s] + through - total[at]), self.size)
        return out

    @staticmethod
    def groups(words: list[bytes]) -> Iterator[list[int]]:
        """Places of words of like length, at most LATTICE_ROWS at a time (and
        fewer of long ones, so a matrix stays small)."""
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        lo = 0
        while lo < len(order):
            hi = lo + 1
            while hi < len(order) and hi - lo < LATTICE_ROWS and (
                    (hi - lo + 1) * len(words[order[hi]]) < 1 << 18):
                hi += 1
            yield order[lo:hi]
            lo = hi


_LATTICES: dict[int, Lattice] = {}


def _lattice(key: int, surfaces) -> Lattice:
    if key not in _LATTICES:
        _LATTICES.clear()
        _LATTICES[key] = Lattice(surfaces.value)
    return _LATTICES[key]


def count_words(docs: DataFrame, train: Column, text_col: str = "text") -> DataFrame:
    """(word, c, c_all): how often each word and the end token occur in the
    training rows and in all rows."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("c_all", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {True: Counter(), False: Counter()}

        def out():
            rows = ((w, seen[True][w], seen[True][w] + seen[False][w]) for w in seen[True].keys() | seen[False].keys())
            yield from batches(schema, rows, 1 << 14)

        for b in parts:
            for text, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen[t].update(ascii_lower_words(text))
                seen[t][END] += 1
                if len(seen[True]) + len(seen[False]) > FLUSH_WORDS:
                    yield from out()
                    seen = {True: Counter(), False: Counter()}
        yield from out()

    parts = docs.select(text_or_empty(text_col).alias("t"), F.coalesce(train, F.lit(False)).alias("train"))
    return parts.mapInArrow(run, "word binary, c long, c_all long").groupBy("word").agg(
        F.sum("c").alias("c"), F.sum("c_all").alias("c_all"))


def estimate(words: DataFrame, surfaces, key: int, logp: np.ndarray, rounds: int = EM_ROUNDS,
             smooth: float = 0.1) -> np.ndarray:
    """EM over the distinct training words; only one sum per piece reaches the
    driver in each round."""
    sc = words.sparkSession.sparkContext
    seen = words.where((F.col("c") > 0) & (F.col("word") != F.lit(bytearray(END)))).select("word")
    schema = pa.schema([("piece", pa.int32()), ("n", pa.float64())])
    for _ in range(rounds):
        at = sc.broadcast(logp)

        def run(parts: Iterator[pa.RecordBatch], at=at) -> Iterator[pa.RecordBatch]:
            model, total = _lattice(key, surfaces), None
            for b in parts:
                strings = [b" " + w for w in b.column(0).to_pylist()]
                for group in model.groups(strings):
                    got = model.expected([strings[i] for i in group], at.value)
                    total = got if total is None else total + got
            if total is not None:
                used = np.flatnonzero(total > 0)
                yield from batches(schema, zip(used.tolist(), total[used].tolist(), strict=True), 1 << 15)

        sums = seen.mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        counts = np.full(len(logp), smooth)
        for r in sums:
            counts[r["piece"]] += r["n"]
        logp = np.log(counts / counts.sum())
    return logp


def _levels(words: DataFrame) -> int:
    """The least count that keeps the words broadcast below FREQUENT_WORDS."""
    step = F.floor(F.log2(F.col("c_all").cast("double")) * 4).cast("int")
    rows = words.where((F.col("c_all") > 1) & (F.length("word") <= FREQUENT_BYTES)).groupBy(step.alias("k")).agg(
        F.count("*").alias("n")).collect()
    least, total = None, 0
    for r in sorted(rows, key=lambda r: -r["k"]):
        total += r["n"]
        if total > FREQUENT_WORDS:
            break
        least = r["k"]
    return 1 << 62 if least is None else math.ceil(2.0 ** (least / 4) - 1e-9)


SCORES = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
          "word binary, n long, again array<double>")
_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                    ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
                    ("word", pa.binary()), ("n", pa.int64()), ("again", pa.list_(pa.float64()))])


def _ranks(codes: np.ndarray) -> np.ndarray:
    """How often each entry's value occurs before it."""
    order = np.argsort(codes, kind="stable")
    held = codes[order]
    start = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
    out = np.empty(len(codes), np.int64)
    out[order] = np.arange(len(codes)) - np.repeat(start, np.diff(np.append(start, len(codes))))
    return out


def _split(words: list[bytes], index: dict[bytes, int], table: np.ndarray):
    """Of a text's tokens (the end token last): known tokens, base and model
    scores of those in the table, and the others as word -> chances of copying
    it at each further use.  The model score already holds the others' factor
    for not copying at their first use."""
    n = len(words)
    places = np.fromiter((index.get(w, -1) for w in words), np.int64, n)
    here = places >= 0
    names: dict[bytes, int] = {}
    for i in np.flatnonzero(~here).tolist():
        places[i] = len(table) + names.setdefault(words[i], len(names))
    rank = _ranks(places)
    before = np.arange(n)
    copied = COPY * rank / np.maximum(before, 1)
    own = np.where(before > 0, 1.0 - COPY, 1.0)
    found = table[places[here]]
    score = float(np.log10(own[here] * found[:, 1] + copied[here]).sum())
    score += float(np.log10(own[~here & (rank == 0)]).sum())
    others: dict[bytes, list[float]] = {w: [] for w in names}
    for i in np.flatnonzero(~here & (rank > 0)).tolist():
        others[words[i]].append(float(copied[i]))
    return int(found[:, 2].sum()), float(found[:, 0].sum()), score, others


def score_documents(docs: DataFrame, held_out: Column, piece_file: str, id_col: str = "doc_id",
                    text_col: str = "text", rounds: int = EM_ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    per row; the model is learned from the rows that are not held out.

    NULL and empty texts are the end token alone.  Without training rows the
    base is log10(1 / 1) per token and the model gives half its mass to the end
    token, half to the lattice.  Repeated rows stay rows of their own; words of
    any length are scored whole; extra columns are ignored; an empty table
    gives an empty one.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    names, first = load_pieces(file_bytes(piece_file))
    surfaces, key = sc.broadcast(names), hash((piece_file, len(names)))
    words = store(count_words(docs, ~held_out, text_col), "lm-words")
    t = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v"),
                  F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")).first()
    total, kinds = int(t["n"]), int(t["v"])
    cut = (t["n1"] / (t["n1"] + 2 * t["n2"])) if t["n1"] else 0.5
    cut = min(max(cut, 0.1), 0.9)
    logp = estimate(words, surfaces, key, first, rounds) if kinds else first
    at = sc.broadcast(logp)
    spread = cut * kinds / total if total else 0.5

    def lattice(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _lattice(key, surfaces)
        for b in parts:
            raw = b.column(0).to_pylist()
            strings = [b" " + w for w in raw]
            c = np.array(b.column(1).to_pylist(), float)
            inner = np.empty(len(raw))
            for group in model.groups(strings):
                inner[group] = model.forward([strings[i] for i in group], at.value)
            seen = np.where(c > 0, (c - cut) / max(total, 1), 0.0)
            is_end = np.array([w == END for w in raw])
            with np.errstate(divide="ignore"):
                score = np.logaddexp(np.log(seen), np.where(is_end, -np.inf, inner + math.log(spread)))
            # without training rows the end token has the half of the mass that words do not
            score = np.where(is_end & (c == 0), math.log(0.5 if not total else 1.0 / (total + kinds + 1)), score)
            base = np.log10((c + 1) / (total + kinds + 1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(base),
                                              pa.array(score / math.log(10))],
                                             names=["word", "c", "c_all", "base", "model"])

    scored = store(words.mapInArrow(lattice, "word binary, c long, c_all long, base double, model double"), "lm-scored")
    least = _levels(words)
    # a chance too small for a double stays a logarithm, which the join keeps
    top = scored.where(((F.col("c_all") >= least) & (F.length("word") <= FREQUENT_BYTES) & (F.col("model") > -300))
                       | (F.col("word") == F.lit(bytearray(END)))).collect()  # FREQUENT_WORDS + 1 rows at most
    known = sc.broadcast(({bytes(r["word"]): i for i, r in enumerate(top)},
                          np.array([(r["base"], 10.0 ** r["model"], r["c"] > 0) for r in top], float).reshape(-1, 3)))

    def documents(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, table = known.value

        def rows() -> Iterator[tuple]:
            for b in parts:
                for row, doc, held, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                    ws = ascii_lower_words(text)
                    ws.append(END)
                    kn, base, model, rare = _split(ws, index, table)
                    head = (row, doc, held, len(ws), kn, base, model)
                    if not rare:  # a key that is no word, spread over the partitions
                        yield *head, b" %d" % row, 0, None
                    for k, (w, again) in enumerate(rare.items()):
                        first = head if k == 0 else (row, None, None, 0, 0, 0.0, 0.0)
                        yield *first, w, 1 + len(again), again or None
        yield from batches(_ARROW, rows(), 1 << 14)

    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.coalesce(held_out, F.lit(False)).alias("held"), text_or_empty(text_col).alias("t"))
    parts = src.mapInArrow(documents, SCORES)
    joined = parts.join(scored.select("word", F.col("base").alias("b"), F.col("model").alias("m"), "c"), "word", "left")
    n = F.col("n")
    more = F.aggregate("again", F.lit(0.0), lambda acc, r: acc + F.log10((1.0 - COPY) * F.pow(F.lit(10.0), "m") + r))
    model = F.when(n > 0, F.col("m") + F.coalesce(more, F.lit(0.0))).otherwise(0.0)
    return joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        (F.sum("n_known") + F.sum(F.when(F.col("c") > 0, n).otherwise(0))).alias("n_known"),
        (F.sum("base_score") + F.coalesce(F.sum(F.col("b") * n), F.lit(0.0))).alias("base_score"),
        (F.sum("score") + F.coalesce(F.sum(model), F.lit(0.0))).alias("score")).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
