"""Toxicity by weak supervision (operator 5).

Voters look at a text and vote "toxic" or abstain: lexicon voters fire on a
word, prefix voters on the beginning of a word (for inflected and compounded
forms), pattern voters on the shape of the text.  Lexicon and prefixes are the
strings most strongly tied to label 1 among labelled training rows.

A generative label model treats the true class as hidden: EM starts from how
many term voters of a text agree and estimates each voter's firing rate in either
class (its accuracy) from the votes alone.  Voters that depend on each other
within a class are found from their correlations, and their evidence counts
once together.  The posteriors of the voters train the linear classifier that
scores texts.  Gold labels choose the lexicon and, at the end, the cut; they have
no part in the label model.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, store, text_or_empty
from .labelled import labelled_sample
from .logistic import best_f1_cut, fit, logit, sigmoid

#: At most about this many labelled rows are used for the fit.
MAX_ROWS = 20_000
MAX_LEXICON = 160
MIN_HITS = 4
PREFIXES = (4, 5, 6)
#: Chance of label 1 that EM starts from, by the number of distinct words and
#: beginnings of words that vote: none, one, two, three or more.
AGREEMENT = (0.01, 0.5, 0.9, 0.97)
#: Votes added to each class when firing rates are estimated.
ADDED_VOTES = 0.05
#: Correlation within a class above which voters are taken for dependent.
TIED = 0.5

_BREAKS = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalnum()),
                          b" " * sum(not chr(c).isalnum() for c in range(128)))
#: Digits and signs that stand for letters inside a word.
_SIGNS = b"013457@$"
_STANDS_FOR = bytes.maketrans(_SIGNS, b"oieastas")
_CAPITALS, _SMALL = bytes(range(65, 91)), bytes(range(97, 123))
_MASKS = b"*#@$%"
_MASKED = re.compile(rb"[A-Za-z\x80-\xff][*#@$%]+[A-Za-z\x80-\xff]")

PATTERNS = ("capitals", "many_shouts", "masked_word", "disguised_word", "mostly_shouts")


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _holds(raw: bytes, chars: bytes) -> bool:
    return len(raw.translate(None, chars)) < len(raw)


def _disguised(low: bytes) -> list[bytes]:
    """Words that mix letters with signs that stand for letters, in plain form."""
    if not _holds(low, _SIGNS):
        return []
    cut = low.translate(_KEEP_SIGNS).split()
    return [w.translate(_STANDS_FOR) for w in cut if _holds(w, _SIGNS) and len(w.translate(None, _SIGNS)) * 3 >= len(w)]


_KEEP_SIGNS = bytes(c if c >= 128 or chr(c).isalnum() or c in _SIGNS else 32 for c in range(256))


def words_of(text: str) -> set[str]:
    """The different words of a text in lower case, cut at ASCII characters
    other than letters and digits; words disguised with digits or signs also in
    their plain form."""
    low = _bytes(text.lower())
    found = set(low.translate(_BREAKS).split())
    found.update(_disguised(low))
    return {w.decode("utf-8", "replace") for w in found}


def shape_votes(text: str) -> list[float]:
    """Votes of the pattern voters, in the order of ``PATTERNS``."""
    raw = _bytes(text)
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    small = len(raw) - len(raw.translate(None, _SMALL))
    shouts = raw.count(b"!")
    return [float(capitals > small), float(raw.count(b"!!") > 2),
            float(_holds(raw, _MASKS) and bool(_MASKED.search(raw))), float(bool(_disguised(raw.lower()))),
            float(shouts * 3 > raw.count(b" ") + 1)]


def candidates(words: set[str]) -> set[str]:
    """Lexicon and prefix candidates ("word" and "pref*") of a text's words."""
    return {w for w in words if 2 < len(w) <= 40} | {w[:k] + "*" for w in words for k in PREFIXES if len(w) >= k}


def learn_lexicon(rows: DataFrame, max_size: int = MAX_LEXICON, min_hits: int = MIN_HITS) -> list[str]:
    """The candidates most strongly tied to y = 1 in rows (text, y): those whose
    share of y = 1 is well above the average, strongest first by z score."""
    schema = pa.schema([("term", pa.string()), ("hits", pa.int64()), ("misses", pa.int64())])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            seen = {0: Counter(), 1: Counter()}
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen[int(y == 1)].update(candidates(words_of(text)))
            yield from batches(schema, ((t, seen[1][t], seen[0][t]) for t in seen[0] | seen[1]), 1 << 14)

    totals = rows.agg(F.coalesce(F.sum("y"), F.lit(0)), F.count("*")).first()
    if not totals[1] or not totals[0] or totals[0] == totals[1]:
        return []
    base = totals[0] / totals[1]
    terms = rows.select("text", "y").mapInArrow(count, "term string, hits long, misses long")
    terms = terms.groupBy("term").agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses"))
    n = F.col("hits") + F.col("misses")
    terms = terms.withColumn("z", (F.col("hits") - n * base) / F.sqrt(n * base * (1 - base)))
    terms = terms.where((F.col("hits") >= min_hits) & (F.col("z") > 4.0) & (F.col("hits") > 0.5 * n))
    return [r["term"] for r in terms.orderBy(F.desc("z"), "term").limit(max_size).collect()]


class Voters:
    """Lexicon, prefix and pattern voters in a fixed order."""

    def __init__(self, lexicon: list[str]):
        self.names = [*lexicon, *PATTERNS]
        self.at = {t: i for i, t in enumerate(lexicon) if not t.endswith("*")}
        self.prefix = {t[:-1]: i for i, t in enumerate(lexicon) if t.endswith("*")}
        self.short = {p[:min(PREFIXES)] for p in self.prefix}
        self.n_terms = len(lexicon)

    def votes(self, text: str) -> np.ndarray:
        """1 where a voter says toxic, 0 where it abstains; last: log of the
        number of different words that a term voter fired on."""
        out = np.zeros(len(self.names) + 1)
        hit, k0 = 0, min(PREFIXES)
        for w in words_of(text):
            fired = False
            if w in self.at:
                out[self.at[w]], fired = 1.0, True
            if w[:k0] in self.short:
                for k in PREFIXES:
                    j = self.prefix.get(w[:k])
                    if j is not None and len(w) >= k:
                        out[j], fired = 1.0, True
            hit += fired
        out[self.n_terms:-1] = shape_votes(text)
        out[-1] = np.log1p(hit)
        return out


@dataclass(frozen=True)
class LabelModel:
    """Firing rates by class, weight of each voter's evidence, prior."""

    rate1: np.ndarray
    rate0: np.ndarray
    share: np.ndarray
    prior: float

    def evidence(self, votes: np.ndarray) -> np.ndarray:
        """Log odds of label 1: the prior and the voters that fire.  A voter that
        abstains says nothing, as most of them know only a few words."""
        return votes @ (np.log(self.rate1 / self.rate0) * self.share) + logit(self.prior)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return sigmoid(self.evidence(votes))


def agreement(votes: np.ndarray, n_terms: int) -> np.ndarray:
    """The chance of label 1 that EM starts from, by the votes of the first
    ``n_terms`` voters: words and their beginnings.  Those that always fire
    together are one.  Patterns of shape get their accuracy from EM only: they
    may agree on something that is not toxic."""
    distinct = {hashlib.sha256(votes[:, j].tobytes()).digest(): j for j in range(n_terms)}
    agree = np.zeros(len(votes))
    for j in distinct.values():
        agree += votes[:, j]
    return np.array(AGREEMENT)[np.minimum(agree, len(AGREEMENT) - 1).astype(int)]


def fit_label_model(votes: np.ndarray, n_terms: int, rounds: int = 30) -> tuple[LabelModel, np.ndarray]:
    """EM over the hidden class from the votes alone; returns the model and the
    posterior of each row.  A row on which no term voter fires keeps the chance it
    starts from."""
    n, v = votes.shape
    post = agreement(votes, n_terms)
    silent = votes[:, :n_terms].sum(axis=1) == 0
    share = np.ones(v)
    model = None
    for _ in range(rounds):
        w1, w0 = post.sum(), (1 - post).sum()
        # as many votes are added to either class, so a voter that never fires says nothing
        odds = w0 / max(w1, 1.0)
        rate1 = (post @ votes + ADDED_VOTES) / (w1 + 2 * ADDED_VOTES)
        rate0 = ((1 - post) @ votes + ADDED_VOTES * odds) / (w0 + 2 * ADDED_VOTES * odds)
        rate1, rate0 = np.clip(rate1, 1e-6, 1 - 1e-6), np.clip(rate0, 1e-6, 1 - 1e-6)
        # dependence within a class, over the rows that are more likely in it than not: a few rows
        # of the other class would make all its voters look dependent here
        tied = np.zeros((v, v))
        for inside in (post > 0.5, post <= 0.5):
            centred = votes[inside] if inside.any() else np.zeros((1, v))
            centred -= centred.mean(axis=0)
            cov = centred.T @ centred / max(1, len(centred))
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            tied = np.maximum(tied, cov / sd / sd[:, None])
        tied = np.where(tied > TIED, np.minimum(tied, 1.0), 0.0)
        np.fill_diagonal(tied, 1.0)
        share = 1.0 / tied.sum(axis=1)
        model = LabelModel(rate1, rate0, share, float(np.clip(w1 / n, 1e-4, 1 - 1e-4)))
        new = np.where(silent, AGREEMENT[0], model.posterior(votes))
        done = np.abs(new - post).max() < 1e-4
        post = new
        if done:
            break
    return model, post


@dataclass(frozen=True)
class ToxicModel:
    lexicon: tuple
    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    cut: float

    def raw(self, votes: np.ndarray) -> np.ndarray:
        return np.hstack([np.ones((len(votes), 1)), (votes - self.mean) / self.scale]) @ self.beta


def train(lexicon: list[str], votes: np.ndarray, y: np.ndarray) -> ToxicModel:
    """Label model, then the linear classifier on its posteriors.  Without rows
    of both labels every score is on the side of the one seen (no rows: 0)."""
    votes = votes.reshape(-1, len(lexicon) + len(PATTERNS) + 1)
    d = votes.shape[1]
    if len(y) == 0 or y.min() == y.max():
        beta = np.zeros(d + 1)
        beta[0] = 4.0 if len(y) and y[0] == 1 else -4.0
        return ToxicModel(tuple(lexicon), np.zeros(d), np.ones(d), beta, 0.0)
    _, post = fit_label_model(votes[:, :-1], len(lexicon))
    mean, scale = votes.mean(axis=0), np.maximum(votes.std(axis=0), 1e-2)
    x = np.hstack([np.ones((len(votes), 1)), (votes - mean) / scale])
    beta = fit(x, post, l2=1.0)
    return ToxicModel(tuple(lexicon), mean, scale, beta, best_f1_cut(x @ beta, y))


def fit_toxicity(docs: DataFrame, labels: DataFrame, held_mod: int = 4, held_rest: int = 2,
                 max_rows: int = MAX_ROWS, label: str = "toxic", text_col: str = "text") -> ToxicModel:
    """Model from about ``max_rows`` labelled documents that are not held out
    (``labelled_sample``).

    NULL and empty texts take part as texts on which no voter fires, texts of any
    length are read whole; repeated rows count once; of terms tied in strength the
    first in code-point order is taken; labels of one kind only, or an empty
    table, give a constant score; other columns are not read."""
    rows = store(labelled_sample(docs, labels, label, max_rows, held_mod, held_rest, text_col=text_col), "toxic-rows")
    lexicon = learn_lexicon(rows)

    @F.arrow_udf("array<double>")
    def vote(texts: pa.Array) -> pa.Array:
        voters = Voters(lexicon)
        return pa.array([voters.votes(t) for t in texts.to_pylist()], pa.list_(pa.float64()))

    got = rows.select("doc_id", "y", vote("text").alias("x")).toPandas().sort_values(["doc_id", "y"])
    votes, y = np.array(got["x"].tolist(), float), got["y"].to_numpy(int)
    del got
    return train(lexicon, votes, y)


def toxic_score(model: ToxicModel, text_col: str = "text", accept: float = 0.3) -> Column:
    """Score of a text, 0 to 1; ``accept`` or more means toxic.  NULL and empty
    texts are scored like a text on which no voter fires; texts of any length are
    read whole; equal texts have equal scores; an empty table has none."""
    data = (model, accept)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        m, at = data
        voters = Voters(list(m.lexicon))
        rows = np.array([voters.votes(t or "") for t in texts.to_pylist()], float).reshape(-1, len(voters.names) + 1)
        return pa.array(sigmoid(m.raw(rows) - m.cut + logit(at)), pa.float64())

    return run(text_or_empty(text_col))
