"""Quality classifier by Bradley-Terry pairwise ranking (operator 8).

Preference pairs set a labelled good document against a labelled bad one.  A
document's score is linear in features of its text, and P(good beats bad) is
the logistic function of the difference of their scores, so the fit is a
logistic regression without intercept on feature differences.  The threshold
is the quantile of the training scores at the share of bad labels.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty
from .labelled import labelled_sample
from .logistic import fit, logit, sigmoid, widest_gap

#: At most about this many labelled rows are used for the fit.
MAX_ROWS = 20_000
MAX_PAIRS = 40_000
KNOTS = (0.05, 0.25, 0.5, 0.75, 0.95)

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = b"0123456789"
_SYMBOL = b"#*$%&|<>@^~_=+{}[]\\"
_SHOUT = b"!?"
_STOP = b".,;:"

FEATURES = ("log_words", "word_len", "symbols", "capitals", "shouts", "digits", "stops", "non_ascii", "distinct",
            "repeats", "top_share", "odd_words", "same_lines", "line_len", "window_repeats", "longest")


def features(text: str) -> list[float]:
    """Statistics of a text in the order of ``FEATURES``; all 0 without words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(FEATURES)

    def share(chars: bytes) -> float:
        return (size - len(raw.translate(None, chars))) / size

    upper, lower = share(_UPPER), share(_LOWER)
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = max(0, n - 2)
    return [
        float(np.log1p(n)), sum(map(len, words)) / n, share(_SYMBOL), upper / max(upper + lower, 1e-9), share(_SHOUT),
        share(_DIGIT), share(_STOP), 1.0 - len(raw.translate(None, bytes(range(128, 256)))) / size, len(counts) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n, max(counts.values()) / n,
        sum(c for w, c in counts.items() if not w.translate(None, _SYMBOL + _SHOUT + _STOP)) / n,
        1.0 - len(set(lines)) / len(lines), float(np.log1p(n / len(lines))),
        1.0 - len(set(zip(words, words[1:], words[2:]))) / windows if windows else 0.0,
        float(np.log1p(max(map(len, counts)))),
    ]


@dataclass(frozen=True)
class RankModel:
    """Scaling, hinge places, weights and the threshold of the raw score."""

    mean: np.ndarray
    scale: np.ndarray
    knots: np.ndarray
    beta: np.ndarray
    cut: float

    def basis(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([z] + [np.maximum(0.0, z - k) for k in self.knots])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.basis(x) @ self.beta

    def score(self, x: np.ndarray, accept: float) -> np.ndarray:
        """0 to 1, with ``accept`` at the threshold."""
        return sigmoid(self.raw(x) - self.cut + logit(accept))


def pairs(y: np.ndarray, max_pairs: int = MAX_PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of (good, bad) pairs: the lists of both labels are walked in
    step, the shorter one again and again with a shift, so that every row takes
    part and no pair repeats before all shifts are used."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return np.empty(0, int), np.empty(0, int)
    m = min(max_pairs, len(good) * len(bad), 4 * max(len(good), len(bad)))
    k = np.arange(m)
    longer, shorter = (good, bad) if len(good) >= len(bad) else (bad, good)
    a = longer[k % len(longer)]
    b = shorter[(k % len(longer) + k // len(longer)) % len(shorter)]
    return (a, b) if longer is good else (b, a)


def train(x: np.ndarray, y: np.ndarray, l2: float = 1.0) -> RankModel:
    """Fit on feature rows and labels.  With one label only, every score is at
    the side of that label."""
    x = x.reshape(-1, len(FEATURES))
    mean = x.mean(axis=0) if len(x) else np.zeros(len(FEATURES))
    scale = x.std(axis=0) if len(x) else np.ones(len(FEATURES))
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - mean) / scale
    knots = np.quantile(z, KNOTS, axis=0) if len(x) else np.zeros((len(KNOTS), len(FEATURES)))
    model = RankModel(mean, scale, knots, np.zeros(len(FEATURES) * (1 + len(KNOTS))), 0.0)
    good, bad = pairs(y)
    if not len(good):
        return RankModel(mean, scale, knots, model.beta, 2.0 if len(y) and y[0] == 0 else -2.0)
    b = model.basis(x)
    beta = fit(b[good] - b[bad], np.ones(len(good)), l2=l2)
    return RankModel(mean, scale, knots, beta, widest_gap(b @ beta, float((y == 0).mean())))


def fit_quality(docs: DataFrame, labels: DataFrame, held_mod: int = 5, held_rest: int = 0,
                max_rows: int = MAX_ROWS, label: str = "quality", text_col: str = "text") -> RankModel:
    """Model from about ``max_rows`` labelled documents that are not held out
    (``labelled_sample``) and at most ``MAX_PAIRS`` pairs of them.

    NULL and empty texts take part with all-zero features, texts of any length
    are read whole; repeated rows count once and ties among features cost
    nothing; labels of one kind only, or an empty table, give a constant score;
    other columns are not read."""
    rows = labelled_sample(docs, labels, label, max_rows, held_mod, held_rest, text_col=text_col)
    got = rows.select("doc_id", "y", _feature_udf(F.col("text")).alias("x")).toPandas().sort_values(["doc_id", "y"])
    return train(np.array(got["x"].tolist(), float), got["y"].to_numpy(int))


def _feature_udf(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([features(t or "") for t in texts.to_pylist()], pa.list_(pa.float64()))
    return run(text)


def quality_score(model: RankModel, text_col: str = "text", accept: float = 0.3) -> Column:
    """Score of a text, 0 to 1; ``accept`` or more means good.  NULL and empty
    texts have the score of the all-zero features; texts of any length are read
    whole; equal texts have equal scores; an empty table has none."""
    data = (model, accept)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        m, at = data
        rows = [features(t or "") for t in texts.to_pylist()]
        return pa.array(m.score(np.array(rows, float).reshape(-1, len(FEATURES)), at), pa.float64())

    return run(text_or_empty(text_col))
