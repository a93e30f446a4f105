"""Small dense logistic fits on the driver, for bounded samples."""

from __future__ import annotations

import math

import numpy as np


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def logit(p: float) -> float:
    return math.log(p / (1.0 - p))


def fit(x: np.ndarray, target: np.ndarray, weight: np.ndarray | None = None, l2: float = 1.0,
        rounds: int = 30) -> np.ndarray:
    """Coefficients of logistic regression on (soft) targets by Newton steps,
    halved while the loss does not fall.  No intercept is added."""
    n, d = x.shape
    w = np.ones(n) if weight is None else weight
    beta = np.zeros(d)

    def loss(b):
        z = x @ b
        return float((w * (np.logaddexp(0, z) - target * z)).sum() + 0.5 * l2 * b @ b)

    now = loss(beta)
    for _ in range(rounds):
        p = sigmoid(x @ beta)
        grad = x.T @ (w * (p - target)) + l2 * beta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + l2 * np.eye(d)
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while size > 1e-4 and (after := loss(beta - size * step)) > now:
            size /= 2
        if size <= 1e-4:
            break
        beta = beta - size * step
        if now - after < 1e-7 * max(1.0, abs(now)):
            break
        now = after
    return beta


def widest_gap(scores: np.ndarray, level: float, slack: float = 0.02) -> float:
    """A threshold at the ``level`` quantile of the scores: the middle of the
    widest gap between neighbours whose rank is within ``slack`` of it."""
    s = np.sort(scores)
    lo = max(1, int((level - slack) * len(s)))
    hi = min(len(s) - 1, max(lo, int(np.ceil((level + slack) * len(s)))))
    if len(s) < 2:
        return float(s[0]) if len(s) else 0.0
    gaps = s[lo:hi + 1] - s[lo - 1:hi]
    k = lo + int(gaps.argmax())
    return float((s[k] + s[k - 1]) / 2)


def best_f1_cut(scores: np.ndarray, y: np.ndarray) -> float:
    """The threshold of highest F1 for y = 1 (of equal ones, the widest gap)."""
    if len(y) == 0:
        return 0.0
    if y.min() == y.max():
        return float(scores.max() + 1 if y[0] == 0 else scores.min() - 1)
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], np.cumsum(y[order])
    k = np.arange(1, len(s) + 1)
    f1 = 2 * hit / (k + hit[-1])
    after = np.append(s[1:], s[-1] - 1.0)
    gap = s - after
    f1[gap <= 0] = -1
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    j = best[gap[best].argmax()]
    return float((s[j] + after[j]) / 2)
