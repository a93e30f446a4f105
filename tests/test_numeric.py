"""Exact rounding equals rational arithmetic (half away from zero)."""

import random
from fractions import Fraction

from pyspark.sql import functions as F

from admitlab.functions.numeric import rdiv


def _round_half_away(fr: Fraction, digits: int) -> float:
    """Exact rounding to an integer count of 10^-digits, then the one IEEE
    conversion and division both engines perform: float(q) / 10^digits."""
    scaled = fr * 10 ** digits
    sign = -1 if scaled < 0 else 1
    a = abs(scaled)
    q, r = divmod(a.numerator, a.denominator)
    if 2 * r >= a.denominator:
        q += 1
    return float(sign * q) / float(10 ** digits)


def test_rdiv_matches_fractions(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(400):
        num = rnd.choice([rnd.randint(-10**6, 10**6), rnd.randint(-10**17, 10**17), rnd.randint(-50, 50)])
        den = rnd.choice([rnd.randint(1, 1000), rnd.randint(1, 10**12), 2, 4, 8])
        rows.append((num, den, rnd.choice([0, 1, 2, 3, 4])))
    df = spark.createDataFrame(rows, "n long, d long, k int")
    got = {}
    for k in range(5):
        for r in df.filter(F.col("k") == k).select("n", "d", rdiv(F.col("n"), F.col("d"), k).alias("v")).collect():
            got[(r["n"], r["d"], k)] = r["v"]
    for n, d, k in rows:
        want = _round_half_away(Fraction(n, d), k) + 0.0
        assert got[(n, d, k)] == want, (n, d, k, got[(n, d, k)], want)
        assert str(got[(n, d, k)]) != "-0.0"
