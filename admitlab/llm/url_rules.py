"""URL filters (operator 12): host-suffix and path-prefix rules, native Spark.

A rule is (host, path, verdict).  It fits a URL whose host is the rule's host or
a subdomain of it and whose path starts with the rule's path; of the rules that
fit, the longest one (host and path together, then the longer host) decides.

Rules have shapes: (labels of the host, characters of the path).  Every distinct
URL is expanded into one expression per shape that it is long enough for, its
last labels and its first path characters, and each expression into a SHA-256
digest.  Expressions meet rules in an equi-join on the first 32 bits of the
digest; the full digest then confirms the match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALLOW, BLOCK = "allow", "block"
#: Hexadecimal digits of a digest that are joined on.
SHORT = 8
#: Rules are broadcast up to so many bytes of text and so many rows; more rules
#: meet the expressions in a shuffled join.
BROADCAST_BYTES, BROADCAST_RULES = 4 << 20, 50_000
#: In the shuffled join every rule is copied so often and every URL goes to one
#: of the copies, so an expression shared by a third of the URLs is spread.
SALTS = 32


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def _until(c: Column, stops: str) -> Column:
    for s in stops:
        c = F.substring_index(c, s, 1)
    return c


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path).  The host runs from the first ``://`` up to ``/``, ``?``,
    ``#`` or the end, A-Z in lower case; the path from there up to ``?``, ``#``
    or the end.  NULL and texts without ``://`` have both empty."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = _until(rest, "/?#")
    return lower_ascii(host), _until(F.substring(rest, F.length(host) + 1, F.length(rest)), "?#")


def _digest(host: Column, path: Column) -> Column:
    # neither a host nor a path holds '#', so no two pairs share a text
    return F.sha2(F.concat(host, F.lit("#"), path), 256)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """One row per (host, path): labels, chars, digest, short, rule, verdict.

    Columns ``host``, ``path`` and ``verdict`` are read.  Rules with a NULL or
    with another verdict than allow and block fit nothing; repeated rules count
    once; of rules that contradict each other block wins.
    """
    host, path = lower_ascii(F.col("host").cast("string")), F.col("path").cast("string")
    known = (rules.select(host.alias("host"), path.alias("path"), F.col("verdict").cast("string").alias("verdict"))
             .where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isin(ALLOW, BLOCK))
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    out = known.select(_labels(F.col("host")).alias("labels"), F.length("path").alias("chars"),
                       _digest(F.col("host"), F.col("path")).alias("digest"), F.length("host").alias("host_chars"),
                       F.concat("host", "path").alias("rule"), "verdict")
    return out.withColumn("short", F.substring("digest", 1, SHORT))


def _expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Digests of a URL's expressions, one per shape it is long enough for."""
    wanted = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(c).alias("c")) for n, c in shapes])
    fits = F.filter(wanted, lambda s: (s["n"] <= _labels(host)) & (s["c"] <= F.length(path)))
    return F.transform(fits, lambda s: _digest(F.call_function("substring_index", host, F.lit("."), -s["n"]),
                                               F.substring(path, F.lit(1), s["c"])))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", out_col: str = "judged",
               default: str = ALLOW, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """``pages`` with a struct column ``out_col``: host, path, rule, verdict.

    ``rule`` is the text of the rule that decides (host and path in a row), NULL
    where none fits; ``verdict`` is its verdict, else ``default``.  A NULL URL
    and one without ``://`` have an empty host and path, which only a rule of an
    empty host and path fits.  URLs of any length are judged whole; repeated
    rows stay repeated; an empty table gives an empty one, and no rules give
    ``default`` everywhere.  A column named ``out_col`` is replaced, all others
    are kept and never clash; they travel with the row in one shuffle, so leave
    out what is not needed.

    Distinct URLs are expanded, not rows, so a URL or host that holds a third of
    the rows is one entry.  The distinct shapes of the rules are collected: at
    most the labels of a host times the lengths of a path, whatever the number
    of rules.
    """
    known = store(prepare_rules(rules), "url-rules")
    n, size = known.agg(F.count("*"), F.coalesce(F.sum(F.length("rule")), F.lit(0))).first()
    host, path = url_parts(F.col(f"`{url_col}`"))
    urls = pages.select(host.alias("host"), path.alias("path")).distinct()
    shapes = [tuple(r) for r in known.select("labels", "chars").distinct().orderBy("labels", "chars").collect()]
    if shapes:
        expressions = (urls.select("host", "path", F.explode(_expressions(F.col("host"), F.col("path"), shapes)).alias("full"))
                       .withColumn("short", F.substring("full", 1, SHORT)))
        if n <= broadcast_rules and size <= BROADCAST_BYTES:
            met = expressions.join(F.broadcast(known), "short")
        else:
            copies = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            salted = expressions.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int"))
            met = salted.join(copies, ["short", "salt"])
        decided = (met.where(F.col("full") == F.col("digest")).groupBy("host", "path")
                   .agg(F.max(F.struct(F.length("rule").alias("size"), "host_chars", "rule", "verdict")).alias("best")))
        decided = store(decided.select("host", "path", "best.rule", "best.verdict"), "url-decided")
    else:
        decided = urls.where("false").select("host", "path", F.lit("").alias("rule"), F.lit("").alias("verdict"))
    kept = [c for c in pages.columns if c.lower() != out_col.lower()]
    row = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), host.alias("host"), path.alias("path"))
    judged = row.join(decided, ["host", "path"], "left")
    return judged.select("row.*", F.struct("host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
                         .alias(out_col))
