"""Quality rules: learned decision lists (operator 7), DataFrame functions only.

Statistics of a text are column expressions.  Sequential covering learns rules
that reject: a rule grows by the threshold literal of highest information gain
on two thirds of the labelled rows, is pruned on the other third, and the rows
it covers leave before the next rule.  Every count comes from one aggregate
over (statistic, bin, label); the driver sees only those counts.  The learned
list is an ordered chain of WHEN conditions.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, fresh, store, text_or_empty
from .labelled import labelled_sample

#: At most about this many labelled rows are used for learning.
MAX_ROWS = 20_000
BINS = 64
MAX_RULES = 12
MAX_LITERALS = 4
#: A rule must be this precise on the pruning rows, so clean texts stay.
MIN_PRECISION = 0.9
MIN_COVER = 3

SYMBOLS = "#*$%&|<>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(places: Column, width: int = 3) -> Column:
    """Number of positions in windows that start at ascending ``places``."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(acc: Column, i: Column) -> Column:
        return F.struct((acc["n"] + i + width - F.greatest(i, acc["end"])).alias("n"), (i + width).alias("end"))
    return F.aggregate(places, start, add, lambda acc: acc["n"])


def _repeat_words(w: Column) -> Column:
    """Words in 3-word windows that occur twice or more, each word once.

    Windows are compared by a 64-bit hash.  Texts whose windows are all
    different are known from their count; only the others sort theirs.
    """
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                          lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def sort(k: Column) -> Column:
        pairs = F.sort_array(F.transform(k, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def twice(s: Column) -> Column:
            def same(e: Column, j: Column) -> Column:
                return F.coalesce(F.get(s, j - 1)["x"] == e["x"], F.lit(False)) | F.coalesce(
                    F.get(s, j + 1)["x"] == e["x"], F.lit(False))
            return _covered(F.sort_array(F.transform(F.filter(s, same), lambda e: e["i"])))
        return _let(pairs, twice)

    return F.when(F.size(w) < 3, F.lit(0)).otherwise(_let(
        windows, lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), F.lit(0)).otherwise(sort(k))))


def text_stats(text: Column) -> Column:
    """Struct of statistics of a text (not NULL)."""
    words = F.filter(F.split(text, SPACE_CLASS), lambda x: x != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))

    def per_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                           (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("l"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_capitals"),
            F.length(F.regexp_replace(text, "[^!?]+", "")).cast("long").alias("n_shouts"))
    return _let(words, per_words)


#: Statistics that rules may test, from the struct of ``text_stats``.
MEASURES: dict[str, str] = {
    "symbols_per_char": "{s}.n_symbols / {s}.word_chars",
    "repeated_words": "{s}.n_repeat_words / {s}.n_words",
    "repeated_lines": "{s}.l.dup / {s}.l.n",
    "distinct_words": "{s}.n_distinct / {s}.n_words",
    "chars_per_word": "{s}.word_chars / {s}.n_words",
    "capitals_per_char": "{s}.n_capitals / {s}.word_chars",
    "shouts_per_word": "{s}.n_shouts / {s}.n_words",
    "words_per_line": "{s}.n_words / {s}.l.n",
}


def measure(name: str, stats: str) -> Column:
    """A measure as a column; 0 where a text has no words."""
    return F.when(F.col(f"{stats}.n_words") > 0, F.expr(MEASURES[name].format(s=f"`{stats}`"))).otherwise(F.lit(0.0))


def base_failed(stats: str) -> Column:
    n, r = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < 50) | (100 * r > 50 * n)


@dataclass(frozen=True)
class Literal:
    """``measure > edge`` (above) or ``measure <= edge``."""

    name: str
    edge: float
    above: bool

    def on(self, col: Column) -> Column:
        return col > self.edge if self.above else col <= self.edge

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.edge:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules, each a conjunction of literals; a text that no rule
    covers is kept."""

    rules: tuple[tuple[Literal, ...], ...]

    def verdict(self, stats: str) -> Column:
        """Number of the first rule that covers a text (from 1), 0 if none."""
        out = None
        for k, rule in enumerate(self.rules, 1):
            cond = _all(rule, lambda n: measure(n, stats))
            out = F.when(cond, F.lit(k)) if out is None else out.when(cond, F.lit(k))
        return F.lit(0) if out is None else out.otherwise(F.lit(0))

    def __str__(self) -> str:
        return "\n".join(f"{k}: reject if " + " and ".join(map(str, r)) for k, r in enumerate(self.rules, 1))


def _all(rule: tuple[Literal, ...], col: Callable[[str], Column]) -> Column:
    cond = F.lit(True)
    for lit in rule:
        cond = cond & lit.on(col(lit.name))
    return cond


def _gain(p0: float, n0: float, p: float, n: float) -> float:
    """Information gain of FOIL: covered positives times the bits won."""
    if p <= 0:
        return -math.inf
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _best_literal(rows: DataFrame, names: list[str], edges: dict[str, list[float]]) -> tuple[Literal | None, float]:
    """The literal of highest gain on rows (y, one column per measure)."""
    bins = [F.struct(F.lit(n).alias("m"), sum((F.when(F.col(n) > e, 1).otherwise(0) for e in edges[n]), F.lit(0)).alias("b"))
            for n in names if edges[n]]
    if not bins:  # no rows to learn from
        return None, 0.0
    counts = rows.select("y", F.explode(F.array(*bins)).alias("x")).groupBy("x.m", "x.b").agg(
        F.sum(1 - F.col("y")).alias("pos"), F.sum("y").alias("neg")).collect()
    best, top = None, 0.0
    for name in names:
        got = {r["b"]: (r["pos"], r["neg"]) for r in counts if r["m"] == name}
        p0, n0 = sum(p for p, _ in got.values()), sum(n for _, n in got.values())
        if not p0:
            continue
        p = n = 0
        for k, edge in enumerate(edges[name]):
            p, n = p + got.get(k, (0, 0))[0], n + got.get(k, (0, 0))[1]
            for above, (a, b) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                if a >= MIN_COVER and (g := _gain(p0, n0, a, b)) > top + 1e-9:
                    best, top = Literal(name, edge, above), g
    return best, top


def _centred(rows: DataFrame, lit: Literal) -> Literal:
    """The literal with its edge in the middle between the nearest rows."""
    col = F.col(lit.name)
    low, high = rows.agg(F.max(F.when(col <= lit.edge, col)).alias("a"), F.min(F.when(col > lit.edge, col)).alias("b")).first()
    return lit if low is None or high is None else Literal(lit.name, (low + high) / 2, lit.above)


def _count(rows: DataFrame, conds: list[Column]) -> list[tuple[int, int]]:
    """(rejected, kept) labels among the rows under each condition."""
    aggs = [F.coalesce(F.sum(F.when(c, v)), F.lit(0)) for c in conds for v in (1 - F.col("y"), F.col("y"))]
    got = rows.agg(*[a.alias(f"c{i}") for i, a in enumerate(aggs)]).first()
    return [(got[2 * i], got[2 * i + 1]) for i in range(len(conds))]


def learn(rows: DataFrame, max_rules: int = MAX_RULES) -> DecisionList:
    """Rules from rows (doc_id, y, one column per measure), y = 0 to reject.

    Ties go to the earlier measure and lower edge, so reruns agree.  Without
    rows of both labels the list is empty.
    """
    names = list(MEASURES)
    rows = store(rows.select("y", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0).alias("grow"), *names)
                 .repartition(4), "rule-rows")
    cuts = [i / BINS for i in range(1, BINS)]
    found = rows.stat.approxQuantile(names, cuts, 1 / (4 * BINS)) if rows.head(1) else [[] for _ in names]
    edges = {n: sorted(set(q)) for n, q in zip(names, found, strict=True)}
    rules: list[tuple[Literal, ...]] = []
    left = rows
    while len(rules) < max_rules:
        grow, held = left.where("grow"), left.where("not grow")
        rule: list[Literal] = []
        covered = grow
        while len(rule) < MAX_LITERALS:
            lit, _ = _best_literal(covered, names, edges)
            if lit is None:
                break
            lit = _centred(covered, lit)
            rule.append(lit)
            covered = covered.where(lit.on(F.col(lit.name)))
            if not _count(covered, [F.lit(True)])[0][1]:
                break
        if not rule:
            break
        # prune: the shortest beginning of the rule that is worth most on the held rows
        heads = [tuple(rule[:k]) for k in range(1, len(rule) + 1)]
        counts = _count(held, [_all(h, F.col) for h in heads])
        worth = [((p - n) / (p + n) if p + n else -1.0) for p, n in counts]
        k = max(range(len(heads)), key=lambda i: (worth[i], -i))
        p, n = counts[k]
        if p < MIN_COVER or p < MIN_PRECISION * (p + n):
            break
        rules.append(heads[k])
        left = left.where(~_all(heads[k], F.col))
    return DecisionList(tuple(rules))


def learn_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS,
                id_col: str = "doc_id", text_col: str = "text") -> DecisionList:
    """Rules from about ``max_rows`` labelled documents (``labelled_sample``) whose
    texts pass the base rules.

    NULL and empty texts fail the base rules and take no part; texts of any
    length are counted whole; repeated rows count once; without labels of both
    kinds, or with an empty table, there is no rule; other columns are not read."""
    rows = labelled_sample(docs, labels, label, max_rows, id_col=id_col, text_col=text_col).select(
        "doc_id", "y", text_stats(F.col("text")).alias("s"))
    rows = store(rows, "rule-stats")  # else the filter moves below the join, to all documents
    rows = rows.where(~base_failed("s"))
    return learn(rows.select("doc_id", "y", *[measure(n, "s").alias(n) for n in MEASURES]))


def apply_rules(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> tuple[DataFrame, str]:
    """The documents with a struct column (its name is the second value):
    the statistics, ``base_failed``, ``rule`` (0: none) and ``kept``.

    NULL and empty texts have no words and fail the base rules; repeated rows
    stay; other columns are kept; an empty table gives an empty one.
    """
    out, tmp = fresh(docs, "rules"), fresh(docs, "stats")
    d = docs.withColumn(tmp, text_stats(text_or_empty(text_col)))
    d = d.withColumn(out, F.struct(F.col(f"{tmp}.*"), base_failed(tmp).alias("base_failed"),
                                   rules.verdict(tmp).alias("rule")))
    return d.withColumn(out, F.col(out).withField("kept", ~F.col(f"{out}.base_failed") & (F.col(f"{out}.rule") == 0))
                        ).drop(tmp), out
