"""Quality ranking, toxicity and rule lists."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from admitlab.llm import logistic as L
from admitlab.llm import pair_rank as P
from admitlab.llm import rule_lists as R
from admitlab.llm import toxicity as X
from admitlab.llm.labelled import labelled_sample
from admitlab.llm.queries import op5_toxicity, op7_rules, op8_quality

MID = "/root/testdata/sf0.01"


def held(i, mod, rest):
    return zlib.crc32(str(i).encode()) % mod == rest


def sentence(rng, n=80):
    return " ".join(rng.choice("alder birch cedar elm fir hazel larch maple oak pine rowan yew".split())
                    + rng.choice(["", "", ","]) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def corpus(llm):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(600):
        t = sentence(rng, rng.randrange(60, 160))
        bad, toxic = i % 5 == 0, i % 7 == 0
        if bad:
            t = " ".join(w + rng.choice(["%%%", "&&&"]) for w in t.split()) if i % 2 else t.upper().replace(" ", "!! ")
        if toxic:
            t += " " + rng.choice(["you grubbit", "grubbitish fool", "snollig!"])
        docs.append((i, t))
        labels.append((i, int(not bad), int(toxic)))
    from pyspark.sql import functions as F
    d = llm.createDataFrame(docs, "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))
    lab = labels + [(3, None, None), (None, 1, 0), (10, 0, 0), (10, 0, 0), (99999, 1, 1)]
    return d, llm.createDataFrame(lab, "doc_id long, quality int, toxic int")


def test_logistic_matches_gradient_zero_and_cuts():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 4))
    y = (x @ [1.0, -2.0, 0.5, 0.0] + rng.logistic(size=400) > 0).astype(float)
    b = L.fit(x, y, l2=0.5)
    assert np.abs(x.T @ (L.sigmoid(x @ b) - y) + 0.5 * b).max() < 1e-3
    s = np.array([0.0, 0.1, 0.2, 0.9, 1.0, 1.1])
    assert 0.2 < L.widest_gap(s, 0.5, 0.2) < 0.9
    assert 0.2 < L.best_f1_cut(s, np.array([0, 0, 0, 1, 1, 1])) < 0.9
    assert L.best_f1_cut(s, np.zeros(6)) > 1.1 and L.best_f1_cut(s, np.ones(6)) < 0
    assert L.widest_gap(np.array([]), 0.5) == 0.0 and L.best_f1_cut(np.array([]), np.array([])) == 0.0


def test_sample_leaves_out_held_rows(corpus):
    got = labelled_sample(*corpus, "quality", 10_000, 5, 0).collect()
    ids = [r["doc_id"] for r in got]
    assert set(ids) == {i for i in range(600) if not held(i, 5, 0)} and len(ids) == len(set(ids))
    few = labelled_sample(*corpus, "quality", 50, 5, 0).count()
    assert 10 < few <= 100


def test_pairs_cover_all_rows():
    y = np.array([1] * 9 + [0] * 4)
    g, b = P.pairs(y)
    assert set(g) == set(range(9)) and set(b) == set(range(9, 13)) and len(set(zip(g, b))) == len(g) == 36
    assert len(P.pairs(np.ones(3))[0]) == 0


def test_features_of_odd_texts():
    for t in ["", " \n ", "a", "x" * 100_000, "\n\n", "é" * 50, "| | |", "A! " * 2000]:
        f = P.features(t)
        assert len(f) == len(P.FEATURES) and np.isfinite(f).all()


@pytest.mark.parametrize("which", ["quality", "toxic"])
def test_held_out_accuracy(corpus, which):
    docs, labels = corpus
    if which == "quality":
        model, mod, rest = P.fit_quality(docs, labels), 5, 0
        out = docs.withColumn("s", P.quality_score(model))
        truth = lambda i: i % 5 != 0
    else:
        model, mod, rest = X.fit_toxicity(docs, labels), 4, 2
        out = docs.withColumn("s", X.toxic_score(model))
        truth = lambda i: i % 7 == 0
    rows = [r for r in out.collect() if held(r["doc_id"], mod, rest)]
    right = [(r["s"] >= 0.3) == truth(r["doc_id"]) for r in rows]
    assert len(rows) > 60 and np.mean(right) > 0.97


def test_scores_of_edge_tables(corpus, make_docs, llm):
    _, labels = corpus
    odd = make_docs([(None, None), (1, ""), (1, ""), (2, "word " * 30_000), (3, "\u0000 🙂")])
    none = labels.limit(0)
    for fit, score in ((P.fit_quality, P.quality_score), (X.fit_toxicity, X.toxic_score)):
        for lab in (none, labels.where("quality = 1 and toxic = 0"), labels):
            got = [r[0] for r in odd.select(score(fit(corpus[0], lab)).alias("text")).collect()]
            assert len(got) == 5 and all(0 <= s <= 1 for s in got) and got[1] == got[2]
        assert odd.limit(0).select(score(fit(odd.limit(0), none))).count() == 0


def test_label_model_finds_accuracies_and_ties():
    rng = np.random.default_rng(1)
    y = (rng.random(4000) < 0.2).astype(int)
    fires = lambda: rng.random(4000) < np.where(y == 1, 0.8, 0.002)
    good, weak = [fires() for _ in range(4)], rng.random(4000) < np.where(y == 1, 0.3, 0.2)
    votes = np.column_stack([good[0], *good, weak]).astype(float)  # the first two are one voter twice
    m, post = X.fit_label_model(votes, 5)
    assert np.abs(m.rate1[:5] - 0.8).max() < 0.08 and m.rate0[:5].max() < 0.05 and abs(m.rate1[5] - 0.3) < 0.05
    assert m.share[:2].max() < 0.6 and m.share[2:].min() > 0.8
    assert ((post > 0.5) == y).mean() > 0.98


def brute_em(votes, n_terms, rounds):
    """The label model row by row and voter by voter."""
    distinct = sorted({tuple(c) for c in zip(*[r[:n_terms] for r in votes])})
    post = [X.AGREEMENT[min(int(sum(c[i] for c in distinct)), 3)] for i in range(len(votes))]
    rows, n, v = votes, len(votes), len(votes[0])
    for _ in range(rounds):
        w1 = sum(post)
        odds = (n - w1) / max(w1, 1)
        r1 = [(sum(p * r[j] for p, r in zip(post, rows)) + X.ADDED_VOTES) / (w1 + 2 * X.ADDED_VOTES) for j in range(v)]
        r0 = [(sum((1 - p) * r[j] for p, r in zip(post, rows)) + X.ADDED_VOTES * odds) / (n - w1 + 2 * X.ADDED_VOTES * odds)
              for j in range(v)]
        r1, r0 = ([min(max(x, 1e-6), 1 - 1e-6) for x in r] for r in (r1, r0))
        sides = [[r for p, r in zip(post, rows) if (p > 0.5) == s] for s in (True, False)]
        share = []
        for j in range(v):
            total = 0.0
            for k in range(v):
                best = 0.0
                for side in sides:
                    if side:
                        a, b = ([r[x] - sum(q[x] for q in side) / len(side) for r in side] for x in (j, k))
                        va, vb = (max(sum(x * x for x in c) / len(side), 1e-9) for c in (a, b))
                        best = max(best, sum(x * y for x, y in zip(a, b)) / len(side) / (va * vb) ** 0.5)
                total += 1.0 if j == k else (min(best, 1.0) if best > X.TIED else 0.0)
            share.append(1 / total)
        prior = min(max(w1 / n, 1e-4), 1 - 1e-4)
        post = [1 / (1 + np.exp(-(np.log(prior / (1 - prior)) + sum(
            r[j] * np.log(r1[j] / r0[j]) * share[j] for j in range(v))))) if any(r[:n_terms]) else X.AGREEMENT[0] for r in rows]
    return post


@pytest.mark.parametrize("rounds", [1, 2, 6])
def test_label_model_equals_brute_force(rounds):
    rng = np.random.default_rng(rounds)
    y = rng.random(60) < 0.3
    votes = np.column_stack([rng.random(60) < np.where(y, 0.7, 0.05) for _ in range(4)] + [rng.random(60) < 0.2]).astype(float)
    votes[:, 1] = votes[:, 0]
    _, post = X.fit_label_model(votes, 4, rounds)
    assert post == pytest.approx(brute_em(votes.tolist(), 4, rounds), abs=2e-4)


def test_labels_have_no_part_in_the_posteriors():
    """Other labels on the same votes change the cut only."""
    rng = np.random.default_rng(3)
    votes = (rng.random((200, 3 + len(X.PATTERNS))) < 0.2).astype(float)
    votes = np.hstack([votes, votes[:, :1]])
    y = (votes[:, 0] + votes[:, 1] > 0).astype(int)
    a, b = X.train(["x", "y", "z"], votes, y), X.train(["x", "y", "z"], votes, np.roll(y, 3))
    assert np.array_equal(a.beta, b.beta)


def test_ranking_is_the_optimum_of_the_pairs():
    """Gradient of the Bradley-Terry loss over all (good, bad) pairs, pair by pair."""
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(60, len(P.FEATURES))), (rng.random(60) < 0.6).astype(int)
    x[:, 0] += 2 * y
    m = P.train(x, y, l2=1.0)
    f = [[float(v) for v in row] for row in m.basis(x)]
    good, bad = [i for i in range(60) if y[i]], [i for i in range(60) if not y[i]]
    g, b = P.pairs(y)
    assert set(zip(g.tolist(), b.tolist())) <= {(i, j) for i in good for j in bad}
    grad = [float(w) for w in m.beta]
    for i, j in zip(g.tolist(), b.tolist()):
        d = [p - q for p, q in zip(f[i], f[j])]
        lose = 1 / (1 + np.exp(sum(w * v for w, v in zip(m.beta, d))))
        grad = [t - lose * v for t, v in zip(grad, d)]
    assert max(map(abs, grad)) < 0.05
    below = sum(sum(w * v for w, v in zip(m.beta, row)) < m.cut for row in f)
    assert abs(below / 60 - len(bad) / 60) <= 0.02 + 1 / 60


def test_one_row_per_labelled_id(llm, corpus):
    """An id that holds most rows is one row of the sample, the text of least hash."""
    docs, labels = corpus
    hot = docs.where("doc_id = 2").crossJoin(llm.range(400)).drop("id")
    other = docs.where("doc_id = 3").withColumn("doc_id", docs.doc_id * 0 + 2)
    more = docs.unionByName(hot).unionByName(other)
    got = labelled_sample(more, labels, "quality", 10_000).collect()
    assert len(got) == len({r["doc_id"] for r in got}) == 600
    a, b = docs.where("doc_id = 2").first()["text"], docs.where("doc_id = 3").first()["text"]
    assert next(r["text"] for r in got if r["doc_id"] == 2) in (a, b)
    clashing = more.withColumnRenamed("lang", "y").withColumnRenamed("source", "d")
    assert labelled_sample(clashing, labels, "quality", 10_000).count() == 600
    same = P.fit_quality(docs.unionByName(hot), labels)
    assert np.array_equal(same.beta, P.fit_quality(docs, labels).beta)


def test_words_and_disguise():
    assert {"idiot", "you"} <= X.words_of("You 1d10t!") and "clown" in X.words_of("(CL0WN)")
    assert X.words_of("") == set() and "b" in X.words_of("a-b")
    assert "lowei*" in X.candidates({"loweischaft"}) and "loweischaft" in X.candidates({"loweischaft"})


def brute_stats(t):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
    c = collections.Counter(zip(w, w[1:], w[2:]))
    cov = {j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum((t or "").count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(cov))


def test_rule_stats_equal_brute_force(make_docs):
    rng = random.Random(3)
    texts = [None, "", " ", "a", "a b", "a b c", "a b c a b c", "x x x x x", "x x", "\n\n a\na\n a\n", "p | q <b> $$ é",
             "a b c d\x0ba b c\td", "a\xa0b", "🙂 🙂 🙂 🙂", "one two three " * 4000]
    texts += [" ".join(rng.choice("ab") for _ in range(n)) for n in range(3, 40)]
    texts += ["".join(rng.choice("ab \n#") for _ in range(60)) for _ in range(30)]
    docs = make_docs(list(enumerate(texts))).withColumnRenamed("lang", "rules").withColumnRenamed("source", "stats")
    out, r = R.apply_rules(docs, R.DecisionList(()))
    for x in out.select("text", f"{r}.*").collect():
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["l"]["dup"], x["n_repeat_words"]) == brute_stats(x["text"])
        n, rep = x["n_words"], x["n_repeat_words"]
        assert x["base_failed"] == (n < 50 or 100 * rep > 50 * n) and x["kept"] == (not x["base_failed"])
    assert R.apply_rules(docs.limit(0), R.DecisionList(()))[0].count() == 0


def test_rules_are_learned_and_native(corpus, capsys):
    docs, labels = corpus
    rules = R.learn_rules(docs, labels)
    assert 1 <= len(rules.rules) <= R.MAX_RULES and "reject if" in str(rules)
    out, r = R.apply_rules(docs, rules)
    wrong = [x["doc_id"] for x in out.select("doc_id", f"{r}.kept", f"{r}.base_failed").collect()
             if not x["base_failed"] and x["kept"] != (x["doc_id"] % 5 != 0)]
    assert len(wrong) <= 6
    out.explain()
    assert "Python" not in capsys.readouterr().out
    assert R.learn_rules(docs, labels.limit(0)).rules == () and R.learn_rules(docs, labels.where("quality = 1")).rules == ()


def test_queries_on_whole_tables(llm):
    texts = {r["doc_id"]: r["text"] for r in llm.read.parquet(f"{MID}/documents.parquet").collect()}
    for q, mod, rest in ((op5_toxicity, 4, 2), (op8_quality, 5, 0)):
        got = q(llm, MID).collect()
        assert {r["doc_id"] for r in got} == set(texts) and len(got) == len(texts)
        for r in got:
            assert r["held_out"] == held(r["doc_id"], mod, rest) and r["predicted"] == int(r["score"] >= 0.3)
    got = op7_rules(llm, MID).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_stats(texts[r["doc_id"]])
