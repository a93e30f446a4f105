import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from admitlab.llm import queries
from admitlab.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows):
    found = Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 5:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 3}


def brute(rows):
    """By the words that share a text with one position left out or masked."""
    words = brute_words(rows)
    masked, cut = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            masked[w[:k], w[k + 1:]].add(w)
            cut[w[:k] + w[k + 1:]].add(w)
    out = {}
    for w, n in words.items():
        near = set().union(*(masked[w[:k], w[k + 1:]] for k in range(len(w)))) - {w}
        near |= cut.get(w, set()) | {w[:k] + w[k + 1:] for k in range(len(w)) if w[:k] + w[k + 1:] in words}
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = [form, None, n, len(near), words[form] if form else None]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def rows_of(df):
    got = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: r[1:] for r in got}


def vocabulary(rng, n, letters, longest):
    """Words with many near words, and how often each is written."""
    out = {}
    while len(out) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(4, longest)))
        for _ in range(4):
            out[w] = rng.choice([1, 2, 3, 3, 6, 12, 25])
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]])
    return out


def test_deletions_and_runs():
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["Spelling", "ÀÉÎÕÜ", "naïveté", "o'clock", "x1y2zebra", "ß×÷ÿabc", "Ünïcödé漢字words", "abcd"])
                         for _ in range(50))) for i in range(60)]
    found = Counter()
    for i, t in rows:
        found.update(S.document_words(str(i), t))
    assert {w.decode("latin-1"): n for w, n in found.items() if n >= 3} == brute_words(rows)
    assert any(len(w) == 7 and w not in b"na\xefvet\xe9" for w in found)


def test_near_pairs_equal_all_pairs(monkeypatch):
    monkeypatch.setattr(S, "BOX", 8)
    rng = random.Random(7)
    words = sorted(w for w in vocabulary(rng, 400, "abcdeé", 9) if len(w) > 4)
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w.encode("latin-1"))

    def apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return any(b[:k] + b[k + 1:] == a for k in range(len(b)))
    made = [0, 0]
    for k in by_length:
        for m in (k, k + 1):
            if m in by_length:
                columns = S.letters_used(by_length[k], by_length[m])
                a, b = (S.Words(by_length[x], np.arange(len(by_length[x])), columns) for x in (k, m))
                for x, y in ((a, b), (a, a)):
                    got = [(x.words[i], y.words[j]) for ii, jj in S.near_pairs(x, y, made) for i, j in zip(ii, jj)]
                    assert len(got) == len(set(got))
                    want = {(v, w) for v in x.words for w in y.words if apart(v, w)}
                    assert set(got) | ({(w, v) for v, w in got} if x is y else set()) == want
                    assert x is not y or len(want) == 2 * len(got)
    assert 0 < made[0] < made[1]


def test_corpus_equals_brute_force(llm, make_docs, monkeypatch):
    rng = random.Random(11)
    words = vocabulary(rng, 500, "abcdefgÉéß", 10)
    stream = [w for w, n in words.items() for _ in range(n)]
    rng.shuffle(stream)
    rows = [(k, " ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in stream[k * 40:k * 40 + 40]))
            for k in range(len(stream) // 40 + 1)]
    want = brute(rows)
    assert any(v[1] not in (w, v[0]) for w, v in want.items())  # chains of several forms
    assert rows_of(S.spelling_variants(make_docs(rows))) == want
    monkeypatch.setattr(S, "TILE_WORDS", 3)  # every cell in many parts
    assert rows_of(S.spelling_variants(make_docs(rows))) == want


def test_long_chain_of_forms(llm):
    forms = [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(70)] + [("hub" + str(i), "w070") for i in range(50)] + [("x", "y")]
    got = dict(S.follow_forms(llm.createDataFrame(forms, "word string, form string")).collect())
    assert got == {w: ("y" if w == "x" else "w070") for w, _ in forms}


def test_odd_documents(make_docs, monkeypatch):
    long = "q" * 100_000
    rows = [(1, None), (2, ""), (None, "alpha alpha alpha alphas"), (3, "alpha alphas alphas"), (3, "alpha alphas alphas"),
            (5, f"{long} {long}a {long} {long}"), (6, f"{long}a {long}a 漢字 abcdÀ ABCDÀ abcdÀ abcdà"), (7, "no\x85no\xa0break tie ")]
    want = brute(rows)
    assert want[long][3] == 1 and want["alpha"][3] == 1
    docs = make_docs(rows).withColumnRenamed("lang", "word").withColumnRenamed("source", "n")
    assert rows_of(S.spelling_variants(docs)) == want
    monkeypatch.setattr(S, "TILE_LETTERS", 10)
    assert rows_of(S.spelling_variants(docs)) == want
    empty = S.spelling_variants(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_query_on_whole_tables(llm):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in llm.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.op13_spelling(llm, d)) == brute(rows)
