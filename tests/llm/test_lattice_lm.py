import collections
import itertools
import math
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from admitlab.llm import lattice_lm as M
from admitlab.llm.common import crc_mod, file_bytes

PIECES = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return M.load_pieces(file_bytes(PIECES))


def paths(word, vocab):
    """Log probability of every segmentation of a string."""
    if not word:
        yield 0.0
    for k in range(1, len(word) + 1):
        if word[:k] in vocab:
            for rest in paths(word[k:], vocab):
                yield vocab[word[:k]] + rest


def test_forward_sums_all_segmentations(pieces):
    surfaces, logp = pieces
    vocab = dict(zip(surfaces, logp, strict=True))
    words = [b" ", b" a", b" the", b" thing", b" na\xc3\xafve", b" \xff\x00", b" zzzzzzz", " 日本".encode()]
    got = M.Lattice(surfaces).forward(words, logp)
    for w, g in zip(words, got, strict=True):
        assert g == pytest.approx(np.logaddexp.reduce(list(paths(w, vocab))), rel=1e-12)


def test_words_sum_to_one():
    """Over all words of a tiny alphabet, probabilities approach one."""
    surfaces = [b" ", b" a", b"a", b"ab", b"b", b" ba"]
    p = np.array([0.3, 0.2, 0.05, 0.1, 0.05, 0.3])
    lat = M.Lattice(surfaces)
    total = 0.0
    for n in range(0, 9):
        words = [b" " + bytes(w) for w in itertools.product(b"ab", repeat=n)]
        total += np.exp(lat.forward(words, np.log(p))).sum()
    assert 0.999 < total <= 1 + 1e-9


def test_expected_counts_are_posteriors(pieces):
    surfaces, logp = pieces
    lat = M.Lattice(surfaces)
    words = [b" other", b" ing", b" x" * 1]
    got = lat.expected(words, logp)
    assert sum(got[i] * len(s) for i, s in enumerate(surfaces)) == pytest.approx(sum(map(len, words)))
    em = np.full(len(logp), 1e-3) + got
    better = lat.forward(words, np.log(em / em.sum()))
    assert better.sum() > lat.forward(words, logp).sum()


def test_windows_give_the_same_counts(pieces, monkeypatch):
    surfaces, logp = pieces
    lat = M.Lattice(surfaces)
    words = [b" internationalisation" * 3, b" a", b" " + bytes(range(97, 123)) * 4]
    want = lat.expected(words, logp)
    for window in (1, 7, 64):
        monkeypatch.setattr(M, "WINDOW", window)
        assert np.allclose(lat.expected(words, logp), want, rtol=1e-12, atol=1e-300)


def test_a_long_word_holds_one_window(pieces, monkeypatch):
    """Memory of the expected counts of one word without white space: 16 bytes a
    byte for the two recursions and one window's arcs, not all arcs."""
    monkeypatch.setattr(M, "WINDOW", 256)
    import tracemalloc
    surfaces, logp = pieces
    lat = M.Lattice(surfaces)
    word = b" " + b"base64textwithoutspaces" * 300  # 6,901 bytes
    tracemalloc.start()
    got = lat.expected([word], logp)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(got[i] * len(s) for i, s in enumerate(surfaces)) == pytest.approx(len(word))
    assert peak < 16 * len(word) + (4 << 20)


def brute_base(rows, is_held):
    words = {k: (t or "").encode().lower().split() + [M.END] for k, (_, t) in enumerate(rows)}
    c = collections.Counter(w for k, ws in words.items() if not is_held(rows[k][0]) for w in ws)
    n, v = sum(c.values()), len(c)
    return {k: (len(ws), sum(c[w] > 0 for w in ws), sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
            for k, ws in words.items()}, n, c


def held(i):
    return zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2


def test_scores_against_brute_force(make_docs, llm, monkeypatch, pieces):
    monkeypatch.setattr(M, "FREQUENT_WORDS", 5)
    monkeypatch.setattr(M, "FLUSH_WORDS", 7)
    texts = ["", None, "The cat the Cat", "a\x0bb c d", "zebra " * 50, "é É the", "the cat sat on the mat and sat",
             "z" * 700, "one two three four five six seven", "cat cat cat unseenword unseenword"]
    rows = [(i, t) for i, t in enumerate(texts * 2)] + [(None, "no id"), (3, "again"), (3, "again")]
    docs = make_docs(rows).withColumnRenamed("lang", "word").withColumnRenamed("source", "row")
    got = M.score_documents(docs, crc_mod("doc_id", 7) == 2, PIECES, rounds=1).collect()
    want, n, c = brute_base(rows, held)
    assert len(got) == len(rows) and {r["train_tokens"] for r in got} == {n}
    key = lambda d, h, a, b, s: (str(d), h, a, b, round(s, 6))
    assert sorted(key(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["base_score"]) for r in got) == sorted(
        key(rows[k][0], held(rows[k][0]), *want[k]) for k in want)
    # the model, by the formula, with the pieces re-estimated in one pass
    surfaces, logp = pieces
    lat = M.Lattice(surfaces)
    seen = sorted(w for w in c if w != M.END)
    em = np.full(len(logp), 0.1)
    for w in seen:
        em += lat.expected([b" " + w], logp)
    logp = np.log(em / em.sum())
    n1, n2 = (sum(x == k for x in c.values()) for k in (1, 2))
    d = min(max(n1 / (n1 + 2 * n2), 0.1), 0.9)

    def p(w):
        first = max(c[w] - d, 0) / n if c[w] else 0.0
        if w == M.END:
            return first
        return first + d * len(c) / n * math.exp(lat.forward([b" " + w], logp)[0])
    scores = collections.defaultdict(list)
    for r in got:
        scores[r["doc_id"]].append(r["score"])
    for k, (i, t) in enumerate(rows):
        ws = (t or "").encode().lower().split() + [M.END]
        total = sum(math.log10((1 - M.COPY) * p(w) + M.COPY * (ws[:j].count(w) if w != M.END else 0) / j if j else p(w))
                    for j, w in enumerate(ws))
        assert any(total == pytest.approx(s, rel=1e-9) for s in scores[i]), (i, t)


def test_edge_tables(make_docs, llm):
    from pyspark.sql import functions as F
    docs = make_docs([(1, "a b"), (2, None)])
    assert M.score_documents(docs.limit(0), F.lit(False), PIECES).count() == 0
    got = M.score_documents(docs, F.lit(True), PIECES).collect()  # nothing to learn from
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 and r["score"] < 0 for r in got)


def test_words_too_unlikely_for_a_double(make_docs, llm):
    from pyspark.sql import functions as F
    odd = "".join(chr(0x10F000 + 37 * k) for k in range(16))  # 64 bytes of no known piece
    docs = make_docs([(k, "the common words of the training text " * 4000) for k in range(4)] + [(9, f"{odd} {odd} the")])
    got = {r["doc_id"]: r["score"] for r in M.score_documents(docs, F.col("doc_id") == 9, PIECES).collect()}
    assert -1500 < got[9] < -300 and all(math.isfinite(x) for x in got.values())


def test_query_on_whole_table(llm):
    from admitlab.llm.queries import op2_lattice_lm
    d = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in llm.read.parquet(f"{d}/documents.parquet").collect()]
    want, n, _ = brute_base(rows, held)
    got = {r["doc_id"]: r for r in op2_lattice_lm(llm, d).collect()}
    for k, (i, _) in enumerate(rows):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["held_out"], r["train_tokens"]) == (*want[k][:2], held(i), n)
        assert r["base_score"] == pytest.approx(want[k][2], rel=1e-9) and r["score"] < 0
    assert len(got) == len(rows)
