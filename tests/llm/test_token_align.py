import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from admitlab.llm import queries
from admitlab.llm import token_align as T
from admitlab.llm.common import file_bytes

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["a b", " lead", "tail ", "two  spaces", "tab\tand\nline\r\n", "<|endoftext|> <s> </s> <unk> <0x41>", "\x00\x1f control",
       "ünïcode ﬁ Ω漢字 🙂 é", "▁mark", "a▁ b", " hard　wide ", "12345 6,789.01", "don't we'll", " ", "   ", "\n",
       "x" * 3000, "a\x1cb c\x1d d"]


@pytest.fixture(scope="module")
def pair():
    return T.Pair(file_bytes(A), file_bytes(B))


def brute_tokens(pair, text):
    """Ids of the libraries and byte ranges, whole text at once; None if not given back."""
    a = pair.a.encode(" " + text, add_special_tokens=False).ids if text else []
    b = pair.b.encode(text) if text else []
    from tokenizers.decoders import ByteLevel
    out = []
    for ids, name in ((a, "a"), (b, "b")):
        at, spans, whole = 0, [], b""
        for i in ids:
            if name == "a":
                raw = pair.bytes_a[i]
            else:
                piece = pair.b.id_to_piece(i)
                raw = bytes([int(piece[3:5], 16)]) if pair.b.is_byte(i) else piece.replace("▁", " ").encode()
            whole += raw
            spans.append((at, at + len(raw), i))
            at += len(raw)
        out.append((spans, whole))
    assert ByteLevel().decode([pair.a.id_to_token(i) for i in a]).encode() == out[0][1] or "�" in text or not text
    want = (" " + text).encode()
    return [s for s, _ in out] if text and all(w == want for _, w in out) else None


def brute(pair, rows):
    """One result per row, by comparing the byte ranges of all tokens."""
    found = [brute_tokens(pair, t or "") for _, t in rows]
    held = Counter()
    links = []
    for tokens in found:
        mine = []
        if tokens:
            k = 0
            for s, e, i in tokens[0]:
                while k and tokens[1][k - 1][1] > s:
                    k -= 1
                while tokens[1][k][1] <= s:
                    k += 1
                j = k
                while j < len(tokens[1]) and tokens[1][j][0] < e:
                    mine.append((i, tokens[1][j][2]))
                    j += 1
        links.append(mine)
        held.update(set(mine))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for (i, _), tokens, mine in zip(rows, found, links):
        if not tokens:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        common = sorted({e for _, e, _ in tokens[0]} & {e for _, e, _ in tokens[1]})
        groups = ";".join("|".join(",".join(str(x) for s, e, x in side if lo < e <= hi) for side in tokens)
                          for lo, hi in zip([0, *common], common))
        out.append((i, len(tokens[0]), len(tokens[1]), len(common), len(mine), sum(held[p] == most[p[0]] for p in mine),
                    sum(held[p] for p in mine), hashlib.sha256(groups.encode()).hexdigest()))
    return out


def prose(rng, n):
    words = ["the", "Lorem", "ipsum", "don't", "naïve", "12,5", "xqzt" * 3, "日本語", "e-mail:", "a", "internationalisation", "🙂🙂"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\n", ", ", " \t"]) for _ in range(n))


def test_gallop():
    rng = np.random.default_rng(1)
    for n, m in ((1, 1), (3, 50), (40, 41), (200, 1000)):
        long = np.unique(np.append(rng.integers(0, 5 * m, m), 5 * m))
        short = np.unique(np.append(rng.integers(0, 5 * m, n), 5 * m))
        for guess in (np.zeros(len(short), int), np.full(len(short), len(long) - 1), rng.integers(0, len(long), len(short))):
            assert T.gallop(short, long, guess).tolist() == np.searchsorted(long, short).tolist()


def test_parts_give_the_ids_of_the_whole_text(pair, monkeypatch):
    rng = random.Random(4)
    assert pair.cuts
    for size in (1, 5, 60):
        for text in [*ODD, prose(rng, 200)]:
            parts = list(T.text_parts(text, size))
            assert " ".join(parts) == text
            if "▁" not in text:
                assert [i for p in parts for i in pair.a.encode(" " + p, add_special_tokens=False).ids] == \
                    pair.a.encode(" " + text, add_special_tokens=False).ids
                assert [i for p in parts for i in pair.b.encode(p)] == pair.b.encode(text)
    assert len(list(T.text_parts(prose(rng, 500), 100))) > 5


@pytest.mark.parametrize("sizes", [(1 << 16, 1 << 17, 2000), (20, 50, 3), (1, 1, 1)])
def test_rows_equal_brute_force(pair, monkeypatch, sizes):
    for name, size in zip(("PART_CHARS", "CHUNK_CHARS", "DOCS_AT_ONCE"), sizes):
        monkeypatch.setattr(T, name, size)
    rng = random.Random(9)
    rows = list(enumerate(["", *ODD, *(prose(rng, rng.randint(1, 120)) for _ in range(25)), "", ODD[0]]))
    got = list(T.aligned_rows(pair, iter(rows)))
    want = brute(pair, rows)
    assert [(r[0], *r[1:5], r[5]) for r in got] == [(w[0], *w[1:5], w[7]) for w in want]


def test_memo_drops_its_older_half(monkeypatch):
    for name, size in (("MEMO_BYTES", 2000), ("WORDS_AT_ONCE", 3), ("CHUNK_CHARS", 40)):
        monkeypatch.setattr(T, name, size)
    own = T.Pair(file_bytes(A), file_bytes(B))
    rng = random.Random(12)
    rows = list(enumerate([*ODD, *(prose(rng, 40) + str(i) for i in range(40)), *ODD]))
    got = list(T.aligned_rows(own, iter(rows)))
    want = brute(own, rows)
    assert [(r[0], *r[1:5], r[5]) for r in got] == [(w[0], *w[1:5], w[7]) for w in want]
    assert len(own.memo) < 120


@pytest.mark.parametrize("frequent", [1 << 20, 40, 0])
def test_counts_over_the_corpus(llm, make_docs, pair, frequent):
    rng = random.Random(2)
    rows = [(k, prose(rng, rng.randint(1, 60))) for k in range(40)] + [(100 + k, t) for k, t in enumerate(ODD)]
    rows += [(7, "the same row"), (7, "the same row"), (None, None), (None, "no id"), (8, "")]
    docs = make_docs(rows).withColumnRenamed("lang", "key").withColumnRenamed("source", "row").withColumnRenamed("n_chars", "pairs")
    got = [tuple(r) for r in T.align_tokens(docs.repartition(5), A, B, frequent=frequent).collect()]
    assert sorted(got, key=repr) == sorted(brute(pair, rows), key=repr)


def test_counting_hands_on_full_tables(llm, make_docs, pair, monkeypatch):
    monkeypatch.setattr(T, "HELD_PAIRS", 10)
    out = T.align_documents(make_docs([(1, "one two three four"), (2, "one two three five"), (3, "one")]), A, B)
    n = {r["key"]: (r["n"], r["top"]) for r in T.pair_counts(out, pair.b.get_piece_size()).collect()}
    assert max(v[0] for v in n.values()) == 3 and all(v[1] for v in n.values())


def test_long_text_and_empty_table(make_docs, pair):
    rng = random.Random(6)
    rows = [(1, prose(rng, 60_000)), (2, "y" * 200_000)]
    got = sorted(tuple(r) for r in T.align_tokens(make_docs(rows), A, B).collect())
    for g, (i, t) in zip(got, rows):
        assert g[:3] == (i, len(pair.a.encode(" " + t, add_special_tokens=False).ids), len(pair.b.encode(t)))
        assert g[3] > 0 and g[4] == g[1] + g[2] - g[3]
    empty = T.align_tokens(make_docs(rows).limit(0), A, B)
    assert empty.count() == 0 and empty.columns[-1] == "groups_sha256"


def test_query_on_whole_tables(llm, pair):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in llm.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in queries.op11_token_align(llm, d).collect()) == sorted(brute(pair, rows))
