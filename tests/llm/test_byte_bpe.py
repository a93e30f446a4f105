import random
import struct

import public_tokenizers as P
import pytest
import tiktoken
from admitlab.llm import byte_bpe as B
from admitlab.llm.common import file_bytes

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def model():
    return B.ByteBPE(file_bytes(RANKS), P.PATTERN)


@pytest.fixture(scope="module")
def library(model):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=model.ids, special_tokens={})


def ids(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


HARD = ["", " ", "  ", "\n", " a", "a ", "a  b", "a \n b", "a\n", "a\n next", "word\n \n  word ", "don't we'll I'M",
        "\x1c a\x1cb", "tab\t tab", "a b 　c", "日本語 テキスト", "naïve café", "🙂🙂 🙂", "x" * 300, "ab" * 900,
        "١٢٣ 12a", "a" * 5000 + " b", "̀a ̀", "<|endoftext|> hi", "x\x00y", "the the\n the"]


def test_texts_match_the_library(model, library):
    for t in HARD:
        assert ids(model.encode([t])[0]) == library.encode_ordinary(t), repr(t[:40])


def test_random_texts_match_whatever_came_before(model, library):
    rng = random.Random(3)
    for _ in range(60):
        group = ["".join(rng.choice(["the", "ing", " ", "  ", "\n", "'s", "é", "9", ".", "zq", "\t", "ß", "Ω"])
                         for _ in range(rng.randrange(60))) for _ in range(4)]
        for t, got in zip(group, model.encode(group), strict=True):
            assert ids(got) == library.encode_ordinary(t), repr(t)
            assert model.decode(got) == t.encode()


def test_blockwise_merging_equals_matrix_merging(model, library, monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("abctheingnr") for _ in range(rng.randrange(2, 400))).encode() for _ in range(80)]
    want = [library.encode_ordinary(w.decode()) for w in words]
    assert [ids(x) for x in model.merge(words)] == want
    monkeypatch.setattr(B, "TALL", 1)
    assert [ids(x) for x in model.merge(words)] == want


def test_pair_table_finds_exactly_its_pairs(model):
    import numpy as np
    t = B.PairTable(np.array([1, 2, 70000]), np.array([2, 1, 70000]), np.array([9, 8, 7]))
    got = t.find(np.array([1, 2, 70000, 1, -1, 5]), np.array([2, 1, 70000, 1, 2, 5]))
    assert got.tolist() == [9, 8, 7, B.NO_RANK, B.NO_RANK, B.NO_RANK]


def test_documents_round_trip_with_clashing_columns(make_docs, library):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(None, None), (3, "twice"), (3, "twice")]
    docs = make_docs(rows).withColumnRenamed("lang", "ids").withColumnRenamed("source", "token_ids")
    out = B.encode_documents(docs, RANKS, P.PATTERN).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["decoded"] == (r["text"] or "")
        assert ids(bytes(r["token_ids"])) == library.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(r["token_ids"]) // 4 and r["ids"] == "en"
    assert B.encode_documents(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_query_on_whole_table(llm, library):
    import hashlib
    from admitlab.llm.queries import op1_byte_bpe
    texts = {r["doc_id"]: r["text"] or "" for r in llm.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = op1_byte_bpe(llm, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    for r in got:
        want = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
