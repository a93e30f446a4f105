import io
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import zstandard
from admitlab.llm import token_files as K
from tokenizers import Tokenizer

VOCAB = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(VOCAB)


HARD = ["", None, " ", "Hello, World! it's", "I'M don't 'tis", "naïve CAFÉ Ünïcode", "éa ́b", "日本語 テキスト",
        "a b　c", "12345 a1b2", "<|endoftext|> x", "ΑΣ ΑΣΑΣ", "\x1cq\x1d r", "x" * 3000, "||| *** $$$", "İstanbul ǅ",
        "ﬁ ½", "tab\tnew\nline  end ", "a <|endoftext|> b", "x<|endoftext|>y<|startoftext|> <|startoftext|>", "<|ENDOFTEXT|> <|endof",
        "don't<|endoftext|>won't", "plain 漢字漢字 plain É Éa aÉ ÿþ÷× \x7fz z\x00", "'", "' '", "ab'", "Don't STOP'S, it'll"]


def test_every_text_like_the_library(lib):
    enc = K.WordEncoder(open(VOCAB, "rb").read())
    for _ in range(2):  # the second time from the memo
        for t in HARD:
            want = lib.encode(t or "", add_special_tokens=False).ids + [2]
            got = np.frombuffer(next(enc.encode([t or ""], (2).to_bytes(4, "little"))), "<u4").tolist()
            assert got == want, repr(t)


def test_memo_forgets_by_halves(lib, monkeypatch):
    monkeypatch.setattr(K, "MEMO_ENTRIES", 6)
    monkeypatch.setattr(K, "CHARS_AT_ONCE", 8)
    monkeypatch.setattr(K, "RUNS_AT_ONCE", 2)
    enc = K.WordEncoder(open(VOCAB, "rb").read())
    texts = [t or "" for t in HARD] * 2 + ["one two three four five six seven eight nine", "one nine two"]
    for t, got in zip(texts, enc.encode(texts, b""), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids
    assert len(enc.memo) < 40 and enc.older


def test_hot_id_goes_to_several_files(llm, make_docs, lib):
    docs = make_docs([(7, "the same row")] * 600 + [(7, f"row {i}") for i in range(300)] + [(1, "first"), (9, "last")])
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = K.write_token_files(docs.repartition(4), VOCAB).cache()
    finally:
        llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [r["n_docs"] for r in manifest.collect()]
    assert sum(files) == 902 and len(files) >= 6 and max(files) < 400
    got = sorted(K.read_token_files(manifest).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [1, *[7] * 900, 9]
    ids = {}
    for r in got[1:-1]:
        ids[bytes(r["ids"])] = ids.get(bytes(r["ids"]), 0) + 1
    want = np.array([*lib.encode("the same row").ids, 2], "<u4").tobytes()
    assert ids[want] == 600 and len(ids) == 301
    again = sorted(K.read_token_files(K.write_token_files(docs.repartition(4), VOCAB)).collect(), key=lambda r: r["start"])
    assert [bytes(r["ids"]) for r in got] == [bytes(r["ids"]) for r in again]


def test_frames_seek_table_and_checksums():
    sink = io.BytesIO()
    w = K.FrameWriter(sink)
    plain = [b"abc" * 100, b"", b"xyz"]
    for p in plain:
        w.add(p)
    w.close()
    data = sink.getvalue()
    r = K.FrameReader(io.BytesIO(data), len(data))
    assert [r.frame(i) for i in (2, 0, 1)] == [plain[2], plain[0], plain[1]]
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as s:
        assert s.read() == b"".join(plain)  # any zstandard reader sees the data alone
    bad = bytearray(data)
    bad[10] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        r = K.FrameReader(io.BytesIO(bytes(bad)), len(bad))
        r.frame(0)


def test_files_round_trip_and_read_only_wanted_frames(make_docs, lib, monkeypatch):
    rows = [(i * 3 - 7, t) for i, t in enumerate(HARD)] + [(5, "same"), (5, "same"), (None, "no id")]
    rows += [(1000 + i, "word " * i) for i in range(60)]
    docs = make_docs(rows).withColumnRenamed("lang", "start").withColumnRenamed("source", "file")
    manifest = K.write_token_files(docs, VOCAB, frame_tokens=64).cache()
    got = sorted(K.read_token_files(manifest).collect(), key=lambda r: r["start"])
    at = 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in got] == [r[0] for r in order]
    for r, (_, text) in zip(got, order, strict=True):
        want = lib.encode(text or "", add_special_tokens=False).ids + [2]
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == want
        assert (r["start"], r["n_tokens"]) == (at, len(want))
        at += len(want)
    some = {r["doc_id"]: (r["start"], r["ids_crc32"])
            for r in K.read_token_files(manifest, wanted={1005, 1059}, digest=True).collect()}
    assert some == {r["doc_id"]: (r["start"], zlib.crc32(bytes(r["ids"]))) for r in got if r["doc_id"] in (1005, 1059)}
    assert K.read_token_files(K.write_token_files(docs.limit(0), VOCAB)).count() == 0


def test_wanted_documents_leave_other_frames_alone():
    sink = io.BytesIO()
    w = K.FrameWriter(sink)
    for i in range(5):
        w.add(np.full(10, i, "<u4").tobytes())
    w.add(np.array([(i, 10, i) for i in range(5)], "<i8").T.tobytes())
    w.close()
    r = K.FrameReader(io.BytesIO(sink.getvalue()), len(sink.getvalue()))
    read = []
    whole = r.frame
    r.frame = lambda k: (read.append(k), whole(k))[1]
    assert [d for d, _, _ in r.documents({3})] == [3] and read == [5, 3]


def test_query_on_whole_table(llm, lib):
    from admitlab.llm.queries import op4_token_files
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"])
           for r in op4_token_files(llm, "/root/testdata/sf0.001").collect()}
    at, want = 0, {}
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        ids = np.array(lib.encode(d["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        want[d["doc_id"]] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert got == want
