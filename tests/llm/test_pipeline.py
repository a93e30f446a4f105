import hashlib
import struct

import corpus_pipeline as C
import public_tokenizers as P
import tiktoken
from admitlab.llm import byte_bpe, mixing, pair_rank, toxicity
from admitlab.llm.common import file_bytes, read
from test_simhash import brute_fp, groups

D = "/root/testdata/sf0.001"


def test_stages_one_by_one(llm):
    docs = read(llm, D, "documents")
    labels = read(llm, D, "labels")
    rows = {r["doc_id"]: r for r in docs.collect()}
    columns = docs.columns

    q = pair_rank.fit_quality(docs, labels)
    good = [i for i, r in rows.items()
            if q.score(pair_rank.np.array([pair_rank.features(r["text"])]), 0.3)[0] >= 0.3]
    out = C.quality(llm, docs, D)
    assert out.columns == columns and sorted(r["doc_id"] for r in out.collect()) == sorted(good)

    t = toxicity.fit_toxicity(docs, labels)
    voters = toxicity.Voters(list(t.lexicon))
    cut = t.cut + 0.0
    clean = [i for i in good if t.raw(voters.votes(rows[i]["text"])[None])[0] < cut]
    out = C.toxic(llm, docs.where(docs.doc_id.isin(good)), D)
    assert out.columns == columns and sorted(r["doc_id"] for r in out.collect()) == sorted(clean)

    fps = {i: brute_fp(rows[i]["text"]) for i in clean}
    kept = set(groups(fps, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2).values())
    some = docs.where(docs.doc_id.isin(clean))
    out = C.near_duplicates(llm, some, D)
    assert out.columns == columns and sorted(r["doc_id"] for r in out.collect()) == sorted(kept)

    some = docs.where(docs.doc_id.isin(list(kept)))
    ranked, plan, r = mixing.mix_plan(some)
    times = {x["doc_id"]: x["n"] for x in mixing.with_copies(ranked, plan, r, "n").collect()}
    out = C.mix(llm, some, D)
    got = [x["doc_id"] for x in out.collect()]
    assert out.columns == columns and {i: got.count(i) for i in kept} == times

    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                            mergeable_ranks=byte_bpe.ByteBPE(file_bytes(P.path("byte_bpe_50k.tiktoken")), P.PATTERN).ids)
    final = C.run(llm, D).collect()
    assert {x["doc_id"]: sum(y["doc_id"] == x["doc_id"] for y in final) for x in final} == {
        i: n for i, n in times.items() if n}
    for x in final:
        want = lib.encode_ordinary(rows[x["doc_id"]]["text"])
        assert bytes(x["token_ids"]) == struct.pack(f"<{len(want)}I", *want) and x["n_tokens"] == len(want)
        assert x["decoded_sha256"] == hashlib.sha256(rows[x["doc_id"]]["text"].encode()).hexdigest()


def test_odd_documents_pass_every_stage(llm, make_docs):
    odd = make_docs([(None, None, None), (1, "", "a"), (1, "", "a"), (2, "x" * 50_000, None), (3, "fine text here", "b")])
    odd = odd.selectExpr("*", "1 as fp", "'k' as unnamed")
    for name, stage in C.STAGES:
        for df in (odd, odd.limit(0)):
            out = stage(llm, df, D)
            assert (name == "tokens") or out.columns == odd.columns
            assert out.count() <= 5 * 3
