import random

import xxhash
from admitlab.llm import simhash as S
from admitlab.llm.components import connected_components
from admitlab.llm.queries import op3_simhash


def brute_fp(text):
    b = (text or "").encode().lower().split()
    sh = [b" ".join(b[i:i + 3]) for i in range(len(b) - 2)] if len(b) >= 3 else ([b" ".join(b)] if b else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) > len(hs))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def test_fingerprint(monkeypatch):
    monkeypatch.setattr(S, "HASHES_AT_ONCE", 7)
    rng = random.Random(2)
    for t in ["", None, "A", "a b", "A b C", "é É ß", "x y z w"] + [
            " ".join(rng.choice("abcdef") for _ in range(n)) for n in (3, 4, 40, 200)]:
        assert S.fingerprint(t or "") % (1 << 64) == brute_fp(t)


def test_links_cold_and_hot_equal_brute_force(llm):
    rng = random.Random(4)
    fps = set()
    for _ in range(12):
        c = rng.getrandbits(64)
        for _ in range(30):
            x = c
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps |= {0, (1 << 64) - 1, 1 << 63}
    node = dict(enumerate(sorted(fps)))
    df = llm.createDataFrame([(n, f - (1 << 64) if f >> 63 else f) for n, f in node.items()], "node long, fp long")
    for bits in (0, 1, 2):
        want = groups(node, lambda a, b, k=bits: (node[a] ^ node[b]).bit_count() <= k)
        for hot in (1, 3, 256):
            got = {r["node"]: r["component"] for r in connected_components(S.links(df, bits, hot)).collect()}
            assert {n: got.get(n, n) for n in node} == want, (bits, hot)


def test_components_long_chain_and_hub(llm):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (None, 3), (1300, 2)]
    got = {r["node"]: r["component"] for r in connected_components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got[200] == 0 and got[1299] == 1000 and got[1300] == 0 and got[2] == 0 and None not in got
    assert connected_components(llm.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_edges(make_docs):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(9, base), (4, base), (4, base), (30, base + " tail"), (1, None), (2, ""), (None, base), (None, "alone one two"),
            (None, "alone one two"), (50, "other text here again")]
    docs = make_docs(rows).withColumnRenamed("lang", "fp").withColumnRenamed("source", "component_id")
    got = S.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    comp = {(r["doc_id"], r["fp"]): r["component_id"] for r in got}
    fps = {i: brute_fp(t) for i, t in rows if i is not None}
    want = groups(fps, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    assert all(comp[k] == want[k[0]] for k in comp if k[0] is not None)
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [(r["doc_id"], (r["text"] or "")[:5]) for r in kept.collect()]
    assert sorted(i for i, _ in ids if i is not None) == sorted(set(want.values()))
    assert [t for i, t in ids if i is None] == ["alone"]
    assert S.near_duplicates(docs.limit(0)).count() == 0 and S.drop_near_duplicates(docs.limit(0)).count() == 0


def test_rows_without_ids_link_and_texts_of_one_id_stay_apart(llm, make_docs):
    far = (1 << 40) - 1
    rows = [(5, 1, 0), (None, 2, 0b11), (8, 3, 0b1111), (None, 4, far), (None, 5, far ^ 1), (9, 7, far << 20), (9, 6, far << 20)]
    got = S.grouped(llm.createDataFrame(rows, "doc_id long, mark long, fp long"), 2)
    assert {r["mark"]: r["component_id"] for r in got.collect()} == {1: 5, 2: 5, 3: 5, 4: None, 5: None, 6: 9, 7: 9}
    assert sorted((r["doc_id"] or 0, r["mark"]) for r in S.kept_rows(got).collect()) == [(0, 4), (5, 1), (9, 6)]
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    out = S.drop_near_duplicates(make_docs([(3, a), (3, b), (3, b), (4, a)])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out) == [(3, a), (3, b)]


def test_query_on_whole_table(llm):
    d = "/root/testdata/sf0.001"
    fps = {r["doc_id"]: brute_fp(r["text"]) for r in llm.read.parquet(f"{d}/documents.parquet").collect()}
    want = groups(fps, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op3_simhash(llm, d).collect()}
    assert got == {i: (f"{f:016x}", want[i]) for i, f in fps.items()}
