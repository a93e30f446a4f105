import math

import numpy as np
import pytest
from admitlab.llm import ego_join as E
from admitlab.llm import queries, sql
from admitlab.oracle.compare import compare, duck


def brute(rows, t=0.95):
    """(n_links, component) by all pairs, rows (id, vector or None)."""
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    x = [np.array(v, float) / np.sqrt((np.array(v, float) ** 2).sum()) if o else None for (_, v), o in zip(rows, ok)]
    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i + 1, n):
            if ok[i] and ok[j] and len(x[i]) == len(x[j]) and float(x[i] @ x[j]) >= t:
                links[i], links[j] = links[i] + 1, links[j] + 1
                root[find(j)] = find(i)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[find(i)] = min(low.get(find(i), k), k)
    return [(k, links[i], low.get(find(i))) for i, (k, _) in enumerate(rows)]


def clustered(rng, n, d):
    base = rng.normal(size=(6, d))
    return [(base[i % 6] + rng.normal(size=d) * rng.choice([0.02, 0.12, 0.5])).astype(np.float32).tolist() for i in range(n)]


@pytest.mark.parametrize("block,interval", [(4, 16), (512, 8192)])
def test_all_links_found(llm, monkeypatch, block, interval):
    monkeypatch.setattr(E, "BLOCK_ROWS", block)
    rng = np.random.default_rng(block)
    vs = clustered(rng, 220, 12)
    rows = [(i * 7 % 223, v) for i, v in enumerate(vs)] + [(1000 + i, vs[3]) for i in range(30)]
    rows += [(2000, [2.0 * x for x in vs[5]])]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = E.near_vectors(df, interval_rows=interval).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == sorted(brute(rows))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_odd_vectors(llm):
    v = [1.0, 2.0, 3.0]
    nan, inf = float("nan"), float("inf")
    rows = [(9, v), (4, v), (4, v), (None, v), (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (5, [1.0, None, 3.0]),
            (6, [nan, 2.0, 3.0]), (7, [inf, 2.0, 3.0]), (8, [1.0, 2.0]), (10, [-1.0, -2.0, -3.0]),
            (11, [3e38, 3e38, 3e38]), (12, [1e-30, 1e-30, 1e-30]), (None, [5.0, -5.0, 0.0])]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as n", "2 as rep", "3 as width")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in E.near_vectors(df).collect()), key=str)
    assert got == sorted(brute(rows), key=str)
    assert E.near_vectors(df.limit(0)).count() == 0
    assert E.near_vectors(df.where("vec_id in (1, 2)")).count() == 2


def test_every_length_has_its_links(llm):
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(clustered(rng, 40, 12))] + [(100 + i, v) for i, v in enumerate(clustered(rng, 24, 5))]
    rows += [(200, [1.0]), (201, [2.0]), (202, [-1.0]), (203, [1.0, 1.0]), (204, None), (None, [3.0, 0.0, 0.0, 1.0])]
    got = E.near_vectors(llm.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    want = sorted(brute(rows), key=str)
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == want
    assert sum(n for k, n, _ in want if k is not None and k >= 100) > 0


def test_distant_pieces_are_skipped():
    rng = np.random.default_rng(0)
    x = E._unit(np.repeat(np.eye(4), 300, axis=0) + rng.normal(size=(1200, 4)) * 0.01)
    y = x - x.mean(axis=0)
    job = E.SequenceJoin(x, y, np.ones(1200, int), 0.95, math.sqrt(0.1))
    job.join(slice(0, 1200), slice(0, 1200))
    assert job.multiplied < 1200 * 1200 / 2 and job.links.sum() == 1200 * 299
    assert len(set(job.labels())) == 4


def test_query_matches_sql(llm):
    d = "/root/testdata/sf0.001"
    assert compare("op9_ego_join", queries.op9_ego_join(llm, d), duck(d), sql.oracle_sql()["op9_ego_join"]).ok
