import random
import re

from admitlab.llm import queries, sql
from admitlab.llm import url_rules as U
from admitlab.oracle.compare import compare, duck

LOW = str.maketrans(U.UPPER, U.UPPER.lower())


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(LOW), re.match(r"[^?#]*", rest[len(host):]).group()


def brute(url, rules, default="allow"):
    host, path = brute_parts(url)
    fits = [((len(h) + len(p), len(h), v == "block"), h + p, v) for h, p, v in
            ((r[0].translate(LOW), r[1], r[2]) for r in rules if None not in r and r[2] in ("allow", "block"))
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(None, None, default))
    return host, path, best[1], best[2]


def judged(spark, urls, rules, **kw):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    out = U.judge_urls(pages, table, **kw).collect()
    return {r["page_id"]: tuple(r["judged"]) for r in out}, len(out)


ODD = [None, "", "no scheme", "://", "http://", "http:///x", "HTTP://EXAMPLE.ORG/es/a", "http://sub.Example.org/es", "http://org/",
       "http://a.org./x", "http://a..org/x", "a://b://c.org/d", "http://x.org?q=/es/", "http://x.org#/es/", "http://notexample.org/es/",
       "http://É.org/é/Ü", "http://É.ORG/é/Ü", "http://a.org:80/", "http://a\nb.org/\n/x?\n", "http://example.org/en/1?x://y.com/de/",
       "http://" + "a." * 300 + "org/" + "p" * 5000]


def test_odd_urls_equal_brute_force(llm):
    rules = [*queries.URL_RULES, ("", "", "block"), ("É.org", "/é", "block"), ("org", "/", "block"), ("org", "", "allow"),
             (None, "/", "block"), ("org", None, "block"), ("org", "/x", "maybe"), ("org", "/x", None), ("", "/p", "block"),
             ("org", "/" + "p" * 4000, "block"), ("EXAMPLE.org", "/ES/", "allow"), ("org.", "/", "block"), ("a#b", "c", "block")]
    urls = ODD + ODD[5:9]
    for kw in ({}, {"broadcast_rules": 0}, {"default": "block"}):
        got, n = judged(llm, urls, rules, **kw)
        assert n == len(urls)
        want = {i: brute(u, rules, kw.get("default", "allow")) for i, u in enumerate(urls)}
        assert got == want


def test_many_rules_and_a_hot_host(llm):
    rng = random.Random(5)
    labels = ["a", "b", "c", "org", "com"]

    def host():
        return ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))

    def path():
        return "".join("/" + rng.choice("xyz") * rng.randint(0, 2) for _ in range(rng.randint(0, 3)))
    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(400)]
    urls = [f"http://{host()}{path()}" for _ in range(600)] + ["http://a.b.org/x/y"] * 400
    want = {i: brute(u, rules) for i, u in enumerate(urls)}
    for kw in ({}, {"broadcast_rules": 10}):
        assert judged(llm, urls, rules, **kw)[0] == want


def test_short_prefixes_that_collide_are_confirmed(llm, monkeypatch):
    monkeypatch.setattr(U, "SHORT", 1)
    rules = [(f"h{i}.org", "/", "block") for i in range(60)]
    urls = [f"http://h{i}.org/" for i in range(0, 200, 3)]
    assert judged(llm, urls, rules)[0] == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_empty_tables_and_clashing_columns(llm):
    pages = llm.createDataFrame([(1, "http://a.org/x", 5, "h")], "row long, url string, `JUDGED` int, host string")
    rules = llm.createDataFrame([("org", "/", "block")], "host string, path string, verdict string")
    out = U.judge_urls(pages, rules)
    assert out.columns == ["row", "url", "host", "judged"]
    r = out.first()
    assert r["row"] == 1 and r["host"] == "h" and tuple(r["judged"]) == ("a.org", "/x", "org/", "block")
    assert U.judge_urls(pages.limit(0), rules).count() == 0
    assert tuple(U.judge_urls(pages, rules.limit(0)).first()["judged"]) == ("a.org", "/x", None, "allow")


def test_query_equals_sql_and_brute_force(llm):
    d = "/root/testdata/sf0.01"
    r = compare("op12_url_filters", queries.op12_url_filters(llm, d), duck(d), sql.oracle_sql()["op12_url_filters"])
    assert r.ok and r.exact and r.types_ok, r
    urls = {x["page_id"]: x["url"] for x in llm.read.parquet(f"{d}/pages.parquet").select("page_id", "url").collect()}
    rows = queries.op12_url_filters(llm, d).collect()
    assert {x["page_id"]: tuple(x)[1:] for x in rows} == {i: brute(u, queries.URL_RULES) for i, u in urls.items()}
    assert {x["verdict"] for x in rows} == {"allow", "block"}
