import random

import numpy as np
import pytest

from isobar.llm import url_filter as uf
from isobar.llm.queries import URL_RULES


def judge(url, rules):
    url = url or ""
    if "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for v, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[1]):
                best = (v, h + p)
    return host, path, best and best[1], best[0] if best else "allow"


URLS = [None, "", "nothing", "http://", "http://com/", "http://com", "HTTP://WWW.Example.COM/en/x?y#z",
        "http://a.b.example.com/en/", "http://example.com/en", "x://y://example.net/es/1", "http://É.net/fr/É",
        "http://www.example.com/en/1", "http://notexample.com/en/1", "http://net/es/", "http://a..com/", "http://.com/",
        "http://com?/", "http://example.net#/es/", "ftp://u@example.net:80/fr/", "://net/fr/", "http://example.com/en/\n"]


@pytest.mark.parametrize("max_bytes", [uf.MAX_FILTER_BYTES, 1])
def test_contract_rules(spark, max_bytes):
    rows = [(i, u) for i, u in enumerate(URLS * 2)] + [(None, "http://q.com/")]
    df = spark.createDataFrame([(i, u, "k", 1) for i, u in rows], "page_id long, url string, keys string, c0 int")
    got = sorted([tuple(r) for r in uf.url_verdicts(df, URL_RULES, max_bytes=max_bytes).collect()], key=str)
    assert got == sorted([(i, *judge(u, URL_RULES)) for i, u in rows], key=str)


def test_many_rules(spark):
    r = random.Random(3)
    hosts = [f"h{i}.{d}" for i in range(60) for d in ("com", "org")]
    rules = [(r.choice(["allow", "block"]), h, r.choice(["/", "/a/", "/ab"])) for h in r.sample(hosts, 70)]
    urls = [(i, f"http://{r.choice(['', 'www.', 'x.y.'])}{r.choice(hosts)}{r.choice(['', '/', '/a/', '/abc', '/b'])}")
            for i in range(800)]
    df = spark.createDataFrame(urls, "page_id long, url string")
    got = sorted(tuple(x) for x in uf.url_verdicts(df, rules).collect())
    assert got == sorted((i, *judge(u, rules)) for i, u in urls)


def test_cascade_is_exact_on_its_universe(spark):
    r = np.random.default_rng(5)
    k = r.integers(-2**62, 2**62, size=(6000, 2))
    df = spark.createDataFrame([(int(a), int(b)) for a, b in k], "k1 long, k2 long").withColumnRenamed("k1", "k1")
    listed = {tuple(map(int, x)) for x in k[:700]}
    inn = spark.createDataFrame(sorted(listed), "k1 long, k2 long")
    out = df.join(inn, ["k1", "k2"], "left_anti")
    levels = uf.build_cascade(inn, out, len(listed), 6000 - len(listed))
    assert len(levels) > 1
    got = uf.member(levels, k[:, 0].view(np.uint64), k[:, 1].view(np.uint64))
    assert got.tolist() == [tuple(map(int, x)) in listed for x in k]
    bits = sum(x.m for x in levels)
    assert bits < 700 * 40


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert uf.url_verdicts(df, URL_RULES).collect() == []
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [tuple(r) for r in uf.url_verdicts(df, []).collect()] == [(1, "a.com", "/", None, "allow")]


def test_contradictory_and_repeated_rules_end(spark):
    rules = [("allow", "com", "/"), ("block", "com", "/"), ("allow", "a.com", "/x"), ("allow", "a.com", "/x"),
             ("block", "b.com", "/"), ("allow", "b.com", "/"), ("block", "b.com", "/")]
    once = [("block", "com", "/"), ("allow", "a.com", "/x"), ("block", "b.com", "/")]
    urls = [(1, "http://com/"), (2, "http://a.com/xy"), (3, "http://z.b.com/q"), (4, "http://net/")]
    df = spark.createDataFrame(urls, "page_id long, url string")
    assert sorted(tuple(r) for r in uf.url_verdicts(df, rules).collect()) == sorted((i, *judge(u, once)) for i, u in urls)


def test_rules_as_a_table(spark):
    table = spark.createDataFrame([*URL_RULES, ("block", None, "/"), ("allow", "com", None)], "verdict string, host string, path string") \
        .selectExpr("'x' AS key", "path", "host", "verdict")
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(99, "http://example.com/en/" + "x" * 100_000)], "page_id long, url string")
    got = sorted((tuple(r) for r in uf.url_verdicts(df, table).collect()), key=str)
    assert got == sorted((tuple(r) for r in uf.url_verdicts(df, URL_RULES).collect()), key=str)
    with pytest.raises(Exception, match="neither allow nor block: deny"):
        uf.url_verdicts(df, [("deny", "com", "/")])
