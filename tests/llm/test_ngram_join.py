import random

import numpy as np
import pytest

from isobar.llm import ngram_join as nj


def grams(text):
    w = (text or "").encode().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    sets = [grams(t) for _, t in rows]
    n = len(rows)
    links = [0] * n
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    label = {}
    for i in range(n):
        label.setdefault(find(i), []).append(rows[i][0])
    return sorted((rows[i][0], min(label[find(i)]) if sets[i] else rows[i][0], links[i], len(sets[i]))
                  for i in range(n))


def corpus(seed, n):
    r = random.Random(seed)
    words = [f"w{i}é" for i in range(300)]
    rows = []
    for i in range(n):
        if rows and r.random() < 0.6:
            t = r.choice(rows)[1].split(" ")
            for _ in range(r.randint(0, 6)):
                t[r.randrange(len(t))] = r.choice(words)
            t = " ".join(t)
        else:
            t = " ".join(r.choice(words) for _ in range(r.choice([3, 8, 40, 120, 200])))
        rows.append((i * 2, t))
    return rows


def got(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((r["doc_id"], r["class_id"], r["n_links"], r["n_grams"])
                  for r in nj.near_classes(df, **how).collect())


@pytest.mark.parametrize("block", [256, 3])
def test_against_all_pairs(spark, block):
    rows = corpus(4, 150) + [(1001, ""), (1003, None), (1005, " \n"), (1007, "one two"), (1009, "one  two")]
    assert got(spark, rows, block=block) == brute(rows)


def test_large_group_of_near_copies_in_blocks(spark):
    r = random.Random(1)
    base = [f"x{i}" for i in range(100)]
    rows = []
    for i in range(90):
        t = list(base)
        t[r.randrange(100)] = f"y{i}"
        rows.append((i, " ".join(t)))
    assert got(spark, rows, block=16) == brute(rows)


def test_long_text_equals_short_path(monkeypatch):
    texts = [b" ".join(b"w%d" % (i % 97) for i in range(400)), b"a bb  ccc\td\ne f", b"solo"]
    plain = {}
    for rows, g, d in nj.gram_sets(texts):
        for x, y in zip(g.tolist(), d.tolist()):
            plain.setdefault(rows[y], set()).add(x)
    monkeypatch.setattr(nj, "CHUNK", 64)
    small = {}
    for rows, g, d in nj.gram_sets(texts):
        for x, y in zip(g.tolist(), d.tolist()):
            small.setdefault(rows[y], set()).add(x)
    assert plain == small


def test_keep_one(spark):
    rows = corpus(8, 60) + [(500, None), (501, "")]
    df = spark.createDataFrame([(a, b, "s", i) for i, (a, b) in enumerate(rows)],
                               "doc_id long, text string, label string, node int")
    kept = nj.keep_one(df)
    assert kept.columns == df.columns
    want = {c for _, c, _, _ in brute(rows)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_depths_reach_the_recall():
    for threshold, recall in ((0.8, nj.RECALL), (0.8, 0.99), (0.9, nj.RECALL)):
        d = nj.deepest(threshold, recall)
        assert 1 - np.prod([1 - threshold ** k for k in d]) >= recall and max(d) - min(d) <= 1
        i = d.index(min(d))                         # one step less would not do
        assert min(d) == nj.LEVELS or 1 - np.prod([1 - threshold ** (k + (j == i)) for j, k in enumerate(d)]) < recall


def test_prefixes_are_shortened_where_few_classes_meet(spark):
    """Sig values by hand: a pair that shares 2 values, and 30 classes that share 3."""
    width, depths = 4, [4] * nj.TREES
    rows = [(i, [7, 7, 100 + i, i] + [1000 + i] * (4 * nj.TREES - 4)) for i in range(2)]
    rows += [(10 + i, [8, 8, 8, i // 3] + [2000 + i] * (4 * nj.TREES - 4)) for i in range(30)]
    classes = spark.createDataFrame(rows, "node long, sig array<int>")
    groups = {}
    for r in nj.forest_members(classes, depths, spare=8).collect():
        groups.setdefault((r["t"], r["p"]), set()).add(r["node"])
    assert sorted(map(sorted, groups.values())) == [[0, 1]] + [[10 + 3 * i, 11 + 3 * i, 12 + 3 * i] for i in range(10)]
    whole = nj.forest_members(classes, depths, spare=30).select("t", "p").distinct().count()
    assert whole == 2


def test_boilerplate_crowds_the_short_prefixes(spark):
    """Unrelated texts around one long common passage share short prefixes; the links are the same."""
    r = random.Random(5)
    common = [f"licence{i}" for i in range(120)]
    rows = []
    for i in range(120):
        own = [f"o{i}x{j}" for j in range(r.randint(40, 80))]
        rows.append((i, " ".join(common + own)))
        if i % 3 == 0:
            t = common + own
            t[r.randrange(len(t))] = "changed"
            rows.append((1000 + i, " ".join(t)))
    assert got(spark, rows) == brute(rows)


def test_blocks_by_bytes(spark):
    rows = corpus(6, 60)
    assert got(spark, rows, block_bytes=4096) == brute(rows)


def test_very_long_texts_repeated_rows_and_clashing_columns(spark):
    long = [f"v{i}" for i in range(100_000)]
    near = long[:50_000] + ["other"] * 7 + long[50_000:]
    rows = [(1, " ".join(long)), (2, " ".join(near)), (2, " ".join(near)), (3, " ".join(long[:100])), (None, " ".join(long[:100]))]
    df = spark.createDataFrame([(a, b, 1, "k", [2], 3) for a, b in rows],
                               "doc_id long, text string, node int, p string, sig array<int>, dh long")
    out = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in nj.near_classes(df).collect()), key=str)
    assert out == sorted([(1, 1, 2), (2, 1, 2), (2, 1, 2), (3, 3, 1), (None, 3, 1)], key=str)


def test_links_at_the_threshold_are_found(spark):
    """200 pairs of which each shares exactly 0.8 of its grams."""
    rows = []
    for i in range(200):
        t = [f"p{i}w{j}" for j in range(40)]        # 36 grams; 32 of both, 4 of each
        rows += [(2 * i, " ".join(t)), (2 * i + 1, " ".join(t[:-4] + [f"q{i}w{j}" for j in range(4)]))]
    assert all(len(grams(a[1]) & grams(b[1])) == 0.8 * len(grams(a[1]) | grams(b[1])) for a, b in zip(rows[::2], rows[1::2]))
    assert got(spark, rows) == brute(rows)
