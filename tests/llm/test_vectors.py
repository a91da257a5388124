import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import ann, topk_search as ts

SCHEMA = "vec_id long, embedding array<float>, v string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1)
                                  for i, v in rows], SCHEMA)


def clean(rows):
    return [(i, v) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]


def vectors(n, dim=16, seed=0, spread=0.4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, dim))
    m = (centres[r.integers(0, 12, n)] + spread * r.normal(size=(n, dim))).astype(np.float32)
    return [(int(i), [float(x) for x in v]) for i, v in enumerate(m)]


def odd_rows():
    same = [0.5] * 16
    return [(10_000 + i, same) for i in range(60)] + [
        (20_000, None), (20_001, [None] * 16), (20_003, [float("nan")] + same[1:]), (None, same),
        (20_005, [float("inf")] + same[1:]), (20_007, [0.0] * 16), (20_009, same[:5]), (20_009, same[:5])]


def brute_top(rows, mod, k):
    rows = clean(rows)
    ints = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows]
    asked = {}
    for i, v in rows:
        if i % mod == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for i, v in asked.items():
        q = [math.floor(1024 * float(x)) for x in v]
        scores = sorted((-sum(a * b for a, b in zip(q, d)), j) for j, d in ints if j != i)
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("n", [5, 900])
def test_maxscore_against_all_pairs(spark, n):
    rows = vectors(n) + odd_rows()
    got = sorted(tuple(r) for r in ts.top_k(frame(spark, rows), F.col("vec_id") % 100 == 0, 10).collect())
    assert got == brute_top(rows, 100, 10)


def test_maxscore_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ts, "VECTOR_BLOCK", 16)
    monkeypatch.setattr(ts, "QUERY_BLOCK", 3)
    monkeypatch.setattr(ts, "CELL_QUERIES", 6)
    rows = vectors(400, seed=3)
    got = sorted(tuple(r) for r in ts.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, 7).collect())
    assert got == brute_top(rows, 20, 7)


def test_maxscore_skips_documents():
    r = np.random.default_rng(2)
    docs = np.floor(1024 * r.normal(size=(2000, 12)) * np.array([4, 3, 2] + [0.05] * 9))
    ids = np.arange(2000)
    best = ts.Best(np.array([-1]), docs[:1].copy(), 5)
    ts.maxscore(best, ids[:1000], docs[:1000])
    first = best.floor[0]
    ts.maxscore(best, ids[1000:], docs[1000:])
    want = np.lexsort((ids, -(docs @ docs[0])))[:5]
    assert best.found[0][1].tolist() == want.tolist() and best.floor[0] >= first


def check_ann(got, rows, mod, k, floor):
    rows = clean([(i, v) for i, v in rows])
    rows = [(i, v) for i, v in rows if any(v)]
    by = {}
    for i, v in rows:
        by.setdefault(i, v)
    hit = total = 0
    for q in [i for i in by if i % mod == 0]:
        score = {j: sum(float(a) * float(b) for a, b in zip(by[q], v)) for j, v in by.items() if j != q}
        mine = [r for r in got if r["query_id"] == q]
        assert [r["rank"] for r in mine] == list(range(1, min(k, len(score)) + 1))
        assert all(abs(r["score"] - score[r["vec_id"]]) < 1e-9 for r in mine)
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        best = sorted(score.values(), reverse=True)[:k]
        hit += sum(r["score"] >= best[-1] - 1e-9 for r in mine)
        total += len(best)
    assert total == 0 or hit / total >= floor


@pytest.mark.parametrize("n,floor", [(6, 1.0), (1500, 0.9)])
def test_ann_recall(spark, n, floor):
    rows = vectors(n, seed=4) + (odd_rows() if n > 10 else [])
    got = ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect()
    check_ann(got, rows, 20, 20, floor)


def test_ann_unequal_norms(spark):
    # components that the table's float type holds exactly
    rows = [(i, [float(np.float32(x * (1 + i % 7))) for x in v]) for i, v in vectors(800, seed=6)]
    got = ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect()
    check_ann(got, rows, 20, 20, 0.9)


def test_ann_hot_bucket_in_slices(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_VECTORS", 16)
    monkeypatch.setattr(ann, "CELL_QUERIES", 4)
    rows = vectors(300, seed=8) + [(1000 + i, [1.0] * 16) for i in range(200)]
    got = ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect()
    check_ann(got, rows, 20, 20, 0.9)


def test_empty(spark):
    df = frame(spark, [])
    assert ts.top_k(df, F.col("vec_id") % 100 == 0, 10).collect() == []
    assert ann.nearest(df, F.col("vec_id") % 20 == 0, 20).collect() == []
    assert ann.nearest(df, F.col("vec_id") % 20 == 0, 20).columns == ["query_id", "rank", "vec_id", "score"]
