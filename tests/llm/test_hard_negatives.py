"""Hard negatives against a direct search over all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import hard_negatives as H


def direct(rows, anchors, low=50, high=95, k_pos=5, k_neg=3):
    ok = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in rows
          if i is not None and l is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, l, v in ok:
        if anchors(i):
            asked[i] = min(asked.get(i, (l, v)), (l, v))
    out = []
    for i, (label, v) in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, l) for j, l, w in ok if j != i)
        for rank_p, (s, p, _) in enumerate([x for x in scored if x[2] == label][:k_pos], 1):
            inside = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:k_neg]
            out += [(i, p, r, x[1], -s, -x[0], rank_p) for r, x in enumerate(inside, 1)]
    return sorted(out)


def result(spark, rows, anchors, **kw):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>") \
        .selectExpr("'x' AS v", "0 AS g", "1 AS rid", "vec_id", "label", "embedding")
    out = H.hard_negatives(df, anchors, **kw)
    return sorted(tuple(r) for r in out.collect())


def vectors(n, dim, seed, labels=4, centres=6):
    """Clustered rows; a third of them have one label."""
    rnd = np.random.default_rng(seed)
    middle = rnd.normal(size=(centres, dim))
    return [(i, 0 if i % 3 == 0 else int(rnd.integers(labels)),
             (middle[rnd.integers(centres)] + 0.4 * rnd.normal(size=dim)).tolist()) for i in range(n)]


def test_clustered_rows(spark):
    rows = vectors(700, 8, 1)
    want = direct(rows, lambda i: i % 10 == 0)
    assert want and result(spark, rows, F.col("vec_id") % 10 == 0) == want


def test_many_small_blocks_and_shards(spark, monkeypatch):
    for name, value in (("ANCHOR_BLOCK", 8), ("VECTOR_BLOCK", 32), ("CELL_ANCHORS", 16), ("CELL_VECTORS", 64), ("STEP", 4)):
        monkeypatch.setattr(H, name, value)
    rows = vectors(400, 6, 2, labels=40)
    assert result(spark, rows, F.col("vec_id") % 5 == 0, clusters=3) == direct(rows, lambda i: i % 5 == 0)


def test_odd_rows_ties_and_repeats(spark):
    rnd = random.Random(4)
    rows = [(i, i % 3, [rnd.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)]) for i in range(60)]
    rows += [(100, None, [1.0, 1.0, 1.0]), (105, 1, None), (110, 1, [1.0, None, 0.0]), (115, 0, [float("nan"), 0.0, 0.0]),
             (120, 2, [float("inf"), 0.0, 0.0]), (None, 1, [1.0, 1.0, 1.0]), (125, 1, []), (130, 1, [0.0, 0.0, 0.0]),
             (135, 2, [1.0]), (140, 7, [1.0, 0.5, 1.0])]
    rows += rows[5:25]                                    # repeated rows, anchors among them
    rows += [(10, 2, [1.0, 1.0, 1.0])]                    # an anchor's id with another label
    assert result(spark, rows, F.col("vec_id") % 5 == 0) == direct(rows, lambda i: i % 5 == 0)


def test_few_rows_and_empty_table(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 2, [0.6, 0.3]), (3, 2, [5.0, 0.0])]
    want = direct(rows, lambda i: i == 0)
    assert len(want) == 1 and result(spark, rows, F.col("vec_id") == 0) == want
    assert result(spark, [], F.col("vec_id") == 0) == []
    assert result(spark, rows, F.col("vec_id") == 99) == []


@pytest.mark.parametrize("seed", range(4))
def test_bound_holds_and_walks_end_early(seed):
    rnd = np.random.default_rng(seed)
    anchors = np.floor(256 * (np.array([3.0] + [0.0] * 15) + 0.2 * rnd.normal(size=(40, 16))))
    others = np.floor(256 * rnd.normal(size=(4000, 16)))
    block = H.Positives(np.arange(40), np.zeros(40, np.int64), anchors, 5)
    order, bound = block.shared_list(others)
    scores = anchors @ others[order].T
    assert (scores <= block.norm[:, None] * bound[None, :] + 1e-6).all() and (np.diff(bound) <= 0).all()
    done = block.walk(np.arange(100, 4100), np.zeros(4000, np.int64), others)
    assert done < 0.5 * scores.size
    assert (block.score[:, 0] == -np.sort(-scores, axis=1)[:, :5]).all()
