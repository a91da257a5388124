import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import toxicity as tx


def corpus(n=900, seed=2):
    r = random.Random(seed)
    plain = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(400)]
    bad = ["zorgle", "quixxy", "vrumpel"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 9 == 0
        words = [r.choice(plain) for _ in range(r.randint(5, 120))]
        if toxic:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randrange(len(words)), r.choice(bad) + r.choice(["", "en", "ung", "s"]))
        docs.append((i, " ".join(words), r.choice(["x", "y"])))
        if r.random() < 0.7:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, source string, score double"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    docs += [(9001, None, "x"), (9002, "", "x"), (None, "plain words", "x"), (0, docs[0][1], "x")]
    labels += [(9001, 1, None), (None, 1, 1), (9002, 1, 7)]
    d, lab = frames(spark, docs, labels)
    out = [r.asDict() for r in tx.toxicity(d, lab).collect()]
    assert len(out) == len(docs)
    for r in out:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    test = [r for r in out if r["held_out"] and r["doc_id"] < 900]
    right = sum(r["predicted"] == (r["doc_id"] % 9 == 0) for r in test)
    assert len(test) > 100 and right / len(test) > 0.98


def test_held_out_labels_are_not_read(spark):
    docs, labels = corpus(400)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a = {r["doc_id"]: r["score"] for r in tx.toxicity(*frames(spark, docs, labels)).collect()}
    b = {r["doc_id"]: r["score"] for r in tx.toxicity(*frames(spark, docs, flipped)).collect()}
    assert a == pytest.approx(b)


def test_no_labels_and_empty(spark):
    docs, _ = corpus(20)
    d, lab = frames(spark, docs, [])
    assert {r["score"] for r in tx.toxicity(d, lab).collect()} == {0.0}
    d, lab = frames(spark, [], [(1, 1, 1)])
    assert tx.toxicity(d, lab).collect() == []


def test_drop_toxic_keeps_clean_rows_and_columns(spark):
    docs, labels = corpus(500)
    d, lab = frames(spark, docs, labels)
    kept = tx.drop_toxic(d, lab)
    assert kept.columns == d.columns
    ids = {r["doc_id"] for r in kept.collect()}
    clean = {i for i, _, _ in docs if i % 9}
    assert len(clean - ids) <= 3 and len(ids - clean) <= 3


def test_label_model_recovers_rates_of_correlated_voters():
    r = np.random.default_rng(1)
    y = r.random(6000) < 0.2
    votes = np.zeros((6000, 5), np.int8)
    for j, (p1, p0) in enumerate([(.7, .02), (.5, .01), (.6, .05), (.3, .01)]):
        votes[:, j] = r.random(6000) < np.where(y, p1, p0)
    votes[:, 4] = votes[:, 0]        # the same voter again
    some = r.random(6000) < 0.1
    pairs = np.stack([votes[some & (y == c)].astype(float).T @ votes[some & (y == c)] for c in (False, True)])
    model = tx.fit_step(np.array([(some & ~y).sum(), (some & y).sum()], float), pairs, None)
    assert model.parent[4] == 0 or model.parent[0] == 4
    for _ in range(5):
        p = model.posterior(votes)
        total = np.array([(1 - p).sum(), p.sum()])
        pairs = np.stack([(votes * w[:, None]).T @ votes for w in (1 - p, p)])
        model = tx.fit_step(total, pairs, model.parent)
    assert abs(model.prior - 0.2) < 0.04
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.93
    # the copy adds nothing: with and without it the posterior is nearly the same
    both, one = np.array([[1, 0, 0, 0, 1]]), np.array([[0, 1, 0, 0, 0]])
    assert model.posterior(both)[0] < 0.97 and model.posterior(one)[0] > 0.5


def test_features_mark_shared_prefixes():
    assert "lowei*" in tx.features_of("Loweisch der") and "lowei**" not in tx.features_of("Loweisch loweisch")
    assert "lowei**" in tx.features_of("loweisch loweian")
    m = tx.Matcher(["lowei**", "der"])
    assert m.hits("LOWEIsch loweian") == [0] and m.hits("der loweix") == [1]


def test_crc_matches_the_text_of_the_id(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "doc_id long")
    got = [r[0] for r in df.select(tx.held_out(F.col("doc_id"))).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)]
