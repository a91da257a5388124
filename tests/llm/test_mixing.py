import random
from collections import defaultdict

import pytest

from isobar.llm import mixing as mx
from isobar.llm.common import word_count


def targets_by_rounds(sizes, weights=(5, 2, 1), cap=3):
    """Resharing as the text says: cut at the cap, share the excess by weight, again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, got, open_ = sum(sizes.values()), {}, set(names)
    rest = float(total)
    while open_:
        share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s] + 1e-9]
        if not over:
            got.update(share)
            break
        for s in over:
            got[s] = float(cap * sizes[s])
            rest -= got[s]
            open_.discard(s)
    return got


def rows(seed=1, n=300):
    r = random.Random(seed)
    out = []
    for i in range(n):
        source = r.choice(["a", "a", "a", "b", "é", "z", None, "", "tiny" if i < 3 else "a"])
        out.append((i if i % 50 else None, " ".join(["w"] * r.choice([0, 1, 7, 90, 700])), source))
    out.append((5, "same text", "b"))
    out.append((5, "same text", "b"))
    out.append((6, None, "nothing"))
    return out


@pytest.fixture(scope="module")
def mixed(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, source string") \
        .selectExpr("*", "1 AS rid", "2 AS size", "'x' AS block")
    return [r.asDict() for r in mx.mix_sources(df, block=16).collect()]


def test_targets_and_taken(mixed):
    sizes = defaultdict(int)
    for _, t, s in rows():
        sizes[s] += len((t or "").split())
    want, taken = targets_by_rounds(sizes), defaultdict(int)
    assert len(mixed) == len(rows())
    for r in mixed:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_reruns_agree(spark, mixed):
    df = spark.createDataFrame(rows(), "doc_id long, text string, source string")
    again = [r.asDict() for r in mx.mix_sources(df, block=16).collect()]
    key = lambda r: str(sorted(r.items(), key=str))
    assert sorted(map(key, again)) == sorted(map(key, mixed))


def test_schedule_prefixes_are_close_to_the_mix(spark):
    df = spark.createDataFrame([("=a", "a", 40000), ("=b", "b", 30000), ("=c", "c", 50000)],
                               "skey string, source string, size long")
    t = mx.source_targets(df)
    share = {r["skey"]: r["target"] / 120000 for r in t.collect()}
    slots = sorted((r["slot"], r["skey"], r["words"]) for r in mx.mix_schedule(t, block=100).collect())
    seen = defaultdict(int)
    for n, (_, s, _) in enumerate(slots, 1):
        seen[s] += 1
        assert all(abs(seen[x] - n * share[x]) < 6 for x in share)
    assert sum(w for _, _, w in slots) == 120000


def test_documents_of_the_mix(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, source string").selectExpr("*", "'k' AS skey")
    out = mx.mixed_documents(df, block=16)
    assert out.columns == df.columns
    times = defaultdict(int)
    for r in out.collect():
        times[r["doc_id"], r["text"], r["source"]] += 1
    assert times and max(times.values()) <= 6 and all((t or "").split() for _, t, _ in times)


def test_empty_and_blank(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mx.mix_sources(df).collect() == []
    assert mx.mixed_documents(df).collect() == []
    df = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in mx.mix_sources(df).collect()) == \
        [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_words_are_runs_without_ascii_white_space(spark):
    df = spark.createDataFrame([(" a\tb\x0bc\x0c d e \r\n",), ("",), (None,)], "text string")
    from pyspark.sql import functions as F
    assert [r[0] for r in df.select(word_count(F.col("text"))).collect()] == [4, 0, 0]


def test_pieces_in_slot_order_are_near_the_targets_at_every_prefix(spark):
    docs = spark.createDataFrame(rows(seed=4, n=400), "doc_id long, text string, source string")
    pieces = sorted(tuple(r) for r in mx.mix_pieces(docs, block=16).select("slot", "first_word", "words", "source", "doc_id").collect()
                    if r["words"] > 0)
    taken = mx.mix_sources(docs, block=16).collect()
    # the pieces are the words that the query counts
    per_source, want = defaultdict(int), defaultdict(int)
    for _, first, words, source, _ in pieces:
        assert first >= 0 and words <= 16
        per_source[source] += words
    for r in taken:
        want[r["source"]] += r["taken"]
    assert {k: v for k, v in want.items() if v} == dict(per_source)
    share = {s: n / sum(want.values()) for s, n in want.items()}
    so_far, total, slots = defaultdict(int), 0, 0
    for slot, _, words, source, _ in pieces:
        so_far[source] += words
        total += words
        if slot > slots and slot % 50 == 0:
            slots = slot
            for s in share:
                # a few blocks away from the target, at every prefix
                assert abs(so_far[s] - share[s] * total) <= 16 * 6, (slot, s)
    assert slots > 500
