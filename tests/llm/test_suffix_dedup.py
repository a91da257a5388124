import hashlib
import random

import numpy as np
import pytest

from isobar.llm import suffix_dedup as sd


def brute(rows, width):
    """Digest rows by looking up every window in a dictionary."""
    order = sorted({(r[0] if r[0] is not None else sd.NULL_ID, r[1] or "") for r in rows},
                   key=lambda x: (x[0], x[2] if len(x) > 2 else 0))
    texts = {k: k[1].encode() for k in order}
    seen, cover = set(), {}
    for k in order:
        raw = texts[k]
        c = np.zeros(len(raw), bool)
        for i in range(len(raw) - width + 1):
            w = raw[i:i + width]
            if w in seen:
                c[i:i + width] = True
            seen.add(w)
        cover[k] = c
    out = []
    for i, t in rows:
        k = (i if i is not None else sd.NULL_ID, t or "")
        raw, c = texts[k], cover[k]
        kept = bytes(np.frombuffer(raw, np.uint8)[~c])
        spans = int((np.diff(np.concatenate([[0], c.astype(int)])) == 1).sum())
        out.append((i, len(raw), int(c.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(40)]
    base = [" ".join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(n)]
    rows = []
    for i, t in enumerate(base):
        if i % 4 == 1:
            a = base[r.randrange(i)]
            at = r.randrange(len(a) + 1)
            t = t[:20] + a[at:at + r.randint(0, 150)] + t[20:]
        if i % 7 == 3:
            t = base[r.randrange(i)]
        if i % 11 == 5:
            t = "ab" * r.randint(1, 60) + t
        base[i] = t
        rows.append((i * 3, t))
    return rows


def got(spark, rows, width, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted([tuple(r) for r in sd.dedup_digest(df, width, **how).collect()], key=str)


@pytest.mark.parametrize("how", [{}, {"filter_bytes": -1}, {"hot_segments": 1}])
def test_against_dictionary(spark, how):
    rows = corpus(3) + [(500, None), (501, ""), (502, "x" * 100), (503, "x" * 99), (504, "x" * 350)]
    assert got(spark, rows, 100, **how) == brute(rows, 100)


def test_small_width_and_gram(spark):
    rows = corpus(9, 80)
    assert got(spark, rows, 24, gram=9) == brute(rows, 24)


def test_repeated_rows_null_ids_and_extra_columns(spark):
    t = "".join(chr(97 + (i * i) % 26) for i in range(300)) + "é"
    rows = [(1, t), (1, t), (2, t), (None, t[:150]), (None, None)]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, h long, start long")
    out = sorted([tuple(r) for r in sd.dedup_digest(df).collect()], key=str)
    assert out == brute(rows, 100)


def test_long_text_over_chunks(spark, monkeypatch):
    r = random.Random(5)
    long = "".join(r.choice("abcdefgh") for _ in range(sd.CHUNK + 5000))
    rows = [(1, long), (2, "zz" + long[sd.CHUNK - 400:sd.CHUNK + 300] + "yy"), (3, long[:50] + "q")]
    out = got(spark, rows, 100)
    assert [(x[0], x[1], x[2], x[3]) for x in out] == [
        (1, len(long), 0, 0), (2, 704, 700, 1), (3, 51, 0, 0)]


def test_empty_table(spark):
    assert got(spark, [], 100) == []


def test_documents_keep_the_other_bytes(spark):
    a = "".join(chr(97 + (i * 7 + i // 26) % 26) for i in range(250))
    df = spark.createDataFrame([(1, a), (2, "<" + a[20:180] + ">")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in sd.dedup_documents(df).collect()}
    assert bytes(out[1]["kept"]).decode() == a and out[1]["spans"] == []
    assert bytes(out[2]["kept"]).decode() == "<>"
    assert [tuple(s) for s in out[2]["spans"]] == [(1, 161)]


def test_two_stage_sort_orders_suffixes():
    r = np.random.default_rng(1)
    for trial in range(20):
        segs = [bytes(r.integers(97, 97 + r.integers(1, 4), r.integers(1, 30)).astype(np.uint8)) for _ in range(20)]
        text = np.concatenate([np.concatenate([np.frombuffer(s, np.uint8) + 1, [0]]) for s in segs]).astype(np.uint8)
        sa = sd.two_stage_sort(text, 40)
        assert sorted(sa.tolist()) == list(range(len(text)))
        end = {i: int(np.flatnonzero(text[i:] == 0)[0]) for i in range(len(text))}
        key = [(bytes(text[i:i + end[i]]) + b"\0", i + end[i]) for i in sa]
        assert [k[0] for k in key] == sorted(k[0] for k in key)
        assert sd.common_prefixes(text, sa, 8).max() <= 8
