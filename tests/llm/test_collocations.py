"""Collocations against direct counting, at several flush sizes and filter sizes."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import collocations as C
from isobar.llm.hashing import FILTER_BLOCK

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def direct(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) >= 2 and a >= least}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in cand.items()):
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def corpus(n, seed=3):
    rnd = random.Random(seed)
    words = ["der", "Wind", "dreht", "auf", "West", "über", "Nacht", "x\x00y", "é", " ", "no", "\x1c"]
    marks = [" ", " ", " ", " ", "\t", ". ", ",", "\n", "\x0b", " ! ", "  "]
    rows = []
    for _ in range(n):
        text = "".join(rnd.choice(words[:rnd.randint(3, 12)]) + rnd.choice(marks) for _ in range(rnd.randint(0, 60)))
        rows.append((rnd.choice(["de", "de", "de", None, "und", "fr"]), text + "Wind dreht auf West" * rnd.randint(0, 2)))
    return rows + [("de", None), (None, ""), ("xx", " . "), ("yy", "single")]


def result(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("1 AS a", "'z' AS phrase", "lang", "text")
    out = C.collocations(docs, **kw)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("tokens, filter_bytes", [(1 << 21, 32 << 20), (50, 1)])
def test_against_direct_counting(spark, tokens, filter_bytes):
    rows = corpus(150)
    assert result(spark, rows, least=10, tokens=tokens, filter_bytes=filter_bytes) == direct(rows, 10, 2000)


def test_top_and_ties(spark):
    rows = corpus(80, seed=8)
    assert result(spark, rows, least=4, top=7) == direct(rows, 4, 7)


def test_one_hot_prefix_and_a_long_text(spark, monkeypatch):
    # the word "a" starts a third of all pairs; one text of a single piece spans several slices
    monkeypatch.setattr(C, "SLICE", 1000)
    rows = [("en", " ".join(f"a w{i % 97}" for i in range(4000)))] + [("en", "a b c d e")] * 40
    assert result(spark, rows, least=30) == direct(rows, 30, 2000)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_a_full_filter_only_lets_more_through():
    v = C.Vocabulary()
    words = next(C.word_numbers([b"a b c. a b c"], v))
    full, empty = (np.full(FILTER_BLOCK, x, np.uint8) for x in (255, 0))
    hashes = np.array(v.hashes, np.uint64)
    fits = {name: C.fitting(words, hashes, "en", 2, bits) for name, bits in (("full", full), ("empty", empty))}
    found = C.level_stripes(words, v, "en", 2, fits["full"]).to_pydict()
    assert found["prefix"] == [b"a b"] and found["next"] == [[b"c"]] and found["n"] == [[2]]
    assert C.level_stripes(words, v, "en", 2, fits["empty"]) is None
    # the totals of one word hold what its entries leave out
    found = C.level_stripes(words, v, "en", 1, fits["empty"]).to_pydict()
    assert sorted(found["prefix"]) == [b"a", b"b", b"c"] and found["next"] == [[b"."]] * 3 and found["n"] == [[2]] * 3


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    row = spark.range(1).select(F.lit(big).alias("a"), F.array(F.lit(big + 1), F.lit(big)).alias("lefts"),
                                F.array(F.lit(big + 2), F.lit(big)).alias("rights"))
    cut = row.select(C._lowest_cut().alias("c")).first()["c"]
    assert tuple(cut) == (2_000_000 * big // (2 * big + 3), 1)


def test_stripes_of_two_words_leave_out_rare_triples(spark):
    # the pairs of "a b c" are frequent, the triple is not
    rows = [("en", "a b. b c")] * 5 + [("en", "a b c. b c d")]
    texts = spark.createDataFrame(rows, "lang string, text string").selectExpr("lang", "CAST(text AS binary) AS raw")
    b = spark.sparkContext.broadcast
    bits = {2: b(C.bounded_filter(C.frequent_phrases(texts, 2, 5)))}
    triples = C.frequent_phrases(texts, 3, 5, bits=bits[2])
    assert triples.count() == 0
    bits[3] = b(C.bounded_filter(triples))
    assert C.stripes(texts, (2, 3), bits).count() == 0
    # one more of them than the least, and the triple is there
    triples = C.frequent_phrases(texts, 3, 1, bits=bits[2])
    assert triples.count() == 1
    found = C.stripes(texts, (2, 3), {2: bits[2], 3: b(C.bounded_filter(triples))}).collect()
    assert [(r["prefix"], r["next"], r["n"]) for r in found] == [(b"a b", [b"c"], [1])]


@pytest.mark.parametrize("longest", [2, 3, 5])
def test_other_lengths(spark, longest):
    rows = [("en", "a b c d e f. a b c d. a b")] * 6
    found = {r[2]: r[3] for r in result(spark, rows, least=3, longest=longest)}
    whole = {2: {"a b": 18, "b c": 12, "c d": 12, "d e": 6, "e f": 6},
             3: {"a b": 18, "a b c": 12, "b c d": 12, "c d e": 6, "d e f": 6},
             5: {"a b": 18, "a b c d": 12, "a b c d e": 6, "b c d e f": 6}}[longest]
    assert found == whole
