"""SimHash near-duplicates against a direct comparison of all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from isobar.llm import queries, simhash
from isobar.session import Scratch

SF = "/root/testdata/sf0.001"


def direct(rows):
    """{row number: (fingerprint, component)} from the definition, pair by pair."""
    prints = []
    for _, text in rows:
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for w in "\t\n\v\f\r":
            t = t.replace(w, " ")
        words = [w for w in t.split(" ") if w]
        grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return prints, direct_components([i for i, _ in rows], prints)


def direct_components(ids, prints, radius=3):
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if group[i] != group[j] and (prints[i] ^ prints[j]).bit_count() <= radius:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    known = {g: [i for i, h in zip(ids, group) if h == g and i is not None] for g in set(group)}
    return [min(known[g]) if known[g] else None for g in group]


def result(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in simhash.near_components(docs, **kw).collect())


def expected(rows):
    prints, comps = direct(rows)
    return sorted((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, comps))


def test_texts_of_every_kind(spark):
    base = [f"wort{i % 17} über{i % 23}" for i in range(60)]
    rows = [(1, None), (2, ""), (3, " \t\n\v\f\r "), (4, "one"), (5, "One two"), (6, "a b c"), (7, "A  b\nC"),
            (8, " ".join(base)), (9, " ".join(base[:30] + ["changed"] + base[31:])), (10, "x y z x y z x y z"),
            (11, "a\x0bb\x1cc d e  f É"), (11, "a\x0bb\x1cc d e  f É"), (12, "w " * 50_000)]
    assert result(spark, rows) == expected(rows)


def test_empty_table_extra_columns_and_null_ids(spark):
    assert result(spark, []) == []
    docs = spark.createDataFrame([(None, "a b c d", 1, "x"), (7, "a b c d", 2, "y"), (None, "quite another text", 3, "z")],
                                 "doc_id long, text string, fp long, label string")
    got = sorted(str((r["doc_id"], r["component_id"])) for r in simhash.near_components(docs).collect())
    assert got == ["(7, 7)", "(None, 7)", "(None, None)"]


def prints_with_links(n, seed):
    rnd = random.Random(seed)
    out = [rnd.getrandbits(64) for _ in range(n // 2)]
    while len(out) < n:
        x = rnd.choice(out)
        for b in rnd.sample(range(64), rnd.randint(1, 5)):
            x ^= 1 << b
        out.append(x)
    # a crowd that shares its upper 40 bits
    return out + [0xABCDEF0123 << 24 | rnd.getrandbits(24) for _ in range(n // 4)]


@pytest.mark.parametrize("group, depth", [(4096, 3), (8, 3), (8, 1), (1, 2)])
def test_groups_divided_and_cut_lose_no_link(spark, group, depth):
    prints = sorted(set(prints_with_links(300, 5)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    with Scratch(spark) as scratch:
        label = simhash.components(scratch.table(simhash.links(nodes, scratch, group=group, depth=depth), "t"))
        got = {r["node"]: r["label"] for r in label.collect()}
    comps = direct_components(signed, prints)
    assert {p: got.get(p, p) for p in signed} == dict(zip(signed, comps))


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_kernel_finds_exactly_the_near_nodes(radius):
    values = np.array(prints_with_links(200, 7), np.uint64)
    lanes = simhash.Lanes([values[:130], values[130:]])
    for a in lanes.of(0):
        for b in lanes.of(1):
            for slot in range(int(lanes.count[a])):
                _, word = simhash.near_slots(lanes, np.array([a]), np.array([b]), slot, radius)
                found = int(word[0]) if len(word) else 0
                x = int(lanes.values[a, slot])
                want = sum(1 << j for j in range(int(lanes.count[b]))
                           if (x ^ int(lanes.values[b, j])).bit_count() <= radius)
                assert found == want


def test_query_against_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op11_simhash"](spark, SF).collect())
    assert got == expected(rows)


def test_fingerprint_hash_is_sparks(spark):
    h = spark.range(1).select(F.xxhash64(F.lit("über a b")).alias("h")).first()["h"]
    assert h % (1 << 64) == int(simhash.shingle_hashes("Über A b".replace("Ü", "ü").encode())[0])
