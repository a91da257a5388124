import hashlib
import random

from pyspark.sql import functions as F

from isobar.llm import line_dedup as ld


def brute(rows):
    """rows: (doc_id, text) in input order; ties of an id by position."""
    seen, out = set(), {}
    for at, (i, t) in sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[0])):
        if t is None:
            out[at] = (i, 0, 0, 0, hashlib.sha256(b"").hexdigest())
            continue
        lines, gone = t.split("\n"), set()
        solid = [k for k, x in enumerate(lines) if x.strip(" \t\r\f\v")]
        for a, b in zip(solid, solid[1:]):
            body = tuple(lines[a:b + 1])
            if body in seen:
                gone |= set(range(a, b + 1))
            seen.add(body)
        text = t if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone)
        runs = sum(k - 1 not in gone for k in gone)
        out[at] = (i, len(lines), runs, len(gone), hashlib.sha256(text.encode()).hexdigest())
    return sorted(out.values(), key=str)


def corpus():
    r = random.Random(2)
    pool = [f"line {i} é" for i in range(40)] + ["", "  ", "\t"]
    rows = []
    for i in range(60):
        t = [r.choice(pool) for _ in range(r.randint(1, 12))]
        if rows and r.random() < 0.7:
            other = r.choice(rows)[1].split("\n")
            t = t + other + [f"end {i}"]
        rows.append((i, "\n".join(t)))
    return rows


def test_against_loop(spark):
    rows = corpus() + [(900, None), (901, ""), (902, "\n"), (902, corpus()[5][1]), (None, corpus()[9][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted([tuple(r) for r in ld.dedup_digest(df).collect()], key=str) == brute(rows)


def test_query_and_stage_remove_the_same(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    texts = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in ld.dedup_lines(df).collect()}
    assert texts == {r["doc_id"]: r["kept_sha256"] for r in ld.dedup_digest(df).collect()}


def test_short_passages_wherever_they_stand(spark):
    """Passages of two to five lines between lines of their own, at other offsets in every document."""
    passages = [[f"passage {k} line {j} " + "word " * 14 for j in range(2 + k % 4)] for k in range(24)]
    rows = []
    for i in range(3):
        for k, p in enumerate(passages):
            own = [f"own {i} {k} {j}" for j in range((7 * i + 3 * k) % 5 + 1)]
            rows.append((i * 100 + k, "\n".join([*own, *p, f"end {i} {k}"])))
    out = {r["doc_id"]: r for r in ld.dedup_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(3):
        for k, p in enumerate(passages):
            assert out[i * 100 + k]["n_lines_removed"] == (len(p) if i else 0)


def test_clashing_columns_and_long_text(spark):
    """Extra columns named like the working ones; a text of 60,000 lines and a line of 1 MB."""
    long = "\n".join(f"row {i}" for i in range(60000))
    rows = [(1, long + "\n" + "x" * 1_000_000), (2, "own\n" + long), (3, "a\n" + "x" * 1_000_000)]
    df = spark.createDataFrame([(i, t, 7, "c", [1], "k") for i, t in rows],
                               "doc_id long, text string, rid int, cand string, removed array<int>, ck string")
    got = sorted([tuple(r) for r in ld.dedup_digest(df).collect()], key=str)
    assert got == brute(rows) and [g[3] for g in got] == [0, 60000, 0]


def test_documents_keep_columns(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "en", None, len(t), "x") for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, lines string")
    out = ld.dedup_lines(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(rows) and all(len(r["text"]) == r["n_chars"] for r in got.values())
    assert any(len(got[i]["text"]) < len(t) for i, t in rows)


def test_empty_table_and_all_removed(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ld.dedup_digest(df).collect() == []
    t = "\n".join(f"row {i}" for i in range(30))
    df = spark.createDataFrame([(1, t), (2, t), (2, t)], "doc_id long, text string")
    out = sorted(tuple(r)[:4] for r in ld.dedup_digest(df).collect())
    assert out[0][2] == 0 and out[1][2] > 0 and out[1] == out[2]


def test_row_numbers_survive_a_changing_order(spark):
    """An input whose rows come in another order in every pass gives the same result."""
    body = "\n".join(f"line {i} of the shared part" for i in range(40))
    rows = [(i, f"own line {i}\nand another {i}\n{body}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    still = {r["doc_id"]: r["kept_sha256"] for r in ld.dedup_digest(df).collect()}
    moving = df.withColumn("r", F.expr("reflect('java.util.UUID', 'randomUUID')")).repartition(5, "r") \
        .sortWithinPartitions("r").drop("r")
    assert {r["doc_id"]: r["kept_sha256"] for r in ld.dedup_digest(moving).collect()} == still
