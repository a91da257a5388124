"""Passages of a few lines that documents share, in texts that differ around them."""

import random

from isobar.llm import line_dedup as ld


def solid(line):
    return line.strip(" \t\r\f\v") != ""


def kept(rows):
    """rows: (doc_id, text) with ids in order: every two successive solid lines that occur earlier go."""
    seen, out = set(), {}
    for i, t in rows:
        lines = t.split("\n")
        at = [k for k, x in enumerate(lines) if solid(x)]
        gone = set()
        for a, b in zip(at, at[1:]):
            body = "\n".join(lines[a:b + 1])
            if body in seen:
                gone |= set(range(a, b + 1))
            seen.add(body)
        out[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def own(r, i, n):
    return [f"own {i} {k} {r.random()}" for k in range(n)]


def dedup(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r["text"] for r in ld.dedup_lines(df).collect()}


def test_short_passages_between_other_lines(spark):
    r = random.Random(5)
    rows, want = [], {}
    for p in range(40):
        passage = [f"passage {p} line {k} {r.random()}" for k in range(2 + p % 4)]
        for c in range(3):
            i = 3 * p + c
            head, tail = own(r, i, r.randint(1, 4)), own(r, -i - 1, r.randint(1, 4))
            rows.append((i, "\n".join(head + passage + tail)))
            want[i] = rows[-1][1] if c == 0 else "\n".join(head + tail)
    assert dedup(spark, rows) == want


def test_passages_against_loop(spark):
    r = random.Random(6)
    pool = [f"line {i} é" for i in range(30)] + ["", "  ", "\t"]
    rows = []
    for i in range(80):
        t = [r.choice(pool) for _ in range(r.randint(1, 10))]
        if rows and r.random() < 0.7:
            other = r.choice(rows)[1].split("\n")
            at = r.randrange(len(other))
            t += other[at:at + r.randint(1, 6)] + own(r, i, 1)
        rows.append((i, "\n".join(t)))
    rows += [(900, ""), (901, "\n"), (902, "z\nz\nz\nz"), (903, "q\n\n\nw\ne"), (904, "q\n\n\nw\nr"), (905, "q\n \n\nw"),
             (906, "q\n \n\nw\nt")]
    got = dedup(spark, rows)
    assert got == kept(rows)
    assert (got[902], got[904], got[906]) == ("z", "r", "t")


def test_copies_of_whole_documents_stay_whole(spark):
    r = random.Random(9)
    shared = [f"shared passage {k} " + " ".join(str(r.random()) for _ in range(8)) for k in range(3)]
    text = [" ".join(str(r.random()) for _ in range(20)) for _ in range(10)]
    near = text[:4] + [text[4].rsplit(" ", 1)[0] + " changed"] + text[5:]
    far = text[:5] + own(r, 5, 6)
    rows = [(1, own(r, 1, 3) + shared), (2, text[:5] + shared + text[5:]), (3, text[:5] + shared + text[5:]),
            (4, near[:5] + shared + near[5:]), (5, far), (6, near), (7, own(r, 7, 2) + shared)]
    rows = [(i, "\n".join(x)) for i, x in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["text"].split("\n") for x in ld.dedup_lines(df, keep_copies=True).collect()}
    # what all copies have from document 1 is cut from all; what they have from document 2 stays
    assert got[2] == got[3] == text and got[4] == got[6] == near
    # half a document is a passage
    assert got[5] == far[5:] and got[7] == rows[6][1].split("\n")[:2]
    assert {x["doc_id"]: x["text"] for x in ld.dedup_lines(df).collect()} == kept(rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ld.dedup_lines(empty, keep_copies=True).collect() == []
