"""Removal of repeated multi-line chunks (operator 10, Column expressions only).

Every line is hashed; a window of `MIN_LINES` successive lines that are not blank, with the
blank lines between them, rolls over the line hashes and every window is an anchor
(`line_pairs`). An anchor whose window starts earlier too (smallest id, then row, then
line) is a copy of that first place, and anchors that continue each other at both places
are grown line by line to one chunk (`repeated_passages`). So the content alone decides
where a chunk begins and ends: where the repetition does. Boundaries shift with an insertion
and need no sparse cut classes, whose chunks missed passages of a few lines. A chunk is
removed after its text was compared with the text of the first place byte by byte.

So every line goes that lies in a run of `MIN_LINES` or more such lines that also starts
earlier. A run may overlap its first place ("a a a" leaves "a"); single lines that repeat stay.
The query (`dedup_digest`) and the pipeline's stage (`dedup_lines`) share this.
With `keep_copies` (the pipeline) a document that as a whole is a copy of an earlier
one (`document_copies`) is no passage: what it shares with its original and the
original's other copies stays, so that the stage after this one finds the copy whole.
What both have from other documents is cut from both.

Only hashes and positions take part in the grouping; the texts are shuffled once, into a
table bucketed by row, in which the first places' texts are fetched and the copies
removed. The first place of a hash is found with partial aggregation, and the
occurrences of a hot window meet it in a join that splits.

Defined results: a NULL text stays NULL and has no lines; an empty text is one
blank line; repeated rows are separate rows, the later one loses its chunks;
NULL ids come last; a document may lose all its lines and stays as an empty
text; very long texts and lines are compared whole; an empty table gives no rows.
Lines end at "\\n" alone. Other columns, whatever their names, are ignored by the
digest and kept by `dedup_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from isobar.session import Scratch, materialize, scratch_path

from .common import WORD, packed

MIN_LINES = 2
GRAM = 5
COPY_LINES = 0.25
COPY_SIMILARITY = 0.8


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _blank(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\r\f\v", "    ")) == ""


def line_pairs(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(rid, n): the rows' numbers of lines, and
    (rid, oid, a, b, ck): successive lines a and b that are not blank, with the blank ones between them."""
    h = F.transform(_lines(F.col("text")), lambda x: F.concat(F.when(_blank(x), "-").otherwise(""), F.md5(x)))
    # a written table: the arrays are columns below and not formulas inside the lambdas
    c = scratch.table(docs.filter("text IS NOT NULL").select("rid", "oid", h.alias("h")), "pair-hashes")
    c = c.withColumn("solid", F.filter(F.sequence(F.lit(1), F.size("h")), lambda i: ~F.element_at("h", i).startswith("-")))
    n = F.greatest(F.size("solid") - 1, F.lit(0))
    sizes = c.select("rid", F.size("h").alias("n"))
    c = c.select("rid", "oid", "h", F.explode(F.arrays_zip(
        F.slice("solid", F.lit(1), n).alias("a"), F.slice("solid", F.lit(2), n).alias("b"))).alias("p"))
    return sizes, c.select("rid", "oid", F.col("p.a").alias("a"), F.col("p.b").alias("b"), F.unhex(F.md5(F.array_join(
        F.slice("h", F.col("p.a"), F.col("p.b") - F.col("p.a") + 1), ","))).alias("ck"))


def _blocks(items: str, follows) -> Column:
    """Structs (first, last) of the stretches of ``items`` in which each one follows the one before it."""
    n = F.size(items)
    starts = F.filter(items, lambda x, i: (i == 0) | ~F.coalesce(follows(F.get(items, i - 1), x), F.lit(False)))
    ends = F.filter(items, lambda x, i: (i == n - 1) | ~F.coalesce(follows(x, F.get(items, i + 1)), F.lit(False)))
    return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("first"), e.alias("last")))


def _grams(text: Column) -> Column:
    """The different runs of `GRAM` words (fewer words: the whole text), hashed."""
    w = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(0))
    n = F.size(w)
    zipped = F.arrays_zip(w, *[F.slice(w, F.lit(j + 1), F.greatest(n, F.lit(1))) for j in range(1, GRAM)])
    hashes = F.transform(zipped, lambda x: F.xxhash64(*[x[str(j)] for j in range(GRAM)]))
    return F.array_distinct(F.slice(hashes, F.lit(1), F.greatest(n - (GRAM - 1), F.lit(1))))


def document_copies(docs: DataFrame, sizes: DataFrame, runs: DataFrame, scratch: Scratch) -> DataFrame:
    """(rid, of): rows that are copies, as whole documents, of an earlier row they repeat lines of.

    Runs that cover at least `COPY_LINES` of both documents' lines make a candidate. It is a copy if one
    run covers both, or if the sets of word n-grams have a Jaccard similarity of `COPY_SIMILARITY`.
    """
    cover = runs.groupBy("rid", "f_rid").agg(F.sum(F.col("b") - F.col("a") + 1).alias("k"), F.max(F.col("b") - F.col("a") + 1).alias("top"))
    cand = cover.join(sizes.withColumnRenamed("n", "nx"), "rid") \
        .join(sizes.select(F.col("rid").alias("f_rid"), F.col("n").alias("ny")), "f_rid") \
        .filter((F.col("rid") != F.col("f_rid")) & (F.col("k") >= COPY_LINES * F.greatest("nx", "ny")))
    cand = scratch.table(cand.withColumn("whole", (F.col("top") == F.col("nx")) & (F.col("nx") == F.col("ny"))), "copy-candidates")
    near = cand.filter("NOT whole").select("rid", "f_rid")
    needed = near.select("rid").union(near.select("f_rid")).distinct()
    grams = scratch.table(docs.select("rid", "text").join(needed, "rid").select("rid", _grams(F.col("text")).alias("g")), "copy-grams")
    both = near.join(grams.withColumnRenamed("g", "x"), "rid") \
        .join(grams.select(F.col("rid").alias("f_rid"), F.col("g").alias("y")), "f_rid")
    shared = F.size(F.array_intersect("x", "y"))
    alike = both.withColumn("s", shared).filter(
        F.col("s") >= COPY_SIMILARITY * (F.size("x") + F.size("y") - F.col("s")) - 1e-9)
    found = cand.filter("whole").select("rid", "f_rid").unionByName(alike.select("rid", "f_rid"))
    return scratch.table(found.groupBy("rid").agg(F.min("f_rid").alias("of")), "copies")


def without_copies(runs: DataFrame, copies: DataFrame) -> DataFrame:
    """The runs but those that a copy shares with its original or with other copies of it."""
    own = copies.withColumnRenamed("of", "x_of")
    first = copies.select(F.col("rid").alias("f_rid"), F.col("of").alias("y_of"))
    same = (F.col("x_of") == F.col("f_rid")) | (F.col("x_of") == F.col("y_of"))
    return runs.join(own, "rid", "left").join(first, "f_rid", "left").filter(~F.coalesce(same, F.lit(False))).drop("x_of", "y_of")


def repeated_passages(docs: DataFrame, keep_copies: bool = False) -> DataFrame:
    """(rid, cand): per row the passages that occur earlier, as sorted structs of first and last line
    and the text of the first place; neighbours can share a line.

    With ``keep_copies`` what makes a document a copy of another one is no passage.

    ``docs``: rid, oid, text.
    """
    with Scratch(docs.sparkSession) as scratch:
        sizes, pairs = line_pairs(docs, scratch)
        pairs = scratch.table(pairs, "line-pairs")
        place = F.struct("oid", "rid", "a")
        firsts = pairs.groupBy("ck").agg(F.min(F.struct("oid", "rid", "a", "b")).alias("f"), F.max(place).alias("last")) \
            .filter(F.struct("f.oid", "f.rid", "f.a") != F.col("last")) \
            .select("ck", F.col("f.rid").alias("f_rid"), F.col("f.a").alias("f_a"), F.col("f.b").alias("f_b"))
        copies = pairs.join(firsts, "ck").filter((F.col("rid") != F.col("f_rid")) | (F.col("a") != F.col("f_a")))
        per_row = copies.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("a", "b", "f_rid", "f_a", "f_b"))).alias("w"))
        runs = per_row.select("rid", F.explode(_blocks("w", lambda x, y: (x["b"] == y["a"]) & (x["f_rid"] == y["f_rid"])
                                                       & (x["f_b"] == y["f_a"]))).alias("r"))
        runs = materialize(runs.select("rid", F.col("r.first.a").alias("a"), F.col("r.last.b").alias("b"), F.col(
            "r.first.f_rid").alias("f_rid"), F.col("r.first.f_a").alias("f_a"), F.col("r.last.f_b").alias("f_b")), "line-runs")
        if keep_copies:
            runs = materialize(without_copies(runs, document_copies(docs, sizes, runs, scratch)), "passage-runs")
    wanted = runs.select(F.col("f_rid").alias("rid"), "f_a", "f_b").distinct() \
        .groupBy("rid").agg(F.collect_list(F.struct("f_a", "f_b")).alias("w"))
    texts = docs.select("rid", "text").join(wanted, "rid").select(
        "rid", _lines(F.col("text")).alias("lines"), F.explode("w").alias("w")) \
        .select(F.col("rid").alias("f_rid"), "w.f_a", "w.f_b", F.array_join(
            F.slice("lines", F.col("w.f_a"), F.col("w.f_b") - F.col("w.f_a") + 1), "\n").alias("expected"))
    texts = packed(texts, "passage-texts")
    return runs.join(texts, ["f_rid", "f_a", "f_b"]).groupBy("rid").agg(F.array_sort(F.collect_list(
        F.struct(F.col("a").alias("first_line"), F.col("b").alias("last_line"), "expected"))).alias("cand"))


def numbered_rows(docs: DataFrame) -> DataFrame:
    """The rows with their number ``rid``, written once as a table bucketed by it.

    The texts are exchanged here and never again: joins by ``rid`` read the buckets as they lie.
    Rows of files keep their order when a task is repeated; what comes out of a shuffle may not, and
    would be numbered otherwise, so such an input is written before it is numbered.
    """
    spark = docs.sparkSession
    if "Exchange" in docs._jdf.queryExecution().executedPlan().toString():
        docs = packed(docs, "line-input")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "line-rows")
    name = "isobar_line_rows_" + path.rsplit("-", 1)[1]
    docs.withColumn("rid", F.monotonically_increasing_id()).repartition(n, "rid").write.format("parquet") \
        .option("compression", "zstd").option("path", path).bucketBy(n, "rid").sortBy("rid").saveAsTable(name)
    return spark.table(name)


def removal(docs: DataFrame, keep_copies: bool = False) -> DataFrame:
    """The rows with ``lines`` and ``removed``: the lines to remove, as sorted, separate stretches (a, b)."""
    docs = numbered_rows(docs).withColumn("oid", F.struct(F.col("doc_id").isNull(), F.col("doc_id")))
    cand = repeated_passages(docs.select("rid", "oid", "text"), keep_copies)
    rows = docs.drop("oid").join(cand, "rid", "left").withColumn("lines", _lines(F.col("text")))
    # explode and regroup would shuffle the texts again; the candidates are compared in place
    same = F.filter("cand", lambda c: F.array_join(
        F.slice("lines", c["first_line"], c["last_line"] - c["first_line"] + 1), "\n") == c["expected"])
    out = rows.withColumn("removed", F.coalesce(
        F.transform(same, lambda c: F.struct(c["first_line"].alias("a"), c["last_line"].alias("b"))),
        F.array().cast("array<struct<a:int,b:int>>"))).drop("cand")
    # chunks that share a line or touch are one gap in the text
    blocks = _blocks("removed", lambda x, y: y["a"] <= x["b"] + 1)
    return out.withColumn("removed", F.transform(blocks, lambda r: F.struct(r["first"]["a"].alias("a"), r["last"]["b"].alias("b"))))


def kept_text() -> Column:
    """The lines between the removed chunks, joined again."""
    gaps = F.zip_with(
        F.concat(F.array(F.lit(1)), F.transform("removed", lambda r: r["b"] + 1)),
        F.concat(F.transform("removed", lambda r: r["a"] - 1), F.array(F.size("lines"))),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    parts = F.flatten(F.transform(F.filter(gaps, lambda g: g["b"] >= g["a"]),
                                  lambda g: F.slice("lines", g["a"], g["b"] - g["a"] + 1)))
    return F.when(F.size("removed") == 0, F.col("text")).otherwise(F.array_join(parts, "\n"))


def dedup_lines(docs: DataFrame, keep_copies: bool = False) -> DataFrame:
    """The documents with repeated passages removed from ``text``; n_chars follows where it is given.

    ``keep_copies`` leaves copies of whole documents to a later search for near duplicates.
    """
    own = docs.columns
    out = removal(docs.select(*[F.col(c).alias(f"d_{c}") for c in own if c not in ("doc_id", "text")],
                              F.col("doc_id"), F.col("text")), keep_copies)
    changed = out.withColumn("kept", kept_text())
    cols = []
    for c in own:
        if c == "text":
            cols.append(F.col("kept").alias("text"))
        elif c == "doc_id":
            cols.append(F.col(c))
        elif c == "n_chars":
            cols.append(F.when(F.size("removed") == 0, F.col("d_n_chars"))
                        .otherwise(F.length("kept")).cast("long").alias("n_chars"))
        else:
            cols.append(F.col(f"d_{c}").alias(c))
    return changed.select(*cols)


def dedup_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_runs_removed, n_lines_removed, kept_sha256."""
    out = removal(docs.select("doc_id", "text")).withColumn("kept", kept_text())
    lines = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"] + 1)
    return out.select(
        "doc_id", F.coalesce(F.when(F.col("text").isNotNull(), F.size("lines")), F.lit(0)).cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_runs_removed"), lines.alias("n_lines_removed"),
        F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


# The same in DuckDB SQL (ids unique): all windows by their texts, without hashes and growing.
ORACLE = """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL),
s AS (
  SELECT doc_id, i AS a, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM l
  WHERE trim(translate(line, chr(9) || chr(13) || chr(12) || chr(11), '    ')) <> ''),
w AS (
  SELECT doc_id, a, b, array_to_string(string_split(text, chr(10))[a:b], chr(10)) AS body
  FROM s JOIN documents USING (doc_id) WHERE b IS NOT NULL),
c AS (SELECT doc_id, a, b FROM w QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, a) > 1),
g AS (SELECT DISTINCT doc_id, unnest(generate_series(a, b)) AS i FROM c),
m AS (SELECT l.*, g.i IS NOT NULL AS gone FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i),
r AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM m)
SELECT d.doc_id, count(r.i) AS n_lines, count(*) FILTER (WHERE r.begins) AS n_runs_removed,
       count(*) FILTER (WHERE r.gone) AS n_lines_removed,
       sha256(coalesce(string_agg(CASE WHEN r.gone THEN NULL ELSE r.line END, chr(10) ORDER BY r.i), '')) AS kept_sha256
FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id GROUP BY d.doc_id
"""
