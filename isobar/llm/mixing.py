"""Mixing sources to target weights (operator 1, Column expressions only).

Every source gets a target share of the corpus (`source_targets`). A slot
schedule realises the shares: slot ``j`` gets the golden-ratio point
``frac(j * phi)``, which the cumulative slot shares of the sources map to a
source, so any prefix of the schedule is close to the target mix. Slots are
ranked per source; the r-th slot of a source takes block ``r mod n_blocks`` of
its shuffled stream, cut into blocks of equally many words.

`mix_pieces` gives the mix itself in the order of the slots. That order is no part of
the other results: every source fills all its slots, so ``taken`` and the documents of
the mix depend on their number alone, and both come in no mix order.

No step needs one source in one task. Word offsets and slot ranks are prefix
sums in two levels (hash ranges or slot ranges first, then inside a range),
slots find their source by an equi-join on cells of the unit interval, and
blocks join on (source, block).

Defined results: NULL and blank texts have size 0 and are never taken; NULL
sources are one source, last in order; repeated rows are separate rows that are
shuffled by (hash of id and text, row); an empty table gives no rows. Other
columns of the input are ignored. Equal input rows can swap their ``taken``
between runs, never change the multiset.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from isobar.session import materialize

from .common import WORD, source_key, word_count

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
BLOCK_WORDS = 256
RANGE_DIGITS = 3          # hexadecimal digits of the shuffle key that make its ranges: 4096 per source
SLOT_RANGE = 16384        # slots ranked together
SEED = 17
POINT_STEP = 1 << 20      # points are computed in steps, which keeps them exact
CELLS = 4096              # cells of the unit interval in the point lookup
GOLDEN = (math.sqrt(5) - 1) / 2


def sized(docs: DataFrame, seed: int, keep: list[str] | None = None) -> DataFrame:
    """(rid, doc_id, source, skey, size, k, part): sizes and shuffle keys, written once."""
    keep = keep or []
    d = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id"), F.col("source"),
        source_key(F.col("source")).alias("skey"), word_count(F.col("text")).alias("size"),
        F.substring(F.md5(F.concat_ws("\n", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("text"))),
                    1, 16).alias("k"),
        *[F.col(c).alias(f"keep_{c}") for c in keep])
    d = d.withColumn("part", F.conv(F.substring("k", 1, RANGE_DIGITS), 16, 10).cast("int"))
    return materialize(d, "mix-sized")


def source_targets(docs: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(skey, source, source_size, target): weighted shares of all words, no target
    above ``cap`` times its source, the excess reshared by weight.

    One row per source: the fixed point of the resharing has the closed form
    ``min(cap * size, weight * level)``, and the level follows from the sources
    in the order in which they reach their cap.
    """
    s = (docs.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size")))
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                       ((n - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("room", F.col("source_size").cast("double") * cap) \
         .withColumn("full_at", F.col("room") / F.col("w"))
    by = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    s = (s.withColumn("i", F.row_number().over(by))
         .withColumn("total", F.sum(F.col("source_size").cast("double")).over(every))
         .withColumn("filled", F.sum("room").over(by.rowsBetween(Window.unboundedPreceding, 0)) - F.col("room"))
         .withColumn("w_left", F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level", (F.col("total") - F.col("filled")) / F.col("w_left")))
    first = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("i", "level"))).over(every)
    s = s.withColumn("lvl", F.coalesce(first["level"], F.lit(0.0)))
    return s.select("skey", "source", "source_size",
                    F.least(F.col("room"), F.col("w") * F.col("lvl")).alias("target"))


def _slot_plan(targets: DataFrame, block: int) -> DataFrame:
    """Per source: words to take, blocks per pass, slots, and its part of [0, 1)."""
    s = targets.select("skey", "source_size", F.round("target").cast("long").alias("words")) \
        .filter("words > 0 AND source_size > 0")
    s = s.withColumn("n_blocks", F.ceil(F.col("source_size") / block).cast("long"))
    s = s.withColumn("passes", F.expr("words div source_size"))
    s = s.withColumn("rest", F.expr("words - passes * source_size"))
    s = s.withColumn("n_slots", F.col("passes") * F.col("n_blocks")
                     + F.ceil(F.col("rest") / block).cast("long"))
    w = Window.orderBy("skey").rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("hi_slots", F.sum("n_slots").over(w))
    total = F.sum("n_slots").over(Window.partitionBy())
    return s.withColumn("lo", (F.col("hi_slots") - F.col("n_slots")) / total) \
            .withColumn("hi", F.col("hi_slots") / total)


def mix_schedule(targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(slot, skey, pass, block, words): the order in which blocks are taken.

    ``words`` is the block's length, less for the last slot of a source, so that
    each source's words add up to its rounded target.
    """
    spark = targets.sparkSession
    plan = materialize(_slot_plan(targets, block), "mix-plan")
    n_slots = plan.agg(F.sum("n_slots")).first()[0] or 0
    # frac(j * golden) in two parts, so that it stays exact for very long schedules
    step = POINT_STEP
    big = math.modf(step * GOLDEN)[0]
    j = F.col("id")
    point = F.pmod(F.pmod(F.floor(j / step) * F.lit(big), F.lit(1.0))
                   + (j % step) * F.lit(GOLDEN), F.lit(1.0))
    slots = spark.range(0, n_slots).select(j.alias("slot"), point.alias("u")) \
        .withColumn("cell", F.floor(F.col("u") * CELLS).cast("long"))
    cells = plan.select("skey", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * CELLS).cast("long"),
        F.least(F.floor(F.col("hi") * CELLS).cast("long"), F.lit(CELLS - 1).cast("long")))).alias("cell"))
    drawn = slots.join(cells, "cell").filter("u >= lo AND u < hi") \
        .select("slot", "skey", F.expr(f"slot div {SLOT_RANGE}").alias("run"))
    drawn = materialize(drawn, "mix-slots")
    runs = drawn.groupBy("skey", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("skey").orderBy("run")
    runs = runs.select("skey", "run", (F.sum("n").over(before) - F.col("n")).alias("base"))
    in_run = F.row_number().over(Window.partitionBy("skey", "run").orderBy("slot"))
    ranked = drawn.withColumn("in_run", in_run).join(runs, ["skey", "run"]) \
        .select("skey", "slot", (F.col("base") + F.col("in_run") - 1).alias("r"))
    # what the low-discrepancy draw left short (a few slots per source) comes last
    got = drawn.groupBy("skey").agg(F.count("*").alias("got"))
    short = plan.join(got, "skey", "left").withColumn("got", F.coalesce("got", F.lit(0).cast("long"))) \
        .filter("got < n_slots") \
        .select("skey", F.explode(F.sequence(F.col("got"), F.col("n_slots") - 1)).alias("r")) \
        .select("skey", (F.lit(n_slots) + F.col("r")).alias("slot"), "r")
    s = ranked.unionByName(short).join(
        plan.select("skey", "source_size", "n_blocks", "rest", "n_slots"), "skey").filter("r < n_slots")
    s = s.withColumn("pass", F.expr("r div n_blocks")).withColumn("block", F.col("r") % F.col("n_blocks"))
    length = F.least(F.lit(block).cast("long"), F.col("source_size") - F.col("block") * block)
    last = (F.col("r") == F.col("n_slots") - 1) & (F.col("rest") > 0)
    return s.select("slot", "skey", "pass", "block", length.alias("length"),
                    F.when(last, F.col("rest") - F.col("block") * block).otherwise(length).alias("words"))


def stream_positions(docs: DataFrame) -> DataFrame:
    """Adds ``start``: the document's first word in its source's shuffled stream."""
    parts = docs.groupBy("skey", "part").agg(F.sum("size").alias("n"))
    up_to = Window.partitionBy("skey").orderBy("part")
    parts = parts.select("skey", "part", (F.sum("n").over(up_to) - F.col("n")).alias("base"))
    inside = Window.partitionBy("skey", "part").orderBy("k", "rid").rowsBetween(Window.unboundedPreceding, 0)
    return docs.withColumn("end_in", F.sum("size").over(inside)) \
        .join(parts, ["skey", "part"]) \
        .withColumn("start", F.col("base") + F.col("end_in") - F.col("size")).drop("base", "end_in")


def block_usage(schedule: DataFrame) -> DataFrame:
    """(skey, block, whole, part_words): how often a block is taken whole, and the cut take."""
    cut = F.col("words") < F.col("length")
    return schedule.groupBy("skey", "block").agg(
        F.sum(F.when(cut, 0).otherwise(1)).alias("whole"),
        F.coalesce(F.max(F.when(cut, F.col("words"))), F.lit(0).cast("long")).alias("part_words"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, block: int = BLOCK_WORDS,
                seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, source: words that the mix takes of each document."""
    d = sized(docs, seed)
    targets = materialize(source_targets(d, weights, cap), "mix-targets")
    usage = block_usage(mix_schedule(targets, block))
    pos = stream_positions(d).filter("size > 0")
    pieces = pos.select("rid", "skey", "start", "size", F.explode(F.sequence(
        F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("block"))
    lo = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    hi = F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block))
    words = (hi - lo) * F.col("whole") + F.greatest(F.least(hi, F.col("part_words")) - lo, F.lit(0))
    taken = pieces.join(usage, ["skey", "block"]).groupBy("rid").agg(F.sum(words).alias("taken"))
    return d.join(taken, "rid", "left").join(targets.drop("source"), "skey").select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "source")


def mix_pieces(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, block: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """slot, doc_id, source, first_word, words: the mix itself, as stretches of the documents' words.

    Read in the order of the slots (inside one, of the source's stream), every prefix is near the target
    shares. The pieces of a document add up to its ``taken`` of :func:`mix_sources`.
    """
    d = sized(docs, seed)
    targets = materialize(source_targets(d, weights, cap), "mix-targets")
    schedule = mix_schedule(targets, block).select("skey", "block", "slot", F.col("words").alias("until"))
    pos = stream_positions(d).filter("size > 0")
    pieces = pos.select("rid", "doc_id", "source", "skey", "start", "size", F.explode(F.sequence(
        F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("block"))
    lo = F.greatest(F.col("start") - F.col("block") * block, F.lit(0).cast("long"))
    hi = F.least(F.col("start") + F.col("size") - F.col("block") * block, F.col("until"))
    return pieces.join(schedule, ["skey", "block"]).filter(hi > lo).select(
        "slot", "doc_id", "source", (F.col("block") * block + lo - F.col("start")).alias("first_word"), (hi - lo).alias("words"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, block: int = BLOCK_WORDS,
                    seed: int = SEED) -> DataFrame:
    """The mix as whole documents: each is repeated as often as the block that
    holds its first word is taken (0 times: left out); texts are never cut."""
    d = sized(docs, seed, keep=docs.columns)
    targets = materialize(source_targets(d, weights, cap), "mix-targets")
    usage = block_usage(mix_schedule(targets, block))
    pos = stream_positions(d.select("rid", "skey", "part", "k", "size")).filter("size > 0") \
        .select("rid", "skey", F.expr(f"start div {block}").alias("block"),
                (F.col("start") % block).alias("at"))
    times = pos.join(usage, ["skey", "block"]).select(
        "rid", (F.col("whole") + F.when(F.col("at") < F.col("part_words"), 1).otherwise(0))
        .cast("int").alias("times")).filter("times > 0")
    return d.join(times, "rid").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))) \
        .select(*[F.col(f"keep_{c}").alias(c) for c in docs.columns])


# The same in DuckDB SQL (ids unique), with the weights, block length and seed above.
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS skey,
         CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         substr(md5(concat_ws(chr(10), '{SEED}', CAST(doc_id AS VARCHAR), text)), 1, 16) AS k
  FROM documents),
s1 AS (
  SELECT skey, any_value(source) AS source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY skey),
s2 AS (
  SELECT *, CAST([{', '.join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1)
                 % {len(WEIGHTS)} + 1] AS DOUBLE) AS w, CAST(source_size AS DOUBLE) * {CAP} AS room FROM s1),
s3 AS (
  SELECT *, room / w AS full_at, row_number() OVER (ORDER BY room / w, source NULLS LAST) AS i FROM s2),
s4 AS (
  SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () - (sum(room) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) - room))
            / sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s3),
targets AS (
  SELECT skey, source_size, least(room, w * coalesce(
           (SELECT arg_min(level, i) FROM s4 WHERE level <= full_at), 0)) AS target FROM s4),
p1 AS (
  SELECT skey, source_size, CAST(round(target) AS BIGINT) AS words,
         (source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS} AS n_blocks FROM targets),
p2 AS (
  SELECT *, words % source_size AS rest, (words // source_size) * n_blocks
            + (words % source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS} AS n_slots
  FROM p1 WHERE words > 0 AND source_size > 0),
plan AS (
  SELECT *, CAST(sum(n_slots) OVER (ORDER BY skey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto,
         CAST(sum(n_slots) OVER () AS BIGINT) AS total FROM p2),
points AS (
  SELECT j AS slot, ((CAST(j // {POINT_STEP} AS DOUBLE) * CAST('{math.modf(POINT_STEP * GOLDEN)[0]!r}' AS DOUBLE)) % 1
                     + CAST(j % {POINT_STEP} AS DOUBLE) * CAST('{GOLDEN!r}' AS DOUBLE)) % 1 AS u
  FROM (SELECT unnest(range(0, (SELECT coalesce(max(total), 0) FROM plan))) AS j)),
drawn AS (
  SELECT skey, row_number() OVER (PARTITION BY skey ORDER BY slot) - 1 AS r
  FROM points JOIN plan ON u >= (upto - n_slots) / total AND u < upto / total),
ranks AS (
  SELECT skey, r FROM drawn
  UNION ALL
  SELECT skey, unnest(range(got, n_slots)) FROM (
    SELECT plan.skey, n_slots, count(drawn.r) AS got FROM plan LEFT JOIN drawn USING (skey) GROUP BY ALL)
  WHERE got < n_slots),
slots AS (
  SELECT skey, r % n_blocks AS block, least({BLOCK_WORDS}, source_size - (r % n_blocks) * {BLOCK_WORDS}) AS length,
         CASE WHEN r = n_slots - 1 AND rest > 0 THEN rest - (r % n_blocks) * {BLOCK_WORDS} END AS cut
  FROM ranks JOIN plan USING (skey) WHERE r < n_slots),
usage AS (
  SELECT skey, block, count(*) FILTER (WHERE cut IS NULL OR cut >= length) AS whole,
         coalesce(max(cut) FILTER (WHERE cut < length), 0) AS part FROM slots GROUP BY skey, block),
placed AS (
  SELECT doc_id, skey, size, sum(size) OVER (PARTITION BY skey ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) - size AS start
  FROM d WHERE size > 0),
pieces AS (
  SELECT *, unnest(range(CAST(start // {BLOCK_WORDS} AS BIGINT),
                         CAST((start + size - 1) // {BLOCK_WORDS} + 1 AS BIGINT))) AS block FROM placed),
cuts AS (
  SELECT doc_id, skey, block, greatest(start - block * {BLOCK_WORDS}, 0) AS lo,
         least(start + size - block * {BLOCK_WORDS}, {BLOCK_WORDS}) AS hi FROM pieces),
t AS (
  SELECT doc_id, sum((hi - lo) * whole + greatest(least(hi, part) - lo, 0)) AS taken
  FROM cuts JOIN usage USING (skey, block) GROUP BY doc_id)
SELECT d.doc_id, d.size, s.source_size, s.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken, d.source
FROM d JOIN targets s USING (skey) LEFT JOIN t ON t.doc_id = d.doc_id
"""
