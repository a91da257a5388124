"""Hard negatives from lists shared by clusters of anchors (operator 13).

Vectors are integers here. An anchor's positives are its best other rows of the same label
by inner product; its hard negatives, per positive, are the best rows of other labels whose
score lies between two shares of the positive's.

1. Anchors are clustered by direction: spherical k-means, fitted on at most `SAMPLE` anchors,
   assigns every anchor. A cluster's anchors are packed into blocks of about `ANCHOR_BLOCK`.
2. Per block of anchors the candidates are sorted once by an angular upper bound: with the
   anchors' mean direction c and their largest angle t from it, no anchor of norm 1 scores
   above |x| * cos(max(0, angle(x, c) - t)) with the candidate x.
3. Every anchor of the block walks that list, and stops where the bound times its norm falls
   below what it still needs: the last of its best scores, or the lower end of the range.
   From there on no candidate can change its result, which makes it exact.
4. Candidates are dealt evenly to shards; a task holds a group of anchor blocks, streams
   the blocks of a shard past it and carries the anchors' thresholds from block to block.
   The shards' best are merged by a window. Positives are searched first, inside groups of
   labels; negatives against all rows, with the positives' scores known.

Nothing but the sample and counts of groups passes through the driver. The fit decides how
early walks stop, never what they find.

Defined results: rows with a NULL id, NULL label, NULL vector or a NULL or non-finite
component take no part; shorter vectors count as filled up with zeros, an empty or zero
vector scores 0; a row that repeats an anchor's id counts as the anchor's own and is neither
its positive nor its negative, other repeated rows are rows of their own; an anchor id that
occurs twice is asked once, with the smallest label and vector; equal scores rank by smaller
id; a positive of negative score has an empty range; an empty table gives no rows. Scores
are exact while they stay below 2^43. Other columns are ignored. Labels are whole numbers.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from isobar.session import Scratch

from .common import ship
from .vectors import matrix

SAMPLE = 4096
CLUSTERS = 64
ROUNDS = 8
ANCHOR_BLOCK = 512
VECTOR_BLOCK = 4096
CELL_ANCHORS = 1 << 14
CELL_VECTORS = 1 << 18
LABEL_GROUPS = 64
STEP = 256           # candidates of the list looked at between two checks of the bound
SLACK = 1e-6         # radians that rounding may cost an angle
CELL = "g int, s int, a int, kind int, ids binary, labels binary, vecs binary, pids binary, pscores binary, n int"


def directions(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of norm 1 (or 0) and the norms."""
    norm = np.sqrt((m * m).sum(axis=1))
    return m / np.where(norm > 0, norm, 1.0)[:, None], norm


def fit_clusters(m: np.ndarray, k: int, seed: int = 11) -> np.ndarray:
    """Centres of spherical k-means."""
    unit, _ = directions(m)
    rng = np.random.default_rng(seed)
    centres = unit[rng.choice(len(unit), min(k, len(unit)), replace=False)]
    for _ in range(ROUNDS):
        own = np.argmax(unit @ centres.T, axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, own, unit)
        moved, norm = directions(total)
        centres = np.where(norm[:, None] > 0, moved, centres)
    return centres


class Block:
    """Anchors of one cluster; ``best`` keeps k (score, id) per anchor and goal."""

    def __init__(self, ids, labels, m, goals: int, k: int):
        self.ids, self.labels, self.m, self.k = ids, labels, m, k
        unit, self.norm = directions(m)
        mean = unit.sum(axis=0)
        length = math.sqrt(float(mean @ mean))
        self.centre = mean / length if length > 0 else mean
        self.spread = float(np.arccos(np.clip(unit @ self.centre, -1, 1)).max()) if len(ids) else 0.0
        self.score = np.full((len(ids), goals, k), -np.inf)
        self.found = np.zeros((len(ids), goals, k), np.int64)

    def shared_list(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of the candidates by falling upper bound, and the bounds in that order."""
        unit, norm = directions(m)
        angle = np.arccos(np.clip(unit @ self.centre, -1, 1)) - self.spread - SLACK
        bound = norm * np.cos(np.maximum(angle, 0.0))
        order = np.argsort(-bound, kind="stable")
        # rounding of the product itself
        return order, bound[order] + 1e-9 * (1 + norm.max(initial=0.0))

    def keep(self, at: np.ndarray, goal: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Best k of what the anchors ``at`` have and of ``scores``, whose columns are in the order of their ids."""
        better = np.flatnonzero(scores.max(axis=1) >= self.score[at, goal, -1])
        better = better[scores[better].max(axis=1) > -np.inf]
        if not len(better):
            return
        at, scores = at[better], scores[better]
        width = scores.shape[1]
        # distinct keys, so that a partition settles ties by id
        key = scores * width - np.arange(width)
        top = np.argpartition(-key, min(self.k, width) - 1, axis=1)[:, :self.k]
        s = np.concatenate([self.score[at, goal], np.take_along_axis(scores, top, axis=1)], axis=1)
        i = np.concatenate([self.found[at, goal], ids[top]], axis=1)
        order = np.lexsort((i, -s), axis=1)[:, :self.k]
        self.score[at, goal] = np.take_along_axis(s, order, axis=1)
        self.found[at, goal] = np.take_along_axis(i, order, axis=1)

    def walk(self, ids: np.ndarray, labels: np.ndarray, m: np.ndarray) -> int:
        """Walk the shared list of a block of candidates; returns how many scores were computed."""
        order, bound = self.shared_list(m)
        done = 0
        for lo in range(0, len(order), STEP):
            # certified termination: nothing from here on reaches what the anchor needs
            at = np.flatnonzero(self.norm * bound[lo] >= self.needed())
            if not len(at):
                break
            part = order[lo:lo + STEP]
            part = part[np.argsort(ids[part], kind="stable")]
            scores = self.m[at] @ m[part].T
            done += scores.size
            self.take(at, scores, ids[part], self.labels[at][:, None] == labels[part], ids[part] == self.ids[at][:, None])
        return done

    def rows(self):
        at, goal, place = np.nonzero(self.score > -np.inf)
        return at, goal, self.found[at, goal, place], self.score[at, goal, place]


class Positives(Block):
    """The best rows of the anchor's own label."""

    def __init__(self, ids, labels, m, k):
        super().__init__(ids, labels, m, 1, k)

    def needed(self):
        return self.score[:, 0, -1]

    def take(self, at, scores, ids, same_label, own):
        self.keep(at, 0, np.where(same_label & ~own, scores, -np.inf), ids)

    def frame(self):
        at, _, found, score = self.rows()
        return pd.DataFrame({"anchor_id": self.ids[at], "positive_rank": 0, "positive_id": 0, "positive_score": 0.0,
                             "vec_id": found, "score": score})


class Negatives(Block):
    """Per positive, the best rows of other labels within the shares of its score."""

    def __init__(self, ids, labels, m, k, pids, pscores, low, high):
        super().__init__(ids, labels, m, pids.shape[1], k)
        self.pids, self.pscores, self.low, self.high = pids, pscores, low, high

    def needed(self):
        # without k finds yet, the lower end of the range; no positive or an empty range: nothing
        floor = np.maximum(self.score[:, :, -1], np.where(np.isnan(self.pscores), np.inf, self.low * self.pscores / 100))
        return np.where(self.pscores >= 0, floor, np.inf).min(axis=1, initial=np.inf)

    def take(self, at, scores, ids, same_label, own):
        scores = np.where(same_label | own, np.nan, scores)
        for goal in range(self.pids.shape[1]):
            p = self.pscores[at, goal][:, None]
            inside = (100 * scores >= self.low * p) & (100 * scores <= self.high * p)
            self.keep(at, goal, np.where(inside, scores, -np.inf), ids)

    def frame(self):
        at, goal, found, score = self.rows()
        return pd.DataFrame({"anchor_id": self.ids[at], "positive_rank": goal + 1, "positive_id": self.pids[at, goal],
                             "positive_score": self.pscores[at, goal], "vec_id": found, "score": score})


def _search(make):
    """Per cell: hold the anchor blocks, stream the candidate blocks past them."""
    def run(it):
        cell, held = None, []
        for pdf in it:
            for g, s, a, kind, ids, labels, vecs, pids, pscores, n in pdf.itertuples(index=False, name=None):
                if (g, s, a) != cell:
                    for b in held:
                        yield b.frame()
                    cell, held = (g, s, a), []
                ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
                m = np.frombuffer(vecs, np.float64).reshape(n, -1)
                if kind == 0:
                    held.append(make(ids, labels, m, np.frombuffer(pids, np.int64).reshape(n, -1),
                                     np.frombuffer(pscores, np.float64).reshape(n, -1)))
                else:
                    for b in held:
                        b.walk(ids, labels, m)
        for b in held:
            yield b.frame()
    return run


def _packed(rows: DataFrame, key: list[str], dim: int, scale: int, goals: int) -> DataFrame:
    """One row per key with the rows' ids, labels, integer vectors and positives as bytes."""
    def pack(k, pdf):
        pdf = pdf.sort_values("vec_id", kind="stable")
        n = len(pdf)
        pids, pscores = np.zeros((n, goals), np.int64), np.full((n, goals), np.nan)
        for i, (x, y) in enumerate(zip(pdf["pids"], pdf["pscores"])):
            if x is not None:
                pids[i, :len(x)], pscores[i, :len(y)] = x, y
        return pd.DataFrame([[*k, pdf["vec_id"].to_numpy(np.int64).tobytes(), pdf["label"].to_numpy(np.int64).tobytes(),
                              np.floor(scale * matrix(pdf["v"].to_numpy(), max(1, dim))).tobytes(),
                              pids.tobytes(), pscores.tobytes(), n]])
    for c in ("pids", "pscores"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("array<long>" if c == "pids" else "array<double>"))
    return rows.groupBy(*key).applyInPandas(
        pack, ", ".join(f"{c} int" for c in key) + ", ids binary, labels binary, vecs binary, pids binary, pscores binary, n int")


def _dealt(rows: DataFrame, by: list[str], size: int) -> DataFrame:
    """``rows`` with blk: about ``size`` rows of each group ``by`` to a block, and blocks, their number."""
    counts = rows.groupBy(*by).agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    return rows.join(counts, by).withColumn("blk", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))


def _cells(anchors: DataFrame, rows: DataFrame, dim: int, scale: int, goals: int, work, least_shards: int) -> DataFrame:
    """Meet anchors (g, c, ...) and candidates (g, ...) of the same g in cells and search them."""
    per_cell = CELL_ANCHORS // ANCHOR_BLOCK
    q = _packed(_dealt(anchors, ["g", "c"], ANCHOR_BLOCK), ["g", "c", "blk"], dim, scale, goals)
    v = _packed(_dealt(rows, ["g"], VECTOR_BLOCK), ["g", "blk"], dim, scale, 0)
    # shards of candidates and groups of anchor blocks in each g: counts only
    shards = rows.groupBy("g").agg(F.greatest(F.lit(least_shards), F.ceil(F.count("*") / CELL_VECTORS)).cast("int").alias("shards"))
    sides = anchors.groupBy("g", "c").agg(F.ceil(F.count("*") / ANCHOR_BLOCK).alias("b")) \
        .groupBy("g").agg(F.ceil(F.sum("b") / per_cell).cast("int").alias("sides")).join(shards, "g")
    body = ["ids", "labels", "vecs", "pids", "pscores", "n"]
    q = q.join(sides, "g").select("g", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("s"),
                                  F.pmod(F.xxhash64("c", "blk"), "sides").cast("int").alias("a"), F.lit(0).alias("kind"), *body)
    v = v.join(sides, "g").select("g", F.pmod("blk", "shards").cast("int").alias("s"),
                                  F.explode(F.sequence(F.lit(0), F.col("sides") - 1)).alias("a"), F.lit(1).alias("kind"), *body)
    cells = q.unionByName(v).select(*[f.split()[0] for f in CELL.split(", ")])
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.repartition(n, "g", "s", "a").sortWithinPartitions("g", "s", "a", "kind").mapInPandas(
        _search(work), "anchor_id long, positive_rank int, positive_id long, positive_score double, vec_id long, score double")


def _rows(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v) of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & finite) \
        .select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), v.alias("v"))


def hard_negatives(df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   clusters: int = CLUSTERS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank.

    ``is_anchor`` is a condition on ``vec_id``; ``low`` and ``high`` are percentages.
    """
    spark = df.sparkSession
    ship(spark)
    with Scratch(spark) as scratch:
        rows = _rows(df, id_col, vec_col, label_col)
        rows = scratch.table(rows.withColumn("rid", F.monotonically_increasing_id()), "negatives-rows")
        asked = rows.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v", "rid")).alias("r")) \
            .select("vec_id", "r.label", "r.v", "r.rid")
        dim = rows.agg(F.max(F.size("v"))).first()[0] or 0
        sample = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
        centres = fit_clusters(np.floor(scale * matrix([r["v"] for r in sample], max(1, dim))), clusters) if sample \
            else np.zeros((1, max(1, dim)))

        @F.pandas_udf("int")
        def cluster(v: pd.Series) -> pd.Series:
            unit, _ = directions(np.floor(scale * matrix(v.to_numpy(), max(1, dim))))
            return pd.Series(np.argmax(unit @ centres.T, axis=1).astype(np.int32))
        asked = scratch.table(asked.withColumn("c", cluster("v")), "negatives-anchors")
        group = F.pmod(F.xxhash64("label"), F.lit(LABEL_GROUPS)).cast("int")
        cores = spark.sparkContext.defaultParallelism

        def find_positives(ids, labels, m, pids, pscores):
            return Positives(ids, labels, m, positives)

        def find_negatives(ids, labels, m, pids, pscores):
            return Negatives(ids, labels, m, negatives, pids, pscores, low, high)
        best = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
        near = _cells(asked.withColumn("g", group), rows.withColumn("g", group), dim, scale, 0, find_positives, 1) \
            .withColumn("r", F.row_number().over(best)).filter(F.col("r") <= positives)
        near = scratch.table(near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("p"))
                             .select(F.col("anchor_id").alias("vec_id"), F.col("p.vec_id").alias("pids"),
                                     F.col("p.score").alias("pscores")), "negatives-positives")
        # one group; not a literal, which would turn the joins by group into nested loops
        whole = F.pmod("rid", F.lit(1)).cast("int")
        found = _cells(asked.join(near, "vec_id").withColumn("g", whole), rows.withColumn("g", whole),
                       dim, scale, positives, find_negatives, 2 * cores)
        # the result is read by the caller and stays
        found = Scratch(spark).table(found, "negatives")
    best = Window.partitionBy("anchor_id", "positive_rank").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        F.col("positive_score").cast("long").alias("positive_score"), F.col("score").cast("long").alias("negative_score"),
        "positive_rank")


# The same in DuckDB SQL, with the query's parameters.
ORACLE = """
WITH r AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, a.label = x.label AS same, x.vec_id, CAST(list_inner_product(a.v, x.v) AS BIGINT) AS score
  FROM r a JOIN r x ON a.vec_id % 50 = 0 AND a.vec_id <> x.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS positive_rank
  FROM pairs WHERE same),
found AS (
  SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 100 * n.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score
  WHERE p.positive_rank <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score,
       CAST(positive_rank AS INTEGER) AS positive_rank
FROM found WHERE rank <= 3
"""
