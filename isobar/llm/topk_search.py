"""Exact top-k search by MaxScore over sharded postings (operator 3).

Documents are integer vectors; a query's terms are its non-zero components. The
postings of a term are the documents whose component has the query's sign, so
only postings add to a score and ``|q| * max |component|`` bounds what a term
can add. Per shard block the terms are ordered by that bound. The non-essential
terms are the longest run of smallest bounds whose sum stays below the k-th best
score so far: a document in none of the other (essential) postings cannot
compete. The essential postings are traversed first; the other terms are probed
in falling order of bound, for the documents only whose score can still reach
the k-th best. Blocks of one query group are visited one after the other, so the
threshold carries over; the shards' best k are merged in the end.

Queries and vectors meet in cells of a grid (a group of query blocks and a group
of vector blocks); a task holds one group of query blocks and streams vector
blocks past it, so memory is bounded by the two block sizes.

Defined results: rows with a NULL id, a NULL vector or a NULL or non-finite
component take no part; shorter vectors count as filled up with zeros, an empty
vector scores 0; rows that repeat a query's id count as the query's own and are
not its candidates, other repeated rows are candidates of their own; a query id
that occurs twice is asked once, with the smallest vector; equal scores rank by
smaller id; an empty table gives no rows. Scores are exact while they stay below
2^53. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ship
from .vectors import clean_vectors, pack, unpack

VECTOR_BLOCK = 2048
QUERY_BLOCK = 512
CELL_VECTORS = 1 << 18
CELL_QUERIES = 1 << 14
PROBE_TERMS = 8          # terms probed between two prunings


class Best:
    """The k best (score, id) of each query of a block."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.found = [(np.empty(0), np.empty(0, np.int64)) for _ in ids]
        self.floor = np.full(len(ids), -np.inf)

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, d = np.concatenate([self.found[i][0], scores]), np.concatenate([self.found[i][1], ids])
        keep = np.lexsort((d, -s))[:self.k]
        self.found[i] = s[keep], d[keep]
        if len(keep) == self.k:
            self.floor[i] = self.found[i][0][-1]

    def rows(self) -> pd.DataFrame:
        n = [len(s) for s, _ in self.found]
        return pd.DataFrame({"query_id": np.repeat(self.ids, n),
                             "vec_id": np.concatenate([d for _, d in self.found]).astype(np.int64),
                             "score": np.concatenate([s for s, _ in self.found])})


def maxscore(best: Best, ids: np.ndarray, docs: np.ndarray) -> None:
    """Score one block of documents for every query of a block."""
    by_term = np.ascontiguousarray(docs.T)
    top, low = docs.max(axis=0), docs.min(axis=0)
    for i, q in enumerate(best.q):
        floor = best.floor[i]
        bound = np.maximum(np.maximum(q * top, q * low), 0.0)
        terms = np.argsort(bound, kind="stable")
        reach = np.cumsum(bound[terms])
        cut = int(np.searchsorted(reach, floor, side="left"))  # so many terms cannot reach the floor alone
        essential, others = terms[cut:], terms[:cut]
        if not len(essential):
            if floor > 0 or not len(terms):
                continue
        listed = np.zeros(len(ids), dtype=bool) if cut else np.ones(len(ids), dtype=bool)
        score = np.zeros(len(ids))
        for t in essential:
            add = q[t] * by_term[t]
            score += add
            if cut:
                listed |= add > 0
        at = np.flatnonzero(listed & (ids != best.ids[i]))
        score = score[at]
        left = cut
        while True:
            rest = reach[left - 1] if left else 0.0
            alive = score + rest >= floor
            at, score = at[alive], score[alive]
            if not left or not len(at):
                break
            probe = others[max(0, left - PROBE_TERMS):left]
            left = max(0, left - PROBE_TERMS)
            score = score + q[probe] @ by_term[probe][:, at]
        if len(at):
            best.add(i, score, ids[at])


def search_cells(blocks, k: int, score):
    """Per cell: keep the query blocks, stream the vector blocks past them."""
    cell, held = None, []
    for pdf in blocks:
        for vg, qg, kind, ids, vecs, n in zip(pdf["vg"], pdf["qg"], pdf["kind"], pdf["ids"], pdf["vecs"], pdf["n"]):
            if (vg, qg) != cell:
                for b in held:
                    yield b.rows()
                cell, held = (vg, qg), []
            i, m = unpack(ids, vecs, n)
            if kind == 0:
                held.append(Best(i, m, k))
            else:
                for b in held:
                    score(b, i, m)
    for b in held:
        yield b.rows()


def blocks_of(df: DataFrame, n_blocks: int, dim: int, transform=None) -> DataFrame:
    """(blk, ids, vecs, n): rows dealt evenly over blocks, whatever their ids."""
    def packed(key, pdf):
        ids, vecs, n = pack(pdf, dim, transform)
        return pd.DataFrame({"blk": [key[0]], "ids": [ids], "vecs": [vecs], "n": [n]})
    spread = F.pmod(F.monotonically_increasing_id() * F.lit(7919) + F.spark_partition_id(),
                    F.lit(n_blocks)).cast("long")
    return df.withColumn("blk", spread).groupBy("blk") \
        .applyInPandas(packed, "blk long, ids binary, vecs binary, n int")


def floor_1024(m: np.ndarray) -> np.ndarray:
    return np.floor(m * 1024.0)


def top_k(df: DataFrame, is_query: Column, k: int = 10, transform=floor_1024,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows by inner product."""
    spark = df.sparkSession
    ship(spark)
    rows = clean_vectors(df, id_col, vec_col)
    n, n_q, dim = rows.agg(F.count("*"), F.count_if(is_query), F.max(F.size("v"))).first()
    dim, cores = dim or 0, spark.sparkContext.defaultParallelism
    asked = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    vg = max(2 * cores, math.ceil(n / CELL_VECTORS))
    qg = max(1, math.ceil(n_q / CELL_QUERIES))
    q = blocks_of(asked, max(1, math.ceil(n_q / QUERY_BLOCK)), dim, transform) \
        .select(F.explode(F.sequence(F.lit(0), F.lit(vg - 1))).alias("vg"),
                (F.col("blk") % qg).cast("int").alias("qg"), F.lit(0).alias("kind"), "ids", "vecs", "n")
    v = blocks_of(rows, max(vg, math.ceil(n / VECTOR_BLOCK)), dim, transform) \
        .select((F.col("blk") % vg).cast("int").alias("vg"),
                F.explode(F.sequence(F.lit(0), F.lit(qg - 1))).alias("qg"), F.lit(1).alias("kind"),
                "ids", "vecs", "n")
    found = q.unionByName(v).repartition(vg * qg, "vg", "qg").sortWithinPartitions("vg", "qg", "kind") \
        .mapInPandas(lambda it: search_cells(it, k, maxscore), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))
