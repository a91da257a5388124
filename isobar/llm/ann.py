"""Approximate nearest neighbours by multiprobe p-stable hashing (operator 9).

Nearness is the largest inner product. Vectors are scaled by the largest norm
and get one more component that makes them unit vectors, queries are normed; the
order by inner product is then the order by Euclidean distance, to which
p-stable hashing applies: a table hashes x by ``floor((a_i . x + b_i) / w)`` for
a few Gaussian ``a_i``.

A query visits perturbed buckets in the order of their estimated success. For a
neighbour at cosine ``c`` the projection ``a . x`` is normal with mean
``c * (a . q)`` and variance ``1 - c^2``, so the chance that it lies in a bucket
is a product of normal masses. Buckets are taken in falling order until their
chances add up to the table's share of the target recall. ``c`` is estimated for
each query from a bounded sample of the table (`SAMPLE_ROWS`, chosen by hash);
where the sample is thin it is an underestimate, which means more probes. Every
row is indexed.

Buckets are split over (vector slice, query slice) cells of bounded size, so a
hot bucket is many cells. Each cell reranks its candidates exactly; the tables'
candidates are merged by one ranking per query.

Defined results: rows with a NULL id, a NULL vector, NULL or non-finite
components or an all-zero vector take no part; shorter vectors count as filled
up with zeros; rows that repeat an id count as one candidate; a query id that
occurs twice is asked once, with the smallest vector; equal scores rank by
smaller id; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ship
from .vectors import clean_vectors, matrix

SAMPLE_ROWS = 4096
TABLES = 2
WIDTH = 2.0
TARGET = 0.95
CELL_VECTORS = 8192
CELL_QUERIES = 4096
EXHAUSTIVE_BELOW = 8     # times k rows: every bucket is probed
_GRID = np.linspace(-9.0, 9.0, 3601)
_MASS = np.array([0.5 * (1 + math.erf(x / math.sqrt(2))) for x in _GRID])


def normal_mass(x: np.ndarray) -> np.ndarray:
    return np.interp(x, _GRID, _MASS)


class Index:
    """The hash functions; fitted on table size, dimension, largest norm and sample."""

    def __init__(self, n: int, dim: int, max_norm: float, sample: np.ndarray, k: int, seed: int = 11):
        self.n, self.dim, self.max_norm, self.k = n, dim, max_norm, k
        self.functions = min(8, max(4, round(math.log2(max(n, 2)) / 4)))
        rng = np.random.default_rng(seed)
        self.a = rng.normal(size=(TABLES, dim + 1, self.functions))
        self.b = rng.uniform(0, WIDTH, size=(TABLES, self.functions))
        self.sample = self.lift(sample)

    def lift(self, m: np.ndarray) -> np.ndarray:
        x = m / self.max_norm
        return np.hstack([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1, keepdims=True)))])

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """One long per row of bucket coordinates (7 bits each)."""
        shift = 7 * np.arange(cells.shape[1], dtype=np.int64)
        return ((np.clip(cells, -64, 63) + 64).astype(np.int64) << shift).sum(axis=1)

    def buckets(self, m: np.ndarray) -> np.ndarray:
        """tables x rows: each row's bucket."""
        x = self.lift(m)
        return np.stack([self.keys(np.floor((x @ self.a[t] + self.b[t]) / WIDTH)) for t in range(TABLES)])

    def cosines(self, q: np.ndarray) -> np.ndarray:
        """Estimated cosine of each query's k-th neighbour, from the sample."""
        s = self.sample
        at = min(len(s) - 1, max(1, round(self.k * len(s) / max(1, self.n))))
        near = -np.partition(-(q @ s[:, :-1].T), at, axis=1)[:, at]
        return np.clip(near, 0.0, 0.9999)

    def probes(self, m: np.ndarray) -> list[list[np.ndarray]]:
        """tables x queries: bucket keys in falling order of estimated success."""
        q = m / np.linalg.norm(m, axis=1, keepdims=True)
        c = self.cosines(q)
        share = 1 - (1 - TARGET) ** (1 / TABLES)
        if self.n <= EXHAUSTIVE_BELOW * self.k:
            c, share = np.zeros(len(q)), 1.0
        out = []
        for t in range(TABLES):
            at = q @ self.a[t][:-1]
            keys = []
            for i in range(len(q)):
                mean, sd = c[i] * at[i] + self.b[t], math.sqrt(1 - c[i] ** 2)
                keys.append(self._enumerate(mean, sd, share))
            out.append(keys)
        return out

    def _enumerate(self, mean: np.ndarray, sd: float, share: float) -> np.ndarray:
        cells, mass = np.zeros((1, 0)), np.ones(1)
        drop = (1 - share) / (50 * len(mean))
        for f in range(len(mean)):
            lo = math.floor((mean[f] - 6 * sd) / WIDTH)
            own = np.arange(lo, math.floor((mean[f] + 6 * sd) / WIDTH) + 1)
            p = normal_mass(((own + 1) * WIDTH - mean[f]) / sd) - normal_mass((own * WIDTH - mean[f]) / sd)
            mass = (mass[:, None] * p[None, :]).ravel()
            cells = np.hstack([np.repeat(cells, len(own), axis=0), np.tile(own, len(cells))[:, None]])
            order = np.argsort(-mass, kind="stable")
            # the least likely combinations, a small part of the missing share in all, are not extended
            keep = order[:int(np.searchsorted(np.cumsum(mass[order]), mass.sum() - drop)) + 1] if drop else order
            cells, mass = cells[keep], mass[keep]
        order = np.argsort(-mass, kind="stable")
        stop = len(order) if share >= 1 else int(np.searchsorted(np.cumsum(mass[order]), share)) + 1
        return self.keys(cells[order[:stop]])


def _rerank(k: int):
    """Exact scores of a cell's candidates; the k best of each query."""
    def run(key, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out_q, out_v, out_s = [], [], []
        if len(vectors) and len(queries):
            dim = max(max(map(len, vectors["v"])), max(map(len, queries["v"])))
            ids = vectors["vec_id"].to_numpy(dtype=np.int64)
            order = np.argsort(ids, kind="stable")
            ids, v = ids[order], matrix(vectors["v"].to_numpy(), dim)[order]
            for at in range(0, len(queries), 256):
                part = queries.iloc[at:at + 256]
                q = matrix(part["v"].to_numpy(), dim)
                rough = q @ v.T
                for i, qid in enumerate(part["vec_id"].to_numpy(dtype=np.int64)):
                    cand = np.flatnonzero(ids != qid)
                    if len(cand) > k:
                        s = rough[i, cand]
                        floor = -np.partition(-s, k - 1)[k - 1]
                        cand = cand[s >= floor - 1e-9 * max(1.0, abs(floor))]
                    score = np.einsum("ij,j->i", v[cand], q[i])
                    # rows that repeat an id are one candidate: its best row
                    best = np.lexsort((-score, ids[cand]))
                    best = best[np.unique(ids[cand][best], return_index=True)[1]]
                    best = best[np.lexsort((ids[cand][best], -score[best]))][:k]
                    out_q.append(np.full(len(best), qid))
                    out_v.append(ids[cand][best])
                    out_s.append(score[best])
        if not out_q:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}) \
                .astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v),
                             "score": np.concatenate(out_s)})
    return run


def nearest(df: DataFrame, is_query: Column, k: int = 20,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest rows found."""
    spark = df.sparkSession
    ship(spark)
    rows = clean_vectors(df, id_col, vec_col).filter(F.exists("v", lambda x: x != 0))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n, dim, biggest = rows.agg(F.count("*"), F.max(F.size("v")), F.max(square)).first()
    schema = "query_id long, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("v").collect()
    index = spark.sparkContext.broadcast(
        Index(n, dim, math.sqrt(biggest) * (1 + 1e-12), matrix([r["v"] for r in sample], dim), k))

    def hashed(it):
        for pdf in it:
            if not len(pdf):
                continue
            b = index.value.buckets(matrix(pdf["v"].to_numpy(), dim))
            for t in range(TABLES):
                yield pd.DataFrame({"t": t, "key": b[t], "vec_id": pdf["vec_id"], "v": pdf["v"]})

    def probed(it):
        for pdf in it:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at:at + 256]
                for t, keys in enumerate(index.value.probes(matrix(part["v"].to_numpy(), dim))):
                    lens = [len(x) for x in keys]
                    rep = np.repeat(np.arange(len(part)), lens)
                    yield pd.DataFrame({"t": t, "key": np.concatenate(keys),
                                        "vec_id": part["vec_id"].to_numpy()[rep],
                                        "v": part["v"].to_numpy()[rep]})
    row = "t int, key long, vec_id long, v array<double>"
    indexed = rows.mapInPandas(hashed, row)
    asked = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    probes = asked.mapInPandas(probed, row)
    # sizes of the buckets that occur and are probed, as (vector slices, query slices)
    slices = indexed.groupBy("t", "key").agg(F.ceil(F.count("*") / CELL_VECTORS).cast("int").alias("nv")).join(
        probes.groupBy("t", "key").agg(F.ceil(F.count("*") / CELL_QUERIES).cast("int").alias("nq")), ["t", "key"])
    v = indexed.join(slices, ["t", "key"]).select(
        "t", "key", F.pmod(F.xxhash64("vec_id"), F.col("nv")).cast("int").alias("vs"),
        F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qs"), "vec_id", "v")
    q = probes.join(slices, ["t", "key"]).select(
        "t", "key", F.explode(F.sequence(F.lit(0), F.col("nv") - 1)).alias("vs"),
        F.pmod(F.xxhash64("vec_id"), F.col("nq")).cast("int").alias("qs"), "vec_id", "v")
    cell = ["t", "key", "vs", "qs"]
    found = v.groupBy(*cell).cogroup(q.groupBy(*cell)).applyInPandas(_rerank(k), schema)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.dense_rank().over(best)).filter(F.col("rank") <= k)
    return ranked.groupBy("query_id", "rank", "vec_id").agg(F.first("score").alias("score")) \
        .select("query_id", "rank", "vec_id", "score")
