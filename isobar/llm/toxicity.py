"""Toxicity scores by weak supervision (operator 2).

1. Voters. Words and word prefixes (patterns for inflected forms) that the
   labelled rows of the learning folds connect with toxicity; a prefix also counts as a pattern
   of its own where two different words share it. A voter votes on a text in
   which it occurs, else it abstains.
2. Label model. A generative model of the votes given the hidden class: each
   voter's rate in either class (its accuracy) and, along the tree of the
   strongest dependencies, the rate given its parent's vote (correlations, so
   that a word and its own prefix do not count twice). It starts from the
   labelled rows and is fitted by EM to the vote patterns of all documents; the
   pattern counts and the expected pair counts are aggregated by Spark, only the
   parameters (voters squared) reach the driver.
3. Classifier. A logistic regression on all selected words and prefixes, trained
   on the label model's posteriors instead of labels, scores every whole text.

`FIT_ROWS` bounds the labelled rows (those with the smallest id hash of the
learning folds) that choose features and train the classifier; the label model's
statistics cover all documents.

Defined results: ids whose crc32 (of the id as text) is divisible by 5 are held
out, a NULL id is not and has no label; a label that is NULL or not 0/1 is no
label, of several the largest counts; a NULL text scores like an empty one;
without toxic labels every score is 0; repeated rows score alike; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from isobar.session import materialize

from .common import ship

FIT_ROWS = 20_000
FEATURES = 2_000
VOTERS = 64
MIN_DOCS = 5              # labelled toxic texts in which a feature occurs at least
MIN_SHARE = 0.3           # of its labelled texts that are toxic
PREFIXES = (4, 5, 6, 7)
EM_ROUNDS = 4
SMOOTH = 0.5
MEMO = 1 << 17
_WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def names_of(word: str) -> list[str]:
    """The feature names of a word: itself, and its prefixes marked by '*'."""
    return [word] + [word[:n] + "*" for n in PREFIXES if len(word) > n]


def features_of(text: str) -> set[str]:
    """All feature names of a text; '**' marks prefixes of two different words or more."""
    seen: set[str] = set()
    for w in set(_WORD.findall(text.lower())):
        for x in names_of(w):
            seen.add(x + "*" if x in seen else x)
    return seen


class Matcher:
    """Numbers of the selected features that occur in a text."""

    def __init__(self, features: list[str]):
        self.number = {f: i for i, f in enumerate(features)}
        # a prefix can be selected for its repeats alone
        self.wanted = {f[:-1] if f.endswith("**") else f for f in features}
        self.memo: dict[str, tuple[str, ...]] = {}

    def hits(self, text: str) -> list[int]:
        memo, found = self.memo, set()
        for w in set(_WORD.findall(text.lower())):
            got = memo.get(w)
            if got is None:
                got = tuple(x for x in names_of(w) if x in self.wanted)
                if len(memo) < MEMO:
                    memo[w] = got
            for x in got:
                found.add(x + "*" if x in found else x)
        return sorted(self.number[x] for x in found if x in self.number)


@dataclass
class LabelModel:
    """Rates of the votes in both classes, along a dependency tree."""
    prior: float
    parent: np.ndarray                       # -1: root
    rate: np.ndarray                         # 2 x voters x 2: P(vote | class, parent's vote)
    accuracy: np.ndarray = field(default=None)      # P(toxic | vote)
    correlation: np.ndarray = field(default=None)   # of the votes within the classes

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        v = votes.astype(np.int64)
        up = np.where(self.parent[None, :] >= 0, v[:, np.maximum(self.parent, 0)], 0)
        log = [np.full(len(v), math.log(1 - self.prior)), np.full(len(v), math.log(self.prior))]
        at = np.arange(v.shape[1])
        for c in (0, 1):
            p = self.rate[c][at[None, :], up]
            log[c] += np.log(np.where(v == 1, p, 1 - p)).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit_step(total: np.ndarray, pairs: np.ndarray, parent: np.ndarray | None) -> LabelModel:
    """Parameters from class weights and expected pair counts (2 x voters x voters)."""
    n = pairs.shape[1]
    single = np.stack([np.diag(pairs[c]) for c in (0, 1)])
    weight = np.maximum(total, 1e-9)[:, None]
    rate1 = (single + SMOOTH * 0.01) / (weight + SMOOTH)
    cov = sum(pairs[c] - np.outer(single[c], single[c]) / weight[c] for c in (0, 1))
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    corr = cov / np.outer(sd, sd)
    if parent is None:
        # maximum spanning tree of the dependencies; weak ones stay roots
        parent, reach = np.full(n, -1), np.full(n, 0.1)
        left = set(range(n))
        while left:
            j = max(left, key=lambda x: (reach[x], -x))
            left.discard(j)
            for k in left:
                if corr[j, k] > reach[k]:
                    reach[k], parent[k] = corr[j, k], j
    rate = np.empty((2, n, 2))
    for c in (0, 1):
        for j in range(n):
            k = parent[j]
            if k < 0:
                rate[c, j] = rate1[c, j]
                continue
            on, off = single[c, k], total[c] - single[c, k]
            rate[c, j, 1] = (pairs[c, j, k] + SMOOTH * rate1[c, j] * 4) / (on + SMOOTH * 4)
            rate[c, j, 0] = (single[c, j] - pairs[c, j, k] + SMOOTH * rate1[c, j] * 4) / (off + SMOOTH * 4)
    rate = np.clip(rate, 1e-6, 1 - 1e-6)
    prior = float(np.clip(total[1] / max(total.sum(), 1e-9), 1e-4, 1 - 1e-4))
    model = LabelModel(prior, parent, rate, single[1] / np.maximum(single.sum(axis=0), 1e-9), corr)
    return model


def bit_rows(patterns: np.ndarray, voters: int) -> np.ndarray:
    p = patterns.astype(np.int64).view(np.uint64)
    return ((p[:, None] >> np.arange(voters, dtype=np.uint64)[None, :]) & np.uint64(1)).astype(np.int8)


def expected_pairs(patterns: DataFrame, model: LabelModel, voters: int) -> tuple[np.ndarray, np.ndarray]:
    """E-step over the pattern table: class weights and expected pair counts."""
    b = patterns.sparkSession.sparkContext.broadcast(model)

    def run(it):
        total, pairs = np.zeros(2), np.zeros((2, voters, voters))
        for pdf in it:
            if len(pdf):
                v = bit_rows(pdf["votes"].to_numpy(), voters)
                p, n = b.value.posterior(v), pdf["n"].to_numpy(dtype=np.float64)
                for c, w in ((0, n * (1 - p)), (1, n * p)):
                    total[c] += w.sum()
                    pairs[c] += (v * w[:, None]).T @ v
        c, i, j = np.nonzero(pairs)
        yield pd.DataFrame({"c": np.append(c, [0, 1]), "i": np.append(i, [-1, -1]), "j": np.append(j, [-1, -1]),
                            "x": np.append(pairs[c, i, j], total)})
    total, pairs = np.zeros(2), np.zeros((2, voters, voters))
    for r in patterns.mapInPandas(run, "c int, i int, j int, x double") \
            .groupBy("c", "i", "j").agg(F.sum("x").alias("x")).collect():
        if r["i"] < 0:
            total[r["c"]] = r["x"]
        else:
            pairs[r["c"], r["i"], r["j"]] = r["x"]
    return total, pairs


@dataclass
class ToxicityModel:
    features: list[str]
    weights: np.ndarray
    bias: float
    voters: list[int]
    labels: LabelModel | None


def logistic(hits: list[np.ndarray], target: np.ndarray, n_features: int,
             l2: float = 1e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse presence features and soft targets (Adam)."""
    row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    col = np.concatenate(hits).astype(np.int64) if len(row) else np.empty(0, np.int64)
    w, b = np.zeros(n_features), 0.0
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        z = np.bincount(row, w[col], minlength=len(hits)) + b
        err = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - target
        g = np.append(np.bincount(col, err[row], minlength=n_features) / len(hits) + l2 * w, err.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def choose_voters(hits: list[np.ndarray], y: np.ndarray, n_features: int, n_voters: int) -> list[int]:
    """Features picked one after the other so that they cover all kinds of toxic texts:
    a text counts less the more of the picked voters vote on it."""
    row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    col = np.concatenate(hits).astype(np.int64)
    clean = np.bincount(col, (y[row] == 0).astype(float), minlength=n_features)
    weight, out = (y == 1).astype(float), []
    rows_of = np.split(row[np.argsort(col, kind="stable")], np.cumsum(np.bincount(col, minlength=n_features))[:-1])
    while len(out) < min(n_voters, n_features):
        gain = np.bincount(col, weight[row], minlength=n_features) - 0.2 * clean * weight.mean() / y.mean()
        gain[out] = -np.inf
        best = int(np.argmax(gain))
        out.append(best)
        weight[rows_of[best]] *= 0.4
    return out


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, n_voters: int = VOTERS) -> ToxicityModel:
    ship(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    lab = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chosen = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    sample = materialize(texts.join(chosen, "doc_id"), "toxicity-sample")

    def count(it):
        seen: dict[str, list[int]] = {}
        for pdf in it:
            for t, y in zip(pdf["text"], pdf["y"]):
                for f in features_of(t):
                    seen.setdefault(f, [0, 0])[y] += 1
            if len(seen) > 500_000:
                yield pd.DataFrame([(f, a, b) for f, (a, b) in seen.items()], columns=["f", "a", "b"])
                seen = {}
        yield pd.DataFrame([(f, a, b) for f, (a, b) in seen.items()], columns=["f", "a", "b"])
    counts = sample.select("text", "y").mapInPandas(count, "f string, a long, b long") \
        .groupBy("f").agg(F.sum("a").alias("clean"), F.sum("b").alias("toxic"))
    n0, n1 = sample.agg(F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1)).first()
    gain = F.col("toxic") * F.log((F.col("toxic") + 0.5) / (n1 + 1.0) / ((F.col("clean") + 0.5) / (n0 + 1.0)))
    picked = counts.filter((F.col("toxic") >= MIN_DOCS)
                           & (F.col("toxic") >= MIN_SHARE * (F.col("toxic") + F.col("clean")))
                           & (gain > 2 * F.col("toxic"))) \
        .withColumn("gain", gain).orderBy(F.col("gain").desc(), "f").limit(FEATURES).collect()
    features = [r["f"] for r in picked]
    if not features:
        return ToxicityModel([], np.zeros(0), 0.0, [], None)
    names = sc.broadcast(features)

    def matched(it):
        m = Matcher(names.value)
        for pdf in it:
            yield pd.DataFrame({"y": pdf["y"], "hits": [np.array(m.hits(t), np.int32) for t in pdf["text"]]})
    rows = sample.select("text", "y").mapInPandas(matched, "y int, hits array<int>").collect()
    hits = [np.array(r["hits"], np.int64) for r in rows]
    y = np.array([r["y"] for r in rows])
    voters = choose_voters(hits, y, len(features), n_voters)
    at = np.full(len(features), -1)
    at[voters] = np.arange(len(voters))
    votes = np.zeros((len(rows), len(voters)), np.int8)
    for i, h in enumerate(hits):
        votes[i, at[h][at[h] >= 0]] = 1
    asked = [features[i] for i in voters]

    def vote(it):
        m, n = Matcher(asked), {}
        for pdf in it:
            for t in pdf["text"]:
                key = 0
                for i in m.hits(t):
                    key |= 1 << i
                n[key] = n.get(key, 0) + 1
            if len(n) > 200_000:
                yield as_rows(n)
                n = {}
        yield as_rows(n)

    def as_rows(n):
        return pd.DataFrame({"votes": np.array(list(n), dtype=np.uint64).view(np.int64),
                             "n": np.array(list(n.values()), dtype=np.int64)})
    patterns = materialize(texts.select("text").mapInPandas(vote, "votes long, n long")
                           .groupBy("votes").agg(F.sum("n").alias("n")), "vote-patterns")

    total = np.array([(y == 0).sum(), (y == 1).sum()], np.float64)
    pairs = np.stack([(votes[y == c].astype(np.float64)).T @ votes[y == c] for c in (0, 1)])
    model = fit_step(total, pairs, None)
    for _ in range(EM_ROUNDS):
        model = fit_step(*expected_pairs(patterns, model, len(voters)), model.parent)
    weights, bias = logistic(hits, model.posterior(votes), len(features))
    return ToxicityModel(features, weights, bias, voters, model)


def score_column(spark, model: ToxicityModel):
    """UDF: the probability that a text is toxic."""
    b = spark.sparkContext.broadcast((model.features, model.weights, model.bias))

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        features, w, bias = b.value
        if not features:
            return pd.Series(np.zeros(len(text)))
        m = Matcher(features)
        z = np.array([bias + float(w[h].sum()) if (h := m.hits(t)) else bias for t in text], dtype=np.float64)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -700, 700))))
    return score


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    score = score_column(docs.sparkSession, fit(docs, labels, fit_rows))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       score(F.coalesce("text", F.lit(""))).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    score = score_column(docs.sparkSession, fit(docs, labels))
    return docs.filter(score(F.coalesce("text", F.lit(""))) < 0.5)
