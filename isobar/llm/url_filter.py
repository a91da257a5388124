"""URL filter by a Bloom filter cascade (operator 4).

A url is judged by the keys it can match: host suffixes combined with path
prefixes of the shapes (number of labels, path length) that the rules have. The
complete key universe of the corpus is known, so a cascade of Bloom filters is
exact on it: level 1 encodes the listed keys, level 2 the universe keys that
pass level 1 wrongly, level 3 the listed keys that pass level 2, and so on until
nothing passes wrongly. One cascade tells listed from unlisted keys, a second
one blocked from allowed keys among the listed. Applying them needs no join and
no shuffle: each row's keys are tested against the filter bits.

The first level's false positive rate is chosen so that its false positives are
about as many as the listed keys; so every level is in proportion to the list,
never to the corpus. The bits of one pass are at most ``max_bytes``; longer
lists are split by key hash into shards, tested in one pass each.

Defined results: NULL urls and urls without ``://`` have an empty host and path
and match no rule; only A-Z is lower-cased; repeated rows are judged alike; an
empty table gives no rows; an empty rule list allows everything; repeated rules count
once, and a key listed both as block and allow is blocked; rules without a host
or path match nothing, other verdicts raise; urls of any length are judged whole;
two rules that fit with equal length are one key; columns other than the id and
url are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from isobar.session import materialize

from .common import ship

MAX_FILTER_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LATER_RATE = 0.5


@dataclass
class Level:
    bits: np.ndarray   # uint64 words
    m: int             # number of bits
    k: int             # hash functions
    seed: int

    def passes(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        ok = np.ones(len(k1), dtype=bool)
        for pos in positions(k1, k2, self.m, self.k, self.seed):
            ok &= (self.bits[pos >> np.uint64(6)] >> (pos & np.uint64(63))) & np.uint64(1) == 1
        return ok


def positions(k1, k2, m: int, k: int, seed: int):
    """The k bit positions of each key (double hashing after a level-specific mix)."""
    a, b = k1.astype(np.uint64), k2.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = a ^ np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        step = (b ^ x) | np.uint64(1)
        for i in range(k):
            yield (x + np.uint64(i) * step) % np.uint64(m)


def member(levels: list[Level], k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Exact membership of universe keys: the first level that a key fails decides."""
    undecided = np.arange(len(k1))
    out = np.zeros(len(k1), dtype=bool)
    for i, level in enumerate(levels):
        ok = level.passes(k1[undecided], k2[undecided])
        out[undecided[~ok]] = i % 2 == 1
        undecided = undecided[ok]
    out[undecided] = len(levels) % 2 == 1
    return out


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    u = F.coalesce(F.col(url), F.lit(""))
    return df.withColumn("host", F.translate(F.regexp_extract(u, URL_PARTS, 1), UPPER, LOWER)) \
             .withColumn("path", F.regexp_extract(u, URL_PARTS, 2))


def listed_keys(spark, rules: list[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """(key, blocked, labels, length), one row per key: repeated rules are one, and a key that is
    listed both ways is blocked. Rules without a host or a path are left out."""
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")
    rules = rules.select(*[F.col(c).cast("string").alias(c) for c in ("verdict", "host", "path")])
    known = F.col("verdict").isin("allow", "block")
    blocked = F.when(known, F.col("verdict") == "block").otherwise(
        F.raise_error(F.concat(F.lit("verdict is neither allow nor block: "), F.coalesce("verdict", F.lit("NULL")))))
    return rules.filter("host IS NOT NULL AND path IS NOT NULL").groupBy(F.concat("host", "path").alias("key")).agg(
        F.max(blocked).alias("blocked"), F.min(F.size(F.split("host", r"\."))).alias("labels"), F.min(F.length("path")).alias("length"))


def key_array(shapes: list[tuple[int, int]]):
    """Column: the keys of a row that could be listed, longest first; ``shapes``: the rules' numbers of
    labels and path lengths."""
    if not shapes:
        return F.array().cast("array<string>")
    # a suffix of n labels exists only where the host has as many
    keys = [F.when((F.size(F.split("host", r"\.")) >= n) & (F.length("path") >= m),
                   F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, m)))
            for n, m in shapes]
    return F.reverse(F.array_sort(F.array_compact(F.array(*keys)),
                                  lambda a, b: F.when(F.length(a) != F.length(b), F.length(a) - F.length(b))
                                  .otherwise(F.when(a < b, -1).when(a > b, 1).otherwise(0))))


def _bits(keys: DataFrame, m: int, k: int, seed: int) -> np.ndarray:
    """Bit words of the keys' positions; only the words reach the driver."""
    def words(it):
        for pdf in it:
            k1, k2 = pdf["k1"].to_numpy().view(np.uint64), pdf["k2"].to_numpy().view(np.uint64)
            if len(k1):
                pos = np.unique(np.concatenate(list(positions(k1, k2, m, k, seed))))
                bit = np.left_shift(np.uint64(1), pos & np.uint64(63))
                w, at = np.unique(pos >> np.uint64(6), return_index=True)
                yield pd.DataFrame({"w": w.astype(np.int64), "b": np.bitwise_or.reduceat(bit, at).view(np.int64)})
    rows = keys.select("k1", "k2").mapInPandas(words, "w long, b long") \
        .groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    bits = np.zeros(m // 64 + 1, dtype=np.int64)
    for r in rows:
        bits[r["w"]] = r["b"]
    return bits.view(np.uint64)


def _size(n: int, rate: float) -> tuple[int, int]:
    rate = min(max(rate, 1e-9), LATER_RATE)
    m = max(64, int(math.ceil(-n * math.log(rate) / math.log(2) ** 2)))
    return m, max(1, round(m / max(n, 1) * math.log(2)))


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    b = keys.sparkSession.sparkContext.broadcast(level)

    @F.pandas_udf("boolean")
    def ok(k1: pd.Series, k2: pd.Series) -> pd.Series:
        return pd.Series(b.value.passes(k1.to_numpy().view(np.uint64), k2.to_numpy().view(np.uint64)))
    return keys.filter(ok("k1", "k2"))


def build_cascade(listed: DataFrame, unlisted: DataFrame, n_listed: int, n_unlisted: int) -> list[Level]:
    """Levels that separate the two key tables (k1, k2) exactly."""
    if not n_listed:
        return []
    levels, inside, outside, n = [], listed, unlisted, n_listed
    rate = n_listed / (math.sqrt(2) * n_unlisted) if n_unlisted else LATER_RATE
    while n:
        m, k = _size(n, rate)
        level = Level(_bits(inside, m, k, len(levels) + 1), m, k, len(levels) + 1)
        levels.append(level)
        wrong = materialize(_passing(outside, level), "cascade-level")
        inside, outside, n, rate = wrong, inside, wrong.count(), LATER_RATE
    return levels


def _classifier(spark, is_listed: list[Level], is_block: list[Level], shard: int, shards: int):
    """UDF: per key 0 unlisted, 1 allowed, 2 blocked (0 for keys of other shards)."""
    both = spark.sparkContext.broadcast((is_listed, is_block))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def classes(k1s: pd.Series, k2s: pd.Series) -> pd.Series:
        lens = k1s.map(len).to_numpy()
        if not lens.sum():
            return pd.Series([np.empty(0, np.int32)] * len(k1s))
        a = np.concatenate(k1s.to_list()).astype(np.int64).view(np.uint64)
        b = np.concatenate(k2s.to_list()).astype(np.int64).view(np.uint64)
        mine = b.view(np.int64) % shards == shard
        c = np.where(member(both.value[0], a, b), 1 + member(both.value[1], a, b), 0) * mine
        return pd.Series(np.split(c.astype(np.int32), np.cumsum(lens)[:-1]))
    return classes


def url_verdicts(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame,
                 max_bytes: int = MAX_FILTER_BYTES, id_col: str = "page_id") -> DataFrame:
    """id, host, path, rule, verdict of every row.

    ``rules``: (verdict, host, path) with verdict allow or block. A rule fits
    its host and all subdomains if the path starts with the rule's; the longest
    wins. Urls with no listed key are allowed. A table of rules (verdict, host, path) stays a table;
    only the distinct shapes of its keys reach the driver.
    """
    spark = pages.sparkSession
    ship(spark)
    listed = materialize(listed_keys(spark, rules), "url-rules")
    shapes = sorted((tuple(r) for r in listed.select("labels", "length").distinct().collect()), reverse=True)
    listed = listed.select("key", "blocked")
    rows = split_url(pages.select(F.col(id_col), F.col("url"))).withColumn("keys", key_array(shapes))
    universe = rows.select(F.explode("keys").alias("key")).distinct() \
        .join(listed, "key", "left") \
        .select(F.xxhash64("key").alias("k1"), F.xxhash64(F.lit("second"), F.col("key")).alias("k2"),
                F.col("blocked"))
    universe = materialize(universe, "url-universe")
    n_all, n_listed = universe.agg(F.count("*"), F.count("blocked")).first()
    bits = max(1, n_listed) * 2 * math.log2(max(2.0, n_all / max(1, n_listed))) + 4 * n_listed
    shards = max(1, math.ceil(bits / 8 / max_bytes))
    out = None
    for s in range(shards):
        mine = universe.filter(F.pmod("k2", F.lit(shards)) == s) if shards > 1 else universe
        inn, rest = mine.filter("blocked IS NOT NULL"), mine.filter("blocked IS NULL")
        n_in, n_block = inn.agg(F.count("*"), F.count_if("blocked")).first()
        is_listed = build_cascade(inn, rest, n_in, mine.count() - n_in)
        is_block = build_cascade(inn.filter("blocked"), inn.filter("NOT blocked"), n_block, n_in - n_block)
        classes = _classifier(spark, is_listed, is_block, s, shards)
        rows = rows.withColumn(f"c{s}", classes(F.transform("keys", lambda k: F.xxhash64(k)),
                                                F.transform("keys", lambda k: F.xxhash64(F.lit("second"), k))))
        out = F.col(f"c{s}") if out is None else F.zip_with(out, F.col(f"c{s}"), lambda x, y: F.greatest(x, y))
    hit = F.filter(F.arrays_zip(F.col("keys").alias("key"), F.col("cls")), lambda x: x["cls"] > 0)
    rows = rows.withColumn("cls", out).withColumn("hit", F.try_element_at(hit, F.lit(1)))
    return rows.select(id_col, "host", "path", F.col("hit")["key"].alias("rule"),
                       F.when(F.col("hit")["cls"] == 2, "block").otherwise("allow").alias("verdict"))
