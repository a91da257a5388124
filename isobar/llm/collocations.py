"""Phrase collocations from stripes (operator 12).

Texts are cut at `[.,;:!?]` and line ends into pieces, those into words. A stripe is a
prefix of 1 to 3 words with an associative counter of the words that follow it. Tasks
build the stripes of their texts in memory (bounded by `TOKENS` words and the longest
text), Spark deals them by language, prefix and a part of the next word's hash, and the
parts are merged elementwise. A prefix's stripe is cut into `PARTS` (or `FEW_PARTS`) parts, so that the
stripe of a word that everything follows is neither one task's nor one row's. From the
merged stripes come

* the extensions: each entry is a phrase with its count;
* the prefix totals: the sum of a one-word stripe, the end of a piece included, is the
  count of the word; for a longer prefix it is its entry one level before;
* the subsumption maxima: the largest entry of a stripe is the most frequent phrase that
  continues the prefix.

A phrase of at least `LEAST` occurrences has only parts of as many, so entries are kept
for phrases whose word pairs occur so often (a first pass counts the pairs by 64-bit hashes),
those of two-word prefixes only if the three words do (a second pass counts by hashes the
triples of such pairs), and those of three-word prefixes only if the prefix and the rest do.
A hash and its count take a third of the bytes of a stripe of few entries. What a one-word stripe
leaves out is summed in its entry for the end of a piece, so its total stays exact. Bloom
filters of at most `FILTER_BYTES` tell which phrases to go on with; what they let through in
error is counted and falls out by its count, so a full filter costs time and changes nothing.

A candidate's cuts need the counts of its first and last words: they grow along the
levels, first parts by the join of a stripe with its prefix, rests by the join of an entry
with its rest. A phrase inside a longer candidate is inside one that is one word longer and
at least as frequent, so only those are compared.

Defined results: words are compared by their bytes after A-Z became lower case; NULL, empty
and blank texts have no words; a NULL language is `und`, like the language of that name;
repeated rows count as often as they occur; equal scores rank by the larger count, then by
the phrase's bytes; texts of any length are read whole; a language without a candidate and
an empty table give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from isobar.session import Scratch

from .common import ship
from .hashing import BASE, U, hash_filter, in_filter, mix

# Fixed values of the measure.
LEAST = 30
LONGEST = 4
TOP = 2000
SCALE = 2_000_000
SUBSUMED = 80        # percent
SEPARATORS = b".,;:!?\n\x0b\x0c\r"

PARTS = {1: 16}       # parts of a stripe by the words of its prefix
FEW_PARTS = 4         # of longer prefixes
TOKENS = 1 << 20     # words whose stripes a task holds
TEXTS = 1 << 9       # texts read at once
ROWS = 1 << 14       # rows of stripes or hashes sent at once
SLICE = 1 << 20      # bytes split at once
FILTER_BYTES = 32 << 20
_ONE_SEPARATOR = bytes.maketrans(SEPARATORS, b"." * len(SEPARATORS))
_CUT = re.compile(rb"[ \t.]")
STRIPES = "lang string, prefix binary, part int, next array<binary>, n array<long>"


class Vocabulary(dict):
    """Numbers of words in the order of their first use; 0 is the end of a piece."""

    def __init__(self):
        self.words, self.hashes = [], array("Q")
        self[b"."]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return number


def _slices(data: bytes):
    """``data`` in parts of about SLICE bytes, cut before a blank or a separator."""
    at = 0
    while len(data) - at > SLICE:
        cut = _CUT.search(data, at + SLICE)
        if cut is None:
            break
        yield data[at:cut.start()]
        at = cut.start()
    yield data[at:]


def word_numbers(texts: list[bytes], vocabulary: Vocabulary):
    """Arrays of word numbers of the texts; pieces end with a 0."""
    for part in _slices(b".".join(texts).lower().translate(_ONE_SEPARATOR) + b"."):
        tokens = part.replace(b".", b" . ").split()
        yield np.fromiter(map(vocabulary.__getitem__, tokens), np.int32, len(tokens))


def phrase_hashes(hashes: np.ndarray, size: int, lang: str) -> np.ndarray:
    """Hash of the ``size`` words that start at each place."""
    n = max(0, len(hashes) - size + 1)
    with np.errstate(over="ignore"):
        h = np.full(n, xxhash.xxh64_intdigest(lang.encode()), np.uint64)
        for j in range(size):
            h = mix(h * U(BASE) + hashes[j:j + n])
    return h


def _numbered(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first places, numbers) of the different pairs (a, b), with b < size."""
    _, first, number = np.unique(a.astype(np.int64) * size + b, return_index=True, return_inverse=True)
    return first, number


def fitting(words: np.ndarray, hashes: np.ndarray, lang: str, size: int, bits: np.ndarray) -> np.ndarray:
    """Whether the ``size`` words from each place on are one piece's and, by the filter, frequent."""
    fits = np.ones(max(0, len(words) - size + 1), bool)
    for j in range(size):
        fits &= words[j:j + len(fits)] != 0
    at = np.flatnonzero(fits)
    fits[at] = in_filter(bits, phrase_hashes(hashes[words], size, lang)[at])
    return fits


def level_stripes(words: np.ndarray, vocabulary: Vocabulary, lang: str, level: int, fits: np.ndarray,
                  whole: np.ndarray | None = None) -> pa.RecordBatch | None:
    """The stripes of the prefixes of ``level`` words in the sequence ``words``; ``fits`` tells the
    places of frequent pairs (levels 1 and 2) or frequent phrases of ``level`` words, ``whole`` (from
    level 2 on) those of frequent phrases of one word more."""
    texts, hashes = vocabulary.words, np.array(vocabulary.hashes, np.uint64)
    n = len(words) - level
    if n <= 0:
        return None
    if level == 1:
        at = np.flatnonzero(words[:n] != 0)
        following = np.where(fits[:n], words[1:], 0)[at]
    else:
        # the prefix and the rest, and with them all words up to the next one
        at = np.flatnonzero(fits[:n] & fits[1:n + 1] & (True if whole is None else whole[:n]))
        following = words[at + level]
    if not len(at):
        return None
    size = len(texts)
    prefix, first = words[at], at
    for j in range(1, level):
        one, prefix = _numbered(prefix, words[at + j], size)
        first = at[one]
    if level == 1:
        _, one, prefix = np.unique(prefix, return_index=True, return_inverse=True)
        first = at[one]
    key, n_key = np.unique(prefix.astype(np.int64) * size + following, return_counts=True)
    prefix, after = key // size, key % size
    part = (mix(hashes[after]) % U(PARTS.get(level, FEW_PARTS))).astype(np.int64)
    order = np.lexsort((part, prefix))
    prefix, after, part, n_key = prefix[order], after[order], part[order], n_key[order]
    head = np.flatnonzero(np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])]))
    offsets = pa.array(np.append(head, len(prefix)).astype(np.int32))
    names = pa.array(texts, pa.binary())
    start = first[prefix[head]]
    columns = [names.take(pa.array(words[start + j])) for j in range(level)]
    text = columns[0] if level == 1 else pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary()))
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(head), pa.string()), text, pa.array(part[head].astype(np.int32)),
         pa.ListArray.from_arrays(offsets, names.take(pa.array(after))),
         pa.ListArray.from_arrays(offsets, pa.array(n_key.astype(np.int64)))],
        names=["lang", "prefix", "part", "next", "n"])


def _each_stretch(batches, tokens: int, work):
    """``work(words, vocabulary, lang)`` on stretches of about ``tokens`` words of whole texts."""
    vocabulary, held, size = Vocabulary(), {}, 0

    def flush():
        for lang in list(held):
            for found in work(np.concatenate(held.pop(lang)), vocabulary, lang):
                for at in range(0, found.num_rows, ROWS):
                    yield found.slice(at, ROWS)
    for batch in (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS)):
        by_lang = {}
        for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("raw")):
            by_lang.setdefault(lang, []).append(raw.as_py())
        for lang, raws in by_lang.items():
            for numbers in word_numbers(raws, vocabulary):
                held.setdefault(lang, []).append(numbers)
                size += len(numbers)
            if size >= tokens:
                yield from flush()
                vocabulary, held, size = Vocabulary(), {}, 0
    yield from flush()


def frequent_phrases(texts: DataFrame, size: int, least: int, tokens: int = TOKENS, bits=None) -> DataFrame:
    """(h): hashes of the phrases of ``size`` words that occur at least ``least`` times (and of few others).

    ``bits``: broadcast filter of the phrases of one word less; pairs have none.
    """
    def count(words, vocabulary, lang):
        hashes = np.array(vocabulary.hashes, np.uint64)
        fits = words != 0 if bits is None else fitting(words, hashes, lang, size - 1, bits.value)
        h = phrase_hashes(hashes[words], size, lang)
        h, n = np.unique(h[fits[:-1] & fits[1:]], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    def run(batches):
        return _each_stretch(batches, tokens, count)
    return texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= least).select("h")


def stripes(texts: DataFrame, levels: tuple[int, ...], bits: dict, tokens: int = TOKENS) -> DataFrame:
    """(lang, prefix, part, next, n): the tasks' stripes; next '.' is the end of a piece.

    ``texts``: lang, raw; ``bits``: broadcast filters of the phrases to go on with by their words, of
    pairs for levels 1 and 2, of phrases of the level's length beyond; one of a word more is used too.
    """
    def build(words, vocabulary, lang):
        hashes = np.array(vocabulary.hashes, np.uint64)
        fits = {k: fitting(words, hashes, lang, k, b.value) for k, b in bits.items()}
        for level in levels:
            found = level_stripes(words, vocabulary, lang, level, fits[max(2, level)], fits.get(level + 1) if level > 1 else None)
            if found is not None:
                yield found

    def run(batches):
        return _each_stretch(batches, tokens, build)
    return texts.mapInArrow(run, STRIPES)


def merged(found: DataFrame, least: int) -> DataFrame:
    """(lang, prefix, total, next array<struct<w, a>>): the parts of the merged stripes with the
    entries of at least ``least`` occurrences; ``total`` counts all entries of the part."""
    entries = found.repartition("lang", "prefix", "part").select(
        "lang", "prefix", "part", F.explode(F.arrays_zip("next", "n")).alias("e")) \
        .groupBy("lang", "prefix", "part", F.col("e.next").alias("w")).agg(F.sum("e.n").alias("a"))
    often = (F.col("a") >= least) & (F.col("w") != F.lit(b"."))
    return entries.groupBy("lang", "prefix", "part").agg(
        F.sum("a").alias("total"), F.collect_list(F.when(often, F.struct("w", "a"))).alias("next")) \
        .select("lang", F.col("prefix").cast("string").alias("prefix"), "total", "next")


def bounded_filter(hashes: DataFrame, limit: int = FILTER_BYTES) -> np.ndarray:
    """Bits of the Bloom filter of the hashes, at most ``limit`` bytes (or one block)."""
    return hash_filter(hashes, min(hashes.count(), limit * 8 // 12))


def hashed_phrases(entries: DataFrame) -> DataFrame:
    """(h): the hashes of the phrases."""
    @F.pandas_udf("long")
    def hashed(lang: pd.Series, phrase: pd.Series) -> pd.Series:
        out = np.empty(len(phrase), np.uint64)
        for i, (x, p) in enumerate(zip(lang, phrase)):
            h = np.array([xxhash.xxh64_intdigest(w.encode()) for w in p.split(" ")], np.uint64)
            out[i] = phrase_hashes(h, len(h), x)[0]
        return pd.Series(out.view(np.int64))
    return entries.select(hashed("lang", "phrase").alias("h"))


def next_entries(found: DataFrame, known: DataFrame) -> DataFrame:
    """(lang, phrase, rest, a, lefts, rights) of the entries of merged stripes ``found``; ``known``
    are those of the prefixes' length."""
    prefix = known.select("lang", F.col("phrase").alias("prefix"), F.array_append("lefts", F.col("a")).alias("lefts"))
    # one row a stripe's part here, however many extensions it has
    grown = found.filter(F.size("next") > 0).join(prefix, ["lang", "prefix"]) \
        .select("lang", "prefix", "lefts", F.explode("next").alias("e")) \
        .select("lang", "lefts", F.concat_ws(" ", "prefix", F.col("e.w").cast("string")).alias("phrase"), F.col("e.a").alias("a"))
    grown = grown.withColumn("rest", F.regexp_replace("phrase", "^[^ ]* ", ""))
    rest = known.select("lang", F.col("phrase").alias("rest"), F.array_prepend("rights", F.col("a")).alias("rights"))
    return grown.join(rest, ["lang", "rest"]).select("lang", "phrase", "rest", "a", "lefts", "rights")


def _uncovered(entries: DataFrame, found: DataFrame | None, longer: DataFrame | None) -> DataFrame:
    """The entries that no candidate of one word more holds nearly as often."""
    if found is None:
        return entries
    right = found.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max(F.array_max(F.transform("next", lambda e: e["a"]))).alias("m"))
    left = longer.groupBy("lang", F.col("rest").alias("phrase")).agg(F.max("a").alias("m"))
    most = right.unionByName(left).groupBy("lang", "phrase").agg(F.max("m").alias("m"))
    return entries.join(most, ["lang", "phrase"], "left") \
        .filter(F.coalesce(100 * F.col("m"), F.lit(0)) < SUBSUMED * F.col("a")).drop("m")


def _lowest_cut() -> Column:
    """(score, k) of the lowest-scoring cut, ties to the smallest k."""
    return F.expr(f"""array_min(transform(sequence(1, size(lefts)), k -> struct(
        CAST(a AS DECIMAL(20, 0)) * {SCALE} div (element_at(lefts, k) + element_at(rights, k)) AS score, k AS k)))""")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST,
                 tokens: int = TOKENS, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to ``longest`` words."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.col("text").cast("binary").alias("raw")).filter("length(raw) > 0")
    with Scratch(spark) as scratch:
        def filter_of(hashes):
            return spark.sparkContext.broadcast(bounded_filter(hashes, filter_bytes))
        bits = {2: filter_of(scratch.table(frequent_phrases(texts, 2, least, tokens), "frequent-pairs"))}
        if longest > 2:
            bits[3] = filter_of(scratch.table(frequent_phrases(texts, 3, least, tokens, bits[2]), "frequent-triples"))
        levels = tuple(range(1, min(longest, 4)))
        all_found = scratch.table(merged(stripes(texts, levels, bits, tokens), least), "stripes")
        blanks = F.expr("length(prefix) - length(replace(prefix, ' ', ''))")
        found = {k: all_found.filter(blanks == k - 1) for k in levels}
        totals = scratch.table(found[1].groupBy("lang", F.col("prefix").alias("phrase"))
                               .agg(F.sum("total").alias("a")), "word-totals")
        sizes = totals.groupBy("lang").agg(F.sum("a").alias("n"))
        none = F.array().cast("array<long>")
        entries = {1: totals.filter(F.col("a") >= least).select("lang", "phrase", "a", none.alias("lefts"), none.alias("rights"))}
        for k in range(1, longest):
            if k not in found:
                bits = {k: filter_of(hashed_phrases(entries[k]))}
                found[k] = scratch.table(merged(stripes(texts, (k,), bits, tokens), least), f"stripes-{k}")
            entries[k + 1] = scratch.table(next_entries(found[k], entries[k]), f"phrases-{k + 1}")
        parts = [_uncovered(entries[k], found.get(k) if k < longest else None, entries.get(k + 1)).drop("rest") for k in range(2, longest + 1)]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        rows = rows.withColumn("cut", _lowest_cut()).select(
            "lang", "phrase", "a", F.element_at("lefts", F.col("cut.k")).alias("l"),
            F.element_at("rights", F.col("cut.k")).alias("r"), F.col("cut.score").alias("score"))
        best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = rows.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
        # the result is read by the caller and stays
        return Scratch(spark).table(ranked.join(sizes, "lang").select(
            "lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")


# The same in DuckDB SQL.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1), lambda i: w[i:i + k - 1])) AS g
  FROM words, (SELECT unnest(generate_series(1, {LONGEST})) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(g, ' ') AS phrase, min(g) AS g, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
sizes AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
inner_phrases AS (
  SELECT f.lang, f.a, array_to_string(f.g[s.s:s.s + m.m - 1], ' ') AS phrase
  FROM f, (SELECT unnest(generate_series(2, {LONGEST - 1})) AS m) m, (SELECT unnest(generate_series(1, {LONGEST - 1})) AS s) s
  WHERE m.m < f.k AND s.s + m.m - 1 <= f.k),
most AS (SELECT lang, phrase, max(a) AS m FROM inner_phrases GROUP BY lang, phrase),
kept AS (
  SELECT f.* FROM f LEFT JOIN most USING (lang, phrase)
  WHERE k >= 2 AND 100 * coalesce(m, 0) < {SUBSUMED} * a),
cuts AS (
  SELECT t.lang, t.phrase, t.a, l.a AS l, r.a AS r, c.c,
         CAST({SCALE} * CAST(t.a AS HUGEINT) // (l.a + r.a) AS BIGINT) AS score
  FROM kept t JOIN (SELECT unnest(generate_series(1, {LONGEST - 1})) AS c) c ON c.c < t.k
  JOIN f l ON l.lang = t.lang AND l.phrase = array_to_string(t.g[1:c.c], ' ')
  JOIN f r ON r.lang = t.lang AND r.phrase = array_to_string(t.g[c.c + 1:t.k], ' ')),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS o FROM cuts),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest WHERE o = 1)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM ranked JOIN sizes USING (lang) WHERE rank <= {TOP}
"""
