"""N-gram Jaccard self-join by a MinHash LSH forest (operator 7).

A document is the set of its word 5-grams; two documents link if the Jaccard
similarity of their sets is at least 0.8.

1. Equal sets are merged first (copies are one class, found by partial
   aggregation of a 128-bit set hash). Only one set per class goes on.
2. Every class gets `TREES` signatures of MinHash values; a tree is the prefix trie
   of one of them. Trie nodes are keys (tree, prefix), their sizes are counted with
   partial aggregation, and only classes that share a prefix of `FIRST` values with
   another one go below it, so no task holds a node.
3. Prefixes start at `LEVELS` values and are shortened, the longest first, until a pair at
   the threshold, the hardest to find, is met in some tree with chance `RECALL` (`deepest`).
   That holds for any data, as it is settled before data are seen. From there each class
   shortens its prefix in each tree on its own, as long as the trie node above has at
   most `SPARE` classes: most classes are searched by shorter prefixes and miss less, crowded
   nodes stay at the depth of the target. How many classes a node has is the same for all
   of them, so both ends of a pair see the same group. (Trading long prefixes in crowded trees
   for short ones elsewhere would stay long just where the partners are, and lose links.)
4. The classes of one group are verified exactly on their sets. Groups of
   more than `BLOCK` classes or `BLOCK_BYTES` are split into blocks, each pair of blocks
   is its own task, and tasks return link counts and a spanning forest of the links,
   never pairs. A pair is counted in the first tree in which it meets; groups
   with the same members in several trees are verified once.
5. The forests are joined to connected components by label propagation with
   pointer jumping over written tables.

A pair at exactly 0.8 is missed with chance 1 - `RECALL` at most, more similar ones less often.
Sets are compared as 64-bit hashes of their grams.

Defined results: words are maximal runs without ASCII white space, compared by
their bytes; texts of 1-4 words have one gram, the whole text; NULL, empty and
blank texts have no grams and are alone (no links, own class); repeated rows are
copies of each other; very long texts are hashed in parts, whole; an empty table gives no
rows; other columns, whatever their names, are ignored.
``n_links`` counts the other documents with similarity >= 0.8, copies included;
``class_id`` is the smallest id of the connected component, ``copy_id`` that of
the documents with the same grams.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from isobar.session import Scratch, materialize

from .common import ship
from .hashing import BASE, CHUNK, Tables, U, mix

GRAM = 5
THRESHOLD = 0.8
TREES = 16
FIRST = 2                # values of the shortest prefix
LEVELS = 6               # values of the longest prefix
RECALL = 0.9999
SPARE = 8                # classes of a node that is searched by a shorter prefix
BLOCK = 256
BLOCK_BYTES = 16 << 20   # grams of a block
COLUMNS = 1 << 14        # gram columns of one matrix product
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def deepest(threshold: float = THRESHOLD, recall: float = RECALL) -> list[int]:
    """The longest prefix to stop at in each tree: two sets at the threshold agree in k values with chance
    threshold ** k, so they meet in some tree with the target recall."""
    depth = [LEVELS] * TREES
    while max(depth) > FIRST and 1 - np.prod([1 - threshold ** d for d in depth]) < recall:
        depth[depth.index(max(depth))] -= 1
    return depth


def _word_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unmixed rolling sums of the words of ``data`` and their starts."""
    word = ~_WHITE[data]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    t = Tables.get()
    with np.errstate(over="ignore"):
        c = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(t.byte[data] * t.power[:len(data)], out=c[1:])
        return (c[end] - c[start]) * t.inverse[start], start


def _long_words(raw: bytes) -> np.ndarray:
    """Word hashes of a text longer than CHUNK: cut at white space; longer words piecewise."""
    out, part, size = [], [], 0

    def flush():
        if part:
            out.append(mix(_word_sums(np.frombuffer(b" ".join(part), np.uint8))[0]))
    for w in raw.split():
        if len(w) >= CHUNK // 2:
            flush()
            part, size, total, scale = [], 0, U(0), U(1)
            with np.errstate(over="ignore"):
                for at in range(0, len(w), CHUNK // 2):
                    piece = w[at:at + CHUNK // 2]
                    total = total + _word_sums(np.frombuffer(piece, np.uint8))[0][0] * scale
                    scale = scale * U(pow(BASE, len(piece), 1 << 64))
            out.append(mix(np.array([total], np.uint64)))
            continue
        if size + len(w) >= CHUNK - 1:
            flush()
            part, size = [], 0
        part.append(w)
        size += len(w) + 1
    flush()
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def word_hashes(texts: list[bytes]):
    """(row numbers, hashes of the words, text number of each word) of chunks of texts."""
    rows, parts, size = [], [], 0

    def chunk():
        data = np.frombuffer(b"\n".join(parts), np.uint8)
        sums, start = _word_sums(data)
        base = np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
        return rows, mix(sums), np.searchsorted(base, start, side="right") - 1
    for i, raw in enumerate(texts):
        if len(raw) > CHUNK // 2:
            w = _long_words(raw)
            yield [i], w, np.zeros(len(w), np.int64)
            continue
        if size + len(raw) + 1 > CHUNK:
            yield chunk()
            rows, parts, size = [], [], 0
        rows.append(i)
        parts.append(raw)
        size += len(raw) + 1
    if rows:
        yield chunk()


def gram_sets(texts: list[bytes], gram: int = GRAM):
    """(row numbers, sorted distinct gram hashes, text number of each) of chunks of texts."""
    for rows, w, doc in word_hashes(texts):
        n = np.bincount(doc, minlength=len(rows)) if len(rows) else np.empty(0, np.int64)
        with np.errstate(over="ignore"):
            factor = [U(pow(BASE, 2 * j + 1, 1 << 64)) for j in range(gram)]
            full = max(0, len(w) - gram + 1)
            g = sum((w[j:j + full] * factor[j] for j in range(gram)), np.zeros(full, np.uint64))
            inside = doc[:full] == doc[gram - 1:gram - 1 + full] if full else np.zeros(0, bool)
            g, d = mix(g[inside]), doc[:full][inside]
            few = np.flatnonzero((n > 0) & (n < gram))
            first = np.cumsum(n) - n
            extra = [mix(np.array([sum((w[first[i] + j] * factor[j] for j in range(n[i])), U(0))
                                   + U(int(n[i]))], np.uint64))[0] for i in few]
        if len(few):
            g, d = np.concatenate([g, np.array(extra, np.uint64)]), np.concatenate([d, few])
        order = np.lexsort((g, d))
        g, d = g[order], d[order]
        if len(g):
            new = np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])])
            g, d = g[new], d[new]
        yield rows, g, d


class Signer:
    """The MinHash values of all trees, tree by tree."""

    def __init__(self, width: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.flip = rng.integers(0, 1 << 63, size=TREES * width, dtype=np.uint64)
        self.times = rng.integers(0, 1 << 63, size=TREES * width, dtype=np.uint64) * U(2) + U(1)

    def values(self, g: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """texts x (trees * width), 32 bits each; ``heads``: the first gram of each text."""
        out = np.empty((len(heads), len(self.flip)), np.int32)
        with np.errstate(over="ignore"):
            for i in range(len(self.flip)):
                low = np.minimum.reduceat((g ^ self.flip[i]) * self.times[i], heads)
                out[:, i] = (mix(low) >> U(32)).astype(np.uint32).view(np.int32)
        return out


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(rid, doc_id, dh, dg, n, k1, k2, sig array<int>) of every row, ``width`` values a tree; n = 0: no grams."""
    def run(it):
        signer = Signer(width)
        for pdf in it:
            m = len(pdf)
            n, k1, k2 = np.zeros(m, np.int32), np.zeros(m, np.int64), np.zeros(m, np.int64)
            sig = [None] * m
            for rows, g, d in gram_sets([bytes(x) for x in pdf["raw"]]):
                if not len(g):
                    continue
                heads = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
                at = np.array(rows)[d[heads]]
                with np.errstate(over="ignore"):
                    k1[at] = np.add.reduceat(mix(g ^ U(BASE)), heads).view(np.int64)
                    k2[at] = np.add.reduceat(mix(g * U(BASE) + U(7)), heads).view(np.int64)
                n[at] = np.diff(np.append(heads, len(d)))
                for i, v in zip(at, signer.values(g, heads)):
                    sig[i] = v
            yield pd.DataFrame({"rid": pdf["rid"], "doc_id": pdf["doc_id"], "dh": pdf["dh"], "dg": pdf["dg"],
                                "n": n, "k1": k1, "k2": k2, "sig": sig})
    kind = dict(docs.select("doc_id").dtypes)["doc_id"]
    return docs.mapInPandas(run, f"rid long, doc_id {kind}, dh long, dg long, n int, k1 long, k2 long, sig array<int>")


def sets_of(docs: DataFrame) -> DataFrame:
    """(node, w, prefix, grams binary): the gram sets of the texts."""
    def run(it):
        for pdf in it:
            grams = [b""] * len(pdf)
            for rows, g, d in gram_sets([bytes(x) for x in pdf["raw"]]):
                if len(g):
                    heads = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
                    for i, part in zip(d[heads], np.split(g, heads[1:])):
                        grams[rows[i]] = part.tobytes()
            yield pd.DataFrame({"node": pdf["node"], "w": pdf["w"], "prefix": pdf["prefix"], "grams": grams})
    return docs.select("node", "w", "prefix", "raw").mapInPandas(
        run, "node long, w long, prefix array<long>, grams binary")


def intersections(a: list[np.ndarray], b: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the pairwise intersections (of ``a`` with itself if ``b`` is None)."""
    both = a if b is None else a + b
    row = np.repeat(np.arange(len(both)), [len(x) for x in both])
    _, col, cnt = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    shared = cnt[col] > 1          # grams of one set meet nothing
    row, col = row[shared], col[shared]
    out = np.zeros((len(a), len(a) if b is None else len(b)), np.float32)
    if not len(col):
        return out
    used, col = np.unique(col, return_inverse=True)
    for lo in range(0, len(used), COLUMNS):
        hi = min(lo + COLUMNS, len(used))
        at = (col >= lo) & (col < hi)
        m = np.zeros((len(both), hi - lo), np.float32)
        m[row[at], col[at] - lo] = 1
        out += m @ m.T if b is None else m[:len(a)] @ m[len(a):].T
    return out


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """(item, smallest item of its component) of the linked items."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in zip(i.tolist(), j.tolist()):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, find(x)) for x in range(n) if find(x) != x]


def verify_group(tree: int, left: list, right: list | None, threshold: float) -> pd.DataFrame:
    """Links of a group of classes, or between two blocks of one: per class the
    linked classes and documents, and the spanning edges.

    Members: (node, documents, prefixes, grams).
    """
    both = left if right is None else left + right
    a = [x[3] for x in left]
    b = None if right is None else [x[3] for x in right]
    inter = intersections(a, b)
    na = np.array([len(x) for x in a], np.float64)
    nb = na if b is None else np.array([len(x) for x in b], np.float64)
    union = na[:, None] + nb[None, :] - inter
    link = inter >= threshold * union - 1e-9
    pa = np.stack([x[2] for x in left])
    pb = pa if right is None else np.stack([x[2] for x in right])
    for t in range(tree):          # counted in an earlier tree
        link &= pa[:, t][:, None] != pb[:, t][None, :]
    node = np.array([x[0] for x in both], np.int64)
    docs = np.array([x[1] for x in both], np.float64)
    if right is None:
        np.fill_diagonal(link, False)
        texts, copies = link.sum(axis=1), link @ docs
        i, j = np.nonzero(np.triu(link))
    else:
        link &= node[:len(left)][:, None] != node[len(left):][None, :]
        texts = np.concatenate([link.sum(axis=1), link.sum(axis=0)])
        copies = np.concatenate([link @ docs[len(left):], link.T @ docs[:len(left)]])
        i, j = np.nonzero(link)
        j = j + len(left)
    order = np.argsort(node, kind="stable")
    rank = np.empty(len(node), np.int64)
    rank[order] = np.arange(len(node))
    root = dict(_forest(rank[i], rank[j], len(node)))
    has = np.flatnonzero(texts > 0)
    return pd.DataFrame({"node": node[has], "texts": texts[has].astype(np.int64),
                         "documents": copies[has].astype(np.int64),
                         "root": [node[order[root.get(r, r)]] for r in rank[has]]})


def _verify(threshold: float):
    """Streams members ordered by group; a group is one prefix, or two blocks of one."""
    def done(key, members):
        sides = {0: [], 1: []}
        for side, *m in members:
            if all(m[0] != x[0] for x in sides[side][-1:]):
                sides[side].append(m)
        if key[2] == key[3]:
            return verify_group(key[0], sides[0], None, threshold) if len(sides[0]) > 1 else None
        # blocks are dealt by hash: one of two may hold nothing
        return verify_group(key[0], sides[0], sides[1], threshold) if sides[0] and sides[1] else None

    def run(it):
        key, members = None, []
        for pdf in it:
            for t, p, bi, bj, side, node, w, prefix, grams in zip(
                    pdf["t"], pdf["p"], pdf["bi"], pdf["bj"], pdf["side"], pdf["node"], pdf["w"],
                    pdf["prefix"], pdf["grams"]):
                if (t, p, bi, bj) != key:
                    if members and (out := done(key, members)) is not None:
                        yield out
                    key, members = (t, p, bi, bj), []
                members.append((side, node, w, np.asarray(prefix, np.int64), np.frombuffer(grams, np.uint64)))
        if members and (out := done(key, members)) is not None:
            yield out
    return run


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, label): smallest node of each connected component of edges (node, root).

    The tables of the rounds go with ``scratch`` where it is given, else they stay.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    edges = edges.filter("node <> root").distinct()
    both = scratch.table(edges.union(edges.select("root", "node")).toDF("node", "other"), "edges")
    labels = scratch.table(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    while True:
        # the smallest label of the neighbours, then the label of the label
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other") \
            .groupBy("node").agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = scratch.table(step.join(up, "label").select("node", "old", F.least("label", "up").alias("label")), "labels")
        if new.filter("old <> label").limit(1).count() == 0:
            return new.select("node", "label")
        labels = new.select("node", "label")


def forest_members(classes: DataFrame, depths: list[int], spare: int) -> DataFrame:
    """(node, t, p): the trie node p in which each class is searched in tree t, for the trees in which
    it shares `FIRST` values with another class.

    ``depths``: the longest prefix of each tree; the values of a tree stand together in ``sig``.
    """
    width = max(depths)

    def prefix(k):
        return F.xxhash64("t", F.slice("sig", F.col("t") * width + 1, k))
    top = classes.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("t")) \
        .select("node", "t", prefix(FIRST).alias("p"))
    shared = top.groupBy("t", "p").agg(F.count("*").alias("size")).filter("size > 1").drop("size")
    trees = top.join(shared, ["t", "p"]).groupBy("node").agg(F.collect_list("t").alias("ts"))
    limit = F.element_at(F.array(*[F.lit(d) for d in depths]), F.col("t") + 1)
    nodes = classes.select("node", "sig").join(trees, "node").select("node", "sig", F.explode("ts").alias("t")) \
        .select("node", "t", limit.alias("limit"), F.posexplode(F.array(*[prefix(k) for k in range(FIRST, width + 1)])).alias("k", "p")) \
        .withColumn("k", F.col("k") + FIRST).filter("k <= limit")
    sizes = nodes.groupBy("t", "p").agg(F.count("*").alias("size"))
    return nodes.join(sizes, ["t", "p"]).filter((F.col("size") <= spare) | (F.col("k") == F.col("limit"))) \
        .groupBy("node", "t").agg(F.min(F.struct("k", "p")).alias("g")).select("node", "t", F.col("g.p").alias("p"))


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK,
                 block_bytes: int = BLOCK_BYTES, recall: float = RECALL, spare: int = SPARE) -> DataFrame:
    """doc_id, class_id, copy_id, n_links, n_grams of every document."""
    spark = docs.sparkSession
    ship(spark)
    depths = deepest(threshold, recall)
    text = F.coalesce(F.col("text"), F.lit(""))
    # 128 bits find a class's text again; row numbers might differ when the input is read a second time
    d = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id"),
                    F.xxhash64(F.col("doc_id"), text).alias("dh"), F.xxhash64(F.lit(7), text, F.col("doc_id")).alias("dg"),
                    text.cast("binary").alias("raw"))
    sig = materialize(signatures(d, max(depths)), "signatures")
    with Scratch(spark) as scratch:
        # one class per gram set; its text is that of its smallest row
        classes = sig.filter("n > 0").groupBy("k1", "k2").agg(
            F.count("*").alias("w"), F.min("doc_id").alias("copy_id"), F.min("rid").alias("node"),
            F.min_by(F.struct("dh", "dg", "sig", "n"), "rid").alias("r"))
        classes = scratch.table(classes.select("k1", "k2", "w", "copy_id", "node", "r.*"), "classes")
        members = scratch.table(forest_members(classes, depths, spare)
                                .join(classes.select("node", "n"), "node"), "members")
        groups = members.groupBy("t", "p").agg(
            F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"), F.min("node").alias("lo"),
            (F.sum("n") * 8).alias("bytes")).filter("size > 1") \
            .groupBy("size", "x", "lo", "bytes").agg(F.min(F.struct("t", "p")).alias("g")) \
            .select("g.t", "g.p", F.least(F.col("size"), F.greatest(
                F.ceil(F.col("size") / block), F.ceil(F.col("bytes") / block_bytes))).cast("int").alias("blocks"))
        inside = scratch.table(members.drop("n").join(groups, ["t", "p"]), "group-members")
        # the class's groups by tree; where it is alone, a value of its own
        places = members.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("t", "p"))).alias("m")) \
            .join(inside.select("node").distinct(), "node").select("node", F.array(*[
                F.coalesce(F.try_element_at("m", F.lit(t)), F.xxhash64("node", F.lit(t), F.lit("alone"))) for t in range(TREES)])
                .alias("prefix"))
        wanted = classes.join(places, "node").select("node", "w", "prefix", "dh", "dg")
        sets = sets_of(d.select("dh", "dg", "raw").join(wanted, ["dh", "dg"]))
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        placed = inside.withColumn("own", own).withColumn(
            "with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
            .select("t", "p", "node", F.least("own", "with").alias("bi"), F.greatest("own", "with").alias("bj"),
                    (F.col("own") > F.col("with")).cast("int").alias("side"))
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        links = placed.join(sets, "node").repartition(n, "t", "p", "bi", "bj") \
            .sortWithinPartitions("t", "p", "bi", "bj", "side", "node") \
            .mapInPandas(_verify(threshold), "node long, texts long, documents long, root long")
        links = scratch.table(links, "links")
        label = components(links.select("node", "root"), scratch)
        counts = links.groupBy("node").agg(F.sum("documents").alias("linked"))
        c = classes.select("k1", "k2", "w", "copy_id", "node").join(label, "node", "left").join(counts, "node", "left") \
            .withColumn("label", F.coalesce("label", "node"))
        c = materialize(c, "class-labels")
    ids = c.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    c = c.join(ids, "label").select("k1", "k2", "copy_id", "class_id",
                                    (F.col("w") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    alone = sig.filter("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"),
                                       F.lit(0).cast("long").alias("n_links"), F.lit(0).alias("n_grams"))
    return sig.filter("n > 0").join(c, ["k1", "k2"]) \
        .select("doc_id", "class_id", "copy_id", "n_links", F.col("n").alias("n_grams")).unionByName(alone)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The document with the smallest id of every class, with all its columns."""
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("row"),
                                   *[F.col(c).alias(f"d_{c}") for c in docs.columns]), "rows")
    classes = near_classes(rows.select(F.col("row").alias("doc_id"), F.col("d_text").alias("text")), threshold)
    best = classes.select(F.col("doc_id").alias("row"), "class_id") \
        .join(rows.select("row", "d_doc_id"), "row").groupBy("class_id") \
        .agg(F.min(F.struct(F.col("d_doc_id").isNull(), "d_doc_id", "row")).alias("b")) \
        .select(F.col("b.row").alias("row"))
    return rows.join(best, "row", "left_semi").select(*[F.col(f"d_{c}").alias(c) for c in docs.columns])


# The same in DuckDB SQL (ids unique): all pairs that share a gram, without signatures.
ORACLE = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {GRAM} THEN list_transform(
      generate_series(1, len(w) - {GRAM - 1}), lambda i: array_to_string(w[i:i + {GRAM - 1}], ' ')) ELSE [array_to_string(w, ' ')] END) AS g
  FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
m AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (
  SELECT m.a, m.b, shared = x.n AND shared = y.n AS same FROM m JOIN n x ON x.doc_id = m.a JOIN n y ON y.doc_id = m.b
  WHERE shared >= {THRESHOLD} * (x.n + y.n - shared)),
r(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS class_id FROM r GROUP BY a),
l AS (SELECT a AS doc_id, count(*) AS k, min(CASE WHEN same THEN b END) AS twin FROM e GROUP BY a)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, least(d.doc_id, coalesce(l.twin, d.doc_id)) AS copy_id,
       CAST(coalesce(l.k, 0) AS BIGINT) AS n_links, CAST(coalesce(n.n, 0) AS INTEGER) AS n_grams
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN n USING (doc_id)
"""
