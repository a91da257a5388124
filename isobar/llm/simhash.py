"""SimHash near-duplicates by bit-sliced comparison (operator 11).

A document's shingles are its runs of `SHINGLE` words, repeats included (fewer words:
the whole sequence). A bit of its fingerprint is 1 if it is set in over half of the
shingles' XXH64 values. Documents link if their fingerprints differ in at most
`RADIUS` bits; linked documents form components.

1. Equal fingerprints are one node, found by partial aggregation.
2. Two nodes within the radius agree in one of RADIUS + 1 blocks of the bits, so every
   node meets others under each of its blocks' values. Groups of more than `GROUP`
   nodes are divided again by the blocks of the bits that are left (the same argument
   holds for those), at most `DEPTH` times; what is still larger then is cut into
   blocks, and each two blocks meet in their own task. No pair is lost at any step.
3. In a task, 64 nodes of a group are a lane: bit plane b holds bit b of all of them as
   one word. A node is compared with a whole lane at once: the planes, flipped where the
   node has a 1, are added by two carry-save words and one overflow word. Lanes whose
   nodes all exceed the radius are abandoned.
4. A task gives a spanning forest of its links, never pairs. The forests are joined to
   components over written tables.

Defined results: words are maximal runs without ASCII white space, A-Z lower-cased,
compared by their bytes, so texts of any length and any valid UTF-8 are read whole; NULL,
empty and blank texts have the fingerprint zero and link like any other; repeated rows
are rows of their own with one component; a row whose id is NULL takes part, and is never
the smallest id (a component of such rows alone has component_id NULL); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from isobar.session import Scratch

from .common import ship
from .ngram_join import components

SHINGLE = 3
SEED = 42            # fixed value of the fingerprint's hash
RADIUS = 3
GROUP = 4096
DEPTH = 3
CHUNK = 1 << 16      # hashes whose bits are counted at once
BATCH = 1 << 16      # nodes compared at once
PAIRS = 1 << 14      # pairs of lanes compared at once
LINKS = 1 << 20      # links held before they are reduced to a forest
ONE, ALL = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(raw: bytes, size: int = SHINGLE) -> np.ndarray:
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - size + 1)
    last = ends[min(size, len(words)) - 1:]
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)


def fingerprint(raw: bytes, size: int = SHINGLE) -> int:
    """Bits set in over half of the hashes, as an unsigned number."""
    hashes = shingle_hashes(raw, size)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long) of every row."""
    def run(it):
        for pdf in it:
            fp = np.array([fingerprint(bytes(x), size) for x in pdf["raw"]], np.uint64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": fp.view(np.int64)})
    # ids pass through as text: pandas would make numbers with NULLs inexact
    kind = dict(docs.select("doc_id").dtypes)["doc_id"]
    return docs.select(F.col("doc_id").cast("string"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")) \
        .mapInPandas(run, "doc_id string, fp long").withColumn("doc_id", F.col("doc_id").cast(kind))


def _divide(rows: DataFrame, width: int, blocks: int) -> DataFrame:
    """Every row once per block of the ``width`` low bits of ``rest``: the block's value joins the
    key, the other bits stay in ``rest``."""
    cuts = [width * i // blocks for i in range(blocks + 1)]
    parts = []
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        value = F.shiftrightunsigned("rest", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        low = F.col("rest").bitwiseAND(F.lit((1 << lo) - 1))
        high = F.shiftrightunsigned("rest", hi) if hi < 64 else F.lit(0).cast("long")
        parts.append(F.struct((F.col("path") * blocks + i).alias("path"),
                              F.shiftleft("key", hi - lo).bitwiseOR(value).alias("key"),
                              low.bitwiseOR(F.shiftleft(high, lo)).alias("rest")))
    return rows.select("fp", F.explode(F.array(*parts)).alias("p")).select("fp", "p.path", "p.key", "p.rest")


def groups(nodes: DataFrame, scratch: Scratch, radius: int = RADIUS, group: int = GROUP, depth: int = DEPTH) -> DataFrame:
    """(path, key, bi, bj, side, fp): the groups in which nodes meet; side 1 meets side 0 only."""
    rows = nodes.select("fp", F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"))
    blocks, width, found = radius + 1, 64, []
    for level in range(depth):
        rows = scratch.table(_divide(rows, width, blocks), "simhash-keys")
        # the widest block a path can have taken
        width -= width // blocks
        sizes = rows.groupBy("path", "key").agg(F.count("*").alias("size")).filter("size > 1")
        sized = scratch.table(rows.join(sizes, ["path", "key"]), "simhash-sized")
        found.append(sized.filter(F.col("size") <= group).select(
            "path", "key", F.lit(0).alias("bi"), F.lit(0).alias("bj"), F.lit(0).alias("side"), "fp"))
        rows = sized.filter(F.col("size") > group)
        if rows.limit(1).count() == 0:
            rows = None
            break
    if rows is not None:
        n = F.ceil(F.col("size") / group).cast("int")
        own = F.pmod(F.xxhash64("fp"), n).cast("int")
        found.append(rows.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), n - 1))).select(
            "path", "key", F.least("own", "with").alias("bi"), F.greatest("own", "with").alias("bj"),
            (F.col("own") > F.col("with")).cast("int").alias("side"), "fp"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


class Lanes:
    """Bit planes of groups of nodes, 64 nodes to a lane."""

    def __init__(self, parts: list[np.ndarray]):
        n = np.array([-(-len(p) // 64) for p in parts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(n)])
        self.values = np.zeros((int(self.first[-1]), 64), np.uint64)
        self.count = np.zeros(len(self.values), np.int64)
        for p, a, b in zip(parts, self.first[:-1].tolist(), self.first[1:].tolist()):
            self.values[a:b].reshape(-1)[:len(p)] = p
            self.count[a:b] = np.minimum(64, len(p) - 64 * np.arange(b - a))
        self.valid = np.where(self.count == 64, ALL, (ONE << (self.count % 64).astype(np.uint64)) - ONE)
        slot = np.arange(64, dtype=np.uint64)
        self.planes = np.stack([np.bitwise_or.reduce(((self.values >> np.uint64(b)) & ONE) << slot, axis=1)
                                for b in range(64)]) if len(self.values) else np.zeros((64, 0), np.uint64)

    def of(self, part: int) -> np.ndarray:
        return np.arange(self.first[part], self.first[part + 1])


def near_slots(lanes: Lanes, left: np.ndarray, right: np.ndarray, slot: int, radius: int = RADIUS):
    """(pair, word): for each pair of lanes whose left one has a node in ``slot``, the nodes of the
    right one within the radius of it, as the set bits of a word; pairs without any are left out."""
    at = np.flatnonzero(lanes.count[left] > slot)
    node, planes = lanes.values[left[at], slot], lanes.planes[:, right[at]]
    ones, twos, over = (np.zeros(len(at), np.uint64) for _ in range(3))
    valid = lanes.valid[right[at]]
    for b in range(64):
        x = planes[b] ^ (np.uint64(0) - ((node >> np.uint64(b)) & ONE))
        carry = ones & x
        ones ^= x
        over |= twos & carry
        twos ^= carry
        if b % 8 == 7 and b > 8:
            # a lane is abandoned once all its nodes exceed the radius
            alive = (~over & valid) != 0
            if alive.sum() * 2 < len(alive):
                at, node, planes, valid = at[alive], node[alive], planes[:, alive], valid[alive]
                ones, twos, over = ones[alive], twos[alive], over[alive]
    word = ~over & valid
    if radius < 3:       # counts of 0..3 are exact in the two words
        word &= ~twos if radius == 1 else (~(ones & twos) if radius == 2 else ~(ones | twos))
    hit = word != 0
    return at[hit], word[hit]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest item of each item's component."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def forest(meetings: list[tuple[np.ndarray, np.ndarray | None]], radius: int = RADIUS) -> pd.DataFrame:
    """(node, root): spanning edges of the links inside each meeting. A meeting is a group (one
    array of nodes) or two blocks whose nodes are compared across."""
    parts, left, right = [], [], []
    for a, b in meetings:
        parts.extend([a] if b is None else [a, b])
    lanes = Lanes(parts)
    i = 0
    for a, b in meetings:
        p, q = lanes.of(i), lanes.of(i if b is None else i + 1)
        l, r = np.repeat(p, len(q)), np.tile(q, len(p))
        if b is None:
            l, r = l[l <= r], r[l <= r]
        left.append(l)
        right.append(r)
        i += 1 if b is None else 2
    left, right = np.concatenate(left), np.concatenate(right)
    n, values = len(lanes.values) * 64, lanes.values.reshape(-1)
    # places of one value are one node
    _, same = np.unique(values, return_inverse=True)
    xs, ys, held = [], [], 0
    slots = np.arange(64, dtype=np.uint64)

    def reduce():
        nonlocal xs, ys, held
        root = _roots(n, np.concatenate(xs), np.concatenate(ys))
        at = np.flatnonzero(root != np.arange(n))
        xs, ys, held = [at], [root[at]], len(at)
    for lo in range(0, len(left), PAIRS):
        l, r = left[lo:lo + PAIRS], right[lo:lo + PAIRS]
        for slot in range(int(lanes.count[l].max())):
            pair, word = near_slots(lanes, l, r, slot, radius)
            row, bit = np.nonzero((word[:, None] >> slots) & ONE)
            x, y = l[pair[row]] * 64 + slot, r[pair[row]] * 64 + bit
            keep = same[x] != same[y]
            xs.append(x[keep])
            ys.append(y[keep])
            held += int(keep.sum())
            if held > LINKS:
                reduce()
    reduce()
    return pd.DataFrame({"node": values[xs[0]].view(np.int64), "root": values[ys[0]].view(np.int64)})


def _compare(radius: int):
    """Streams nodes ordered by meeting and compares whole meetings, `BATCH` nodes or more at once."""
    def run(it):
        key, sides, waiting, size = None, ([], []), [], 0

        def close():
            a, b = (np.array(s, np.int64).view(np.uint64) for s in sides)
            return (a, b if key[2] != key[3] else None)
        for pdf in it:
            for path, k, bi, bj, side, fp in zip(pdf["path"], pdf["key"], pdf["bi"], pdf["bj"], pdf["side"], pdf["fp"]):
                if (path, k, bi, bj) != key:
                    if key is not None:
                        waiting.append(close())
                        size += len(sides[0]) + len(sides[1])
                        if size >= BATCH:
                            yield forest(waiting, radius)
                            waiting, size = [], 0
                    key, sides = (path, k, bi, bj), ([], [])
                sides[side].append(fp)
        if key is not None:
            yield forest(waiting + [close()], radius)
    return run


def links(nodes: DataFrame, scratch: Scratch, radius: int = RADIUS, group: int = GROUP, depth: int = DEPTH) -> DataFrame:
    """(node, root): edges whose components are those of all pairs within the radius.

    ``nodes``: distinct fp.
    """
    if not 0 <= radius <= 3:
        raise ValueError("radius must lie between 0 and 3")
    order = ["path", "key", "bi", "bj"]
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return groups(nodes, scratch, radius, group, depth).repartition(n, *order).sortWithinPartitions(*order, "side", "fp") \
        .mapInPandas(_compare(radius), "node long, root long")


def near_components(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, group: int = GROUP,
                    depth: int = DEPTH) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id of every row."""
    spark = docs.sparkSession
    ship(spark)
    # the last tables are read by the result and stay
    rows = Scratch(spark).table(fingerprints(docs, size), "simhash-rows")
    with Scratch(spark) as scratch:
        nodes = scratch.table(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-nodes")
        label = components(scratch.table(links(nodes.select("fp"), scratch, radius, group, depth), "simhash-links"))
        named = scratch.table(nodes.join(label.withColumnRenamed("node", "fp"), "fp", "left")
                              .withColumn("label", F.coalesce("label", "fp")), "simhash-labels")
        least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
        found = Scratch(spark).table(named.join(least, "label").select("fp", "component_id"), "simhash-components")
    return rows.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
