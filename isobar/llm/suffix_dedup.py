"""Removal of repeated byte strings by two-stage suffix sorting (operator 8).

Every byte covered by a `WIDTH`-byte string that also starts earlier (smaller
document id, or earlier in the same document) goes.

Suffix sorting is distributed by content. A window of `WIDTH` bytes belongs to
its anchor, the `GRAM`-byte string in it with the smallest hash (leftmost among
equals); consecutive windows with one anchor form a segment. Equal windows have
equal anchors, so only segments whose anchor hash occurs at two places can hold
repeats, and equal windows always meet in the group of their anchor hash:

1. one pass over the texts counts the anchor hashes; those of a single place go;
2. the segments of the rest are cut out and equal segments are merged (all but
   the first occurrence are repeats as a whole);
3. a task takes the different segments of many anchor groups and builds their
   suffix array in two stages (`two_stage_sort`): only the suffixes that are
   smaller than their successors are sorted directly, the rest follow by scans
   over the first-byte buckets. Common prefixes of neighbours give the runs of
   equal windows, and all but the earliest start of a run are repeats.

Groups too large for a task (a very frequent line in many contexts) are not cut
down: their windows are compared by 128-bit hashes with a pre-aggregated
"first of its key" join, which splits.

Step 2 tests anchors against a Bloom filter of the repeated hashes while its size
is at most `filter_bytes`; beyond that the repeated anchors are joined back to
the texts. Both ways give the same result.

Defined results: a NULL text is empty; matches never cross documents; texts
shorter than the width keep everything; rows that repeat both id and text are
one document and get the same result; among different texts of one id the order
is that of their hashes; NULL ids come last; an empty table gives no rows.
Other columns are ignored. Texts are UTF-8, so the byte 0xFF does not occur.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from isobar.session import materialize

from .common import packed, ship
from .hashing import BASE, CHUNK, U, hash_filter, in_filter, mix, rolling

WIDTH = 100
GRAM = 24
SORT_BYTES = 1 << 19       # bytes of segments sorted at once
HOT_SEGMENTS = 1 << 14     # different segments of an anchor that one task may sort
FILTER_BYTES = 32 << 20
NULL_ID = (1 << 63) - 1


def anchor_runs(data: np.ndarray, width: int, gram: int):
    """(hash, anchor position, first window, number of windows) of each run of windows."""
    if len(data) < width:
        z = np.empty(0, np.int64)
        return np.empty(0, np.uint64), z, z, z
    g = rolling(data, gram)
    low = U(CHUNK - 1)   # window positions fit in the low bits
    m = (g & ~low) | np.arange(len(g), dtype=np.uint64)   # smallest hash, then leftmost
    span, left = width - gram + 1, 1
    while left * 2 <= span:
        m = np.minimum(m[:-left], m[left:])
        left *= 2
    if span > left:
        m = np.minimum(m[:len(m) - (span - left)], m[span - left:])
    pos = (m & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], pos[1:] != pos[:-1]]))
    count = np.diff(np.append(first, len(pos)))
    return g[pos[first]], pos[first], first, count


def slices(raw: bytes, width: int):
    """(offset, bytes) pieces of a text that share every window of it once."""
    step = CHUNK - width + 1
    for at in range(0, max(1, len(raw) - width + 1), step):
        yield at, raw[at:at + step + width - 1]


def two_stage_sort(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of ``text``, in which 0 separates segments and sorts by position;
    the order is that of the first ``depth`` bytes at least.

    Stage 1 sorts the suffixes that are smaller than their successors by their
    bytes. Stage 2 scans the first-byte buckets upwards: a suffix in its place
    gives the place of the one before it if that one is larger.
    """
    n = len(text)
    diff = text[:-1].astype(np.int16) - text[1:]
    # a run of equal bytes compares like its end; the last suffix is larger than nothing
    nxt = np.where(diff != 0, np.arange(n - 1), n)
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    smaller = np.zeros(n, dtype=bool)
    has = nxt < n
    smaller[:-1][has] = diff[nxt[has]] < 0
    separators = np.flatnonzero(text == 0)
    direct = np.flatnonzero(smaller & (text != 0))
    ends = separators[np.searchsorted(separators, direct)] if len(direct) else direct
    room = np.concatenate([text, np.zeros(depth, text.dtype)])
    rows = np.lib.stride_tricks.sliding_window_view(room, depth)[direct]
    short = ends - direct < depth
    if short.any():
        cut = (ends - direct)[short]
        rows[short] *= (np.arange(depth)[None, :] < cut[:, None])
    direct = direct[np.argsort(np.ascontiguousarray(rows).view(f"S{depth}").ravel(), kind="stable")]
    heads = np.searchsorted(text[direct], np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def induce(placed: np.ndarray, byte: int) -> None:
        before = placed[placed > 0] - 1
        b = text[before]
        larger = b > byte
        before, b = before[larger], b[larger]
        if len(b):
            order = np.argsort(b, kind="stable")
            b, before = b[order], before[order]
            at = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            for x, part in zip(b[at], np.split(before, at[1:])):
                pending[x].append(part)

    out.append(separators)
    induce(separators, 0)
    for byte in range(1, 256):
        front = pending[byte]
        placed = list(front)
        last = np.concatenate(front) if front else np.empty(0, np.int64)
        while len(last):   # runs of the same byte place each other within the bucket
            before = last[last > 0] - 1
            last = before[text[before] == byte]
            placed.append(last)
        placed.append(direct[heads[byte]:heads[byte + 1]])
        bucket = np.concatenate(placed)
        pending[byte] = []
        if len(bucket):
            out.append(bucket)
            induce(bucket, byte)
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, sa: np.ndarray, width: int) -> np.ndarray:
    """Length of the common prefix of neighbours, up to ``width``."""
    room = np.concatenate([text, np.zeros(width, text.dtype)])
    windows = np.lib.stride_tricks.sliding_window_view(room, width)
    out = np.empty(max(0, len(sa) - 1), np.int64)
    for at in range(0, len(out), 1 << 16):
        a, b = windows[sa[at:at + (1 << 16) + 1][:-1]], windows[sa[at + 1:at + (1 << 16) + 1]]
        differ = a != b
        out[at:at + (1 << 16)] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return out


def repeated_starts(segs: list[bytes], oid, dh, start, width: int):
    """(segment, offset) arrays of windows of the segments that also start earlier."""
    parts = []
    for s in segs:
        parts += [np.frombuffer(s, np.uint8) + 1, np.zeros(1, np.uint8)]
    text = np.concatenate(parts).astype(np.uint8)
    lens = np.array([len(s) + 1 for s in segs])
    base = np.cumsum(lens) - lens
    seg_of = np.repeat(np.arange(len(segs)), lens)
    offset = np.arange(len(text)) - base[seg_of]
    own = offset <= (lens - 1 - width)[seg_of]
    sa = two_stage_sort(text, width + 4)
    sa = sa[own[sa]]
    run = np.concatenate([[0], np.cumsum(common_prefixes(text, sa, width) < width)])
    seg = seg_of[sa]
    at = start[seg] + offset[sa]
    order = np.lexsort((at, dh[seg], oid[seg], run))
    again = np.concatenate([[False], run[order][1:] == run[order][:-1]])
    hit = np.sort(sa[order[again]])
    return seg_of[hit], offset[hit]


def intervals(seg: np.ndarray, offset: np.ndarray):
    """Neighbouring offsets of a segment joined: (segment, first offset, count)."""
    if not len(seg):
        return seg, offset, offset
    first = np.flatnonzero(np.concatenate([[True], (seg[1:] != seg[:-1]) | (offset[1:] != offset[:-1] + 1)]))
    return seg[first], offset[first], np.diff(np.append(first, len(seg)))


def _documents(docs: DataFrame) -> DataFrame:
    """(doc_id, oid, dh, dh2, raw): order key, two text hashes and the bytes."""
    t = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("oid"),
                       F.xxhash64(t).alias("dh"), F.xxhash64(F.lit("second"), t).alias("dh2"),
                       t.cast("binary").alias("raw"))


def _chunks(pdf: pd.DataFrame, width: int):
    """Row numbers and bytes of texts put together, up to CHUNK bytes at a time."""
    rows, parts, total = [], [], 0
    for i, raw in enumerate(pdf["raw"]):
        if len(raw) < width:
            continue
        for at, piece in slices(raw, width):
            if total + len(piece) > CHUNK:
                yield rows, parts
                rows, parts, total = [], [], 0
            rows.append((i, at))
            parts.append(piece)
            total += len(piece)
    if rows:
        yield rows, parts


def _runs(pdf: pd.DataFrame, width: int, gram: int):
    """Per chunk: hash, row, anchor position, window start, windows, and the chunk's bytes with offsets."""
    for rows, parts in _chunks(pdf, width):
        data = np.frombuffer(b"".join(parts), np.uint8)
        lens = np.array([len(p) for p in parts])
        base = np.cumsum(lens) - lens
        h, pos, first, count = anchor_runs(data, width, gram)
        # windows that cross into the next text are no windows: cut the runs at text ends
        piece = np.searchsorted(base, first, side="right") - 1
        last = base[piece] + lens[piece] - width
        crossing = np.flatnonzero(first + count - 1 > last)
        over = [(h, pos, first, np.minimum(count, last - first + 1), piece)]
        for c in crossing:   # a run can reach over several short texts
            p, end = piece[c] + 1, first[c] + count[c]
            while p < len(lens) and base[p] < end:
                lo, hi = max(base[p], first[c]), min(end, base[p] + lens[p] - width + 1)
                if hi > lo:
                    over.append((h[c:c + 1], pos[c:c + 1], np.array([lo]), np.array([hi - lo]), np.array([p])))
                p += 1
        h, pos, first, count, piece = (np.concatenate(x) for x in zip(*over))
        ok = count > 0
        h, pos, first, count, piece = h[ok], pos[ok], first[ok], count[ok], piece[ok]
        row = np.array([r for r, _ in rows])[piece]
        shift = np.array([a for _, a in rows])[piece] - base[piece]
        yield h, row, pos + shift, first + shift, count, data, first


def repeated_anchors(d: DataFrame, width: int, gram: int) -> DataFrame:
    """(h): anchor hashes that occur at two places of the different texts."""
    def places(it):
        for pdf in it:
            dh = pdf["dh"].to_numpy(dtype=np.int64).view(np.uint64)
            for h, row, pos, *_ in _runs(pdf, width, gram):
                with np.errstate(over="ignore"):
                    place = mix(dh[row] + pos.astype(np.uint64) * U(BASE))
                yield pd.DataFrame({"h": h.view(np.int64), "place": place.view(np.int64)})
    return d.select("dh", "raw").mapInPandas(places, "h long, place long") \
        .groupBy("h").agg(F.min("place").alias("a"), F.max("place").alias("b")) \
        .filter("a <> b").select("h")


def _segment_rows(pdf, width, gram, wanted):
    """Segment rows of the runs whose (row, hash) is wanted."""
    oid, dh = pdf["oid"].to_numpy(dtype=np.int64), pdf["dh"].to_numpy(dtype=np.int64)
    for h, row, _, start, count, data, first in _runs(pdf, width, gram):
        at = np.flatnonzero(wanted(h, row))
        if len(at):
            raw = data.tobytes()
            yield pd.DataFrame({
                "h": h[at].view(np.int64), "oid": oid[row[at]], "dh": dh[row[at]], "start": start[at],
                "cnt": count[at].astype(np.int32),
                "seg": [raw[a:b] for a, b in zip(first[at], first[at] + count[at] + width - 1)]})


SEGMENT = "h long, oid long, dh long, start long, cnt int, seg binary"


def segments(d: DataFrame, hashes: DataFrame, width: int, gram: int, filter_bytes: int) -> DataFrame:
    """The segments whose anchor hash is repeated (and, by the filter's errors, a few more)."""
    d = d.select("oid", "dh", "raw")
    n = hashes.count()
    if n * 12 // 8 <= filter_bytes:
        bits = d.sparkSession.sparkContext.broadcast(hash_filter(hashes, n))

        def cut(it):
            for pdf in it:
                yield from _segment_rows(pdf, width, gram, lambda h, row: in_filter(bits.value, h))
        return d.mapInPandas(cut, SEGMENT)

    def anchors(it):
        for pdf in it:
            oid, dh = pdf["oid"].to_numpy(dtype=np.int64), pdf["dh"].to_numpy(dtype=np.int64)
            for h, row, *_ in _runs(pdf, width, gram):
                yield pd.DataFrame({"h": h.view(np.int64), "oid": oid[row], "dh": dh[row]})

    def cut_listed(it):
        for pdf in it:
            listed = [np.unique(np.asarray(x, dtype=np.int64)).view(np.uint64) for x in pdf["listed"]]

            def wanted(h, row):
                ok = np.zeros(len(h), dtype=bool)
                for r in np.unique(row):
                    at = row == r
                    ok[at] = np.isin(h[at], listed[r])
                return ok
            yield from _segment_rows(pdf, width, gram, wanted)
    listed = d.mapInPandas(anchors, "h long, oid long, dh long").join(hashes, "h") \
        .groupBy("oid", "dh").agg(F.collect_set("h").alias("listed"))
    return d.join(listed, ["oid", "dh"]).mapInPandas(cut_listed, SEGMENT)


def first_places(rows: DataFrame, key: list[str], *more) -> DataFrame:
    """Per key its first place, the number of rows, and further aggregates."""
    return rows.groupBy(*key).agg(F.min(F.struct("oid", "dh", "start")).alias("first"),
                                  F.count("*").alias("n"), *more)


def not_first(rows: DataFrame, first: DataFrame, key: list[str]) -> DataFrame:
    """(oid, dh, start, cnt) of the rows that are not the first of their key.

    Keys of a single row leave the join, and its sides can be split where a key is hot.
    """
    return rows.join(first.filter("n > 1").select(*key, "first"), key) \
        .filter(F.struct("oid", "dh", "start") != F.col("first")).select("oid", "dh", "start", "cnt")


def _sort_groups(width: int):
    """Streams rows ordered by anchor hash; whole groups are sorted together up to SORT_BYTES."""
    def flush(rows):
        segs = [r[4] for r in rows]
        oid, dh, start = (np.array([r[i] for r in rows], dtype=np.int64) for i in (1, 2, 3))
        seg, offset, count = intervals(*repeated_starts(segs, oid, dh, start, width))
        return pd.DataFrame({"oid": oid[seg], "dh": dh[seg], "start": start[seg] + offset,
                             "cnt": count.astype(np.int32)})

    def run(it):
        rows, total, group = [], 0, []
        for pdf in it:
            for r in zip(pdf["h"], pdf["oid"], pdf["dh"], pdf["start"], pdf["seg"]):
                if group and r[0] != group[0][0]:
                    if len(group) > 1:
                        rows += group
                        total += sum(len(x[4]) for x in group)
                    group = []
                    if total >= SORT_BYTES:
                        yield flush(rows)
                        rows, total = [], 0
                group.append(r)
        if len(group) > 1:
            rows += group
        if rows:
            yield flush(rows)
    return run


def _windows(width: int):
    """The windows of segments, each with a 128-bit hash."""
    def run(it):
        for pdf in it:
            for h, oid, dh, start, seg in zip(pdf["h"], pdf["oid"], pdf["dh"], pdf["start"], pdf["seg"]):
                data = np.frombuffer(seg, np.uint8)
                k1 = rolling(data, width)
                k2 = rolling(data[::-1], width)[::-1]
                yield pd.DataFrame({"h": h, "k1": k1.view(np.int64), "k2": np.ascontiguousarray(k2).view(np.int64),
                                    "oid": oid, "dh": dh, "start": start + np.arange(len(k1)),
                                    "cnt": np.int32(1)})
    return run


def repeats(d: DataFrame, width: int = WIDTH, gram: int = GRAM, hot_segments: int = HOT_SEGMENTS,
            filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(oid, dh, start, cnt): runs of ``cnt`` windows that also start earlier, copies of whole texts left out."""
    hashes = materialize(repeated_anchors(d, width, gram), "repeated-anchors")
    segs = packed(segments(d, hashes, width, gram, filter_bytes), "segments") \
        .withColumn("s1", F.xxhash64("seg")).withColumn("s2", F.xxhash64(F.lit("second"), F.col("seg")))
    key = ["s1", "s2"]
    different = packed(first_places(segs, key, F.first("h").alias("h"), F.first("seg").alias("seg")),
                       "different-segments")
    marked = not_first(segs.drop("seg", "h"), different, key)
    different = different.select("h", "first.oid", "first.dh", "first.start", "seg")
    sizes = different.groupBy("h").count()
    hot = materialize(sizes.filter(F.col("count") > hot_segments).select("h"), "hot-anchors")
    calm = different.join(hot, "h", "left_anti")
    n = d.sparkSession.conf.get("spark.sql.shuffle.partitions")
    sorted_marks = calm.repartition(int(n), "h").sortWithinPartitions("h") \
        .mapInPandas(_sort_groups(width), "oid long, dh long, start long, cnt int")
    windows = different.join(hot, "h").mapInPandas(
        _windows(width), "h long, k1 long, k2 long, oid long, dh long, start long, cnt int")
    windows = materialize(windows, "hot-windows")
    key = ["h", "k1", "k2"]
    hot_marks = not_first(windows, materialize(first_places(windows, key), "first-windows"), key)
    return marked.unionByName(sorted_marks).unionByName(hot_marks)


def spans_of(marks, n: int, width: int) -> list[tuple[int, int]]:
    """Maximal covered byte spans of a text from its (start, cnt) marks."""
    out: list[list[int]] = []
    for start, cnt in sorted(marks):
        end = min(n, start + cnt - 1 + width)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _removal(docs: DataFrame, width: int, **how) -> DataFrame:
    """(doc_id, raw, copy, marks): each document with what is removed from it."""
    ship(docs.sparkSession)
    d = _documents(docs)
    ids = d.select("oid", "dh", "dh2")
    text = ["dh", "dh2"]
    first = ids.groupBy(*text).agg(F.min("oid").alias("lo"), F.max("oid").alias("hi")) \
        .filter("lo <> hi").select(*text, "lo")
    copies = ids.join(materialize(first, "first-copies"), text).filter("oid <> lo").select("oid", "dh") \
        .withColumn("copy", F.lit(True)).withColumn("start", F.lit(None).cast("long")) \
        .withColumn("cnt", F.lit(None).cast("int"))
    marks = repeats(d, width, **how).withColumn("copy", F.lit(False))
    info = marks.unionByName(copies).groupBy("oid", "dh").agg(
        F.max("copy").alias("copy"),
        F.collect_list(F.when(F.col("start").isNotNull(), F.struct("start", "cnt"))).alias("marks"))
    return d.join(info, ["oid", "dh"], "left").select(
        "doc_id", "raw", F.coalesce("copy", F.lit(False)).alias("copy"), "marks")


def _kept(raw: bytes, copy: bool, marks, width: int) -> tuple[bytes, list[tuple[int, int]]]:
    n = len(raw)
    spans = [(0, n)] if copy and n >= width else \
        spans_of([(m["start"], m["cnt"]) for m in marks], n, width) if marks is not None else []
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    return b"".join(out), spans


def dedup_documents(docs: DataFrame, width: int = WIDTH, **how) -> DataFrame:
    """doc_id, spans array<struct<start, end>>, kept binary: removed byte spans and remaining bytes."""
    def run(it):
        for pdf in it:
            for i, raw, copy, marks in zip(pdf["doc_id"], pdf["raw"], pdf["copy"], pdf["marks"]):
                kept, spans = _kept(bytes(raw), copy, marks, width)
                yield pd.DataFrame({"doc_id": pd.Series([i], dtype=pdf["doc_id"].dtype),
                                    "spans": [[{"start": a, "end": b} for a, b in spans]], "kept": [kept]})
    kind = dict(docs.select("doc_id").dtypes)["doc_id"]
    return _removal(docs, width, **how).mapInPandas(
        run, f"doc_id {kind}, spans array<struct<start: long, end: long>>, kept binary")


def dedup_digest(docs: DataFrame, width: int = WIDTH, **how) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    def run(it):
        for pdf in it:
            out = []
            for raw, copy, marks in zip(pdf["raw"], pdf["copy"], pdf["marks"]):
                kept, spans = _kept(bytes(raw), copy, marks, width)
                out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            f = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            f.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield f
    kind = dict(docs.select("doc_id").dtypes)["doc_id"]
    return _removal(docs, width, **how).mapInPandas(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


# The same in DuckDB SQL (ids unique): every window of every text as hexadecimal digits.
ORACLE = f"""
WITH d AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (
  SELECT doc_id, unnest(generate_series(1, n - {WIDTH - 1})) AS s, x FROM d WHERE n >= {WIDTH}),
k AS (SELECT doc_id, s, md5(substr(x, 2 * s - 1, {2 * WIDTH})) AS k FROM w),
r AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS i FROM k) WHERE i > 1),
g AS (
  SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM (
    SELECT doc_id, s, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + {WIDTH} THEN 1 ELSE 0 END AS fresh FROM r)),
c AS (SELECT doc_id, min(s) AS a, max(s) + {WIDTH - 1} AS b FROM g GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS f, a - 1 AS t FROM c
  UNION ALL SELECT d.doc_id, coalesce(max(c.b), 0) + 1, any_value(d.n) FROM d LEFT JOIN c USING (doc_id) GROUP BY d.doc_id),
kept AS (
  SELECT d.doc_id, string_agg(CASE WHEN t >= f THEN substr(x, 2 * f - 1, 2 * (t - f + 1)) ELSE '' END, '' ORDER BY f) AS h
  FROM gaps JOIN d USING (doc_id) GROUP BY d.doc_id),
spans AS (SELECT doc_id, sum(b - a + 1) AS gone, count(*) AS k FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k, 0) AS BIGINT) AS n_spans, sha256(unhex(h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN spans USING (doc_id)
"""
