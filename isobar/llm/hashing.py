"""Vectorised hashing of bytes and a Bloom filter made by tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

U = np.uint64
BASE = 0x9E3779B97F4A7C15
CHUNK = 1 << 20            # bytes hashed at once
FILTER_BLOCK = 1 << 16     # bytes of one block of the filter
FILTER_HASHES = 4


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Tables:
    """Byte values and powers of the rolling hash (made once per worker)."""
    made: dict[int, "Tables"] = {}

    def __init__(self):
        with np.errstate(over="ignore"):
            self.byte = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD1342543DE82EF95))
            n = CHUNK + 1
            self.power = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, BASE, np.uint64)]), dtype=np.uint64)
            inverse = pow(BASE, -1, 1 << 64)
            self.inverse = np.cumprod(np.concatenate([[U(1)], np.full(n - 1, inverse, np.uint64)]), dtype=np.uint64)

    @classmethod
    def get(cls) -> "Tables":
        if 0 not in cls.made:
            cls.made[0] = cls()
        return cls.made[0]


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width``-byte string of ``data`` (at most CHUNK bytes)."""
    t = Tables.get()
    with np.errstate(over="ignore"):
        c = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(t.byte[data] * t.power[:len(data)], out=c[1:])
        return mix((c[width:] - c[:-width]) * t.inverse[:len(c) - width])


def _filter_positions(h: np.ndarray, n_blocks: int):
    block = h % U(n_blocks)
    for i in range(FILTER_HASHES):
        with np.errstate(over="ignore"):
            x = mix(h + U((i + 1) * BASE % (1 << 64)))
        yield block * U(FILTER_BLOCK * 8) + x % U(FILTER_BLOCK * 8)


def hash_filter(hashes: DataFrame, n: int) -> np.ndarray:
    """Bits of a blocked Bloom filter; the blocks are made by tasks."""
    n_blocks = max(1, -(-n * 12 // (FILTER_BLOCK * 8)))

    def block(key, pdf):
        bits = np.zeros(FILTER_BLOCK * 8, np.uint8)
        h = pdf["h"].to_numpy(dtype=np.int64).view(np.uint64)
        for p in _filter_positions(h, n_blocks):
            bits[(p - U(key[0] * FILTER_BLOCK * 8)).astype(np.int64)] = 1
        return pd.DataFrame({"b": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})
    # the same block as h % n_blocks on unsigned values
    @F.pandas_udf("long")
    def block_of(h: pd.Series) -> pd.Series:
        return pd.Series((h.to_numpy(dtype=np.int64).view(np.uint64) % U(n_blocks)).astype(np.int64))
    made = hashes.withColumn("b", block_of("h")).groupBy("b").applyInPandas(block, "b long, bits binary").collect()
    out = np.zeros((n_blocks, FILTER_BLOCK), np.uint8)
    for r in made:
        out[r["b"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def in_filter(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    n_blocks = len(bits) // FILTER_BLOCK
    ok = np.ones(len(h), dtype=bool)
    for p in _filter_positions(h, n_blocks):
        ok &= (bits[(p >> U(3)).astype(np.int64)] >> (p & U(7)).astype(np.uint8)) & 1 == 1
    return ok
