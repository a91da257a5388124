"""Packing of embedding rows for block-wise work in Python tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


def clean_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id long, v array<double>) of the rows that take part: id and vector
    given, every component given and finite."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & finite) \
        .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def matrix(vectors, dim: int) -> np.ndarray:
    """Rows of equal length; shorter vectors count as filled up with zeros."""
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def pack(pdf: pd.DataFrame, dim: int, transform=None) -> tuple[bytes, bytes, int]:
    """Ids and vectors of a block as bytes, in id order."""
    ids = pdf["vec_id"].to_numpy(dtype=np.int64)
    order = np.argsort(ids, kind="stable")
    m = matrix(pdf["v"].to_numpy(), dim)[order]
    if transform is not None:
        m = transform(m)
    return ids[order].tobytes(), m.tobytes(), len(ids)


def unpack(ids: bytes, vecs: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    m = np.frombuffer(vecs, dtype=np.float64)
    return np.frombuffer(ids, dtype=np.int64), m.reshape(n, len(m) // n if n else 0)
