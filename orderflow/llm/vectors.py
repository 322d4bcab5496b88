"""Vector columns as numpy matrices, and a small k-means."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension(rows: DataFrame, column: str) -> int:
    """Length of the longest vector (0 without any)."""
    return rows.agg(F.max(F.size(column))).first()[0] or 0


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows x dim float64 matrix, whether a row is a vector of finite
    components).  Shorter vectors are padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    length = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    flat = np.asarray(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    out = np.zeros((n, dim))
    if len(flat):
        row = np.repeat(np.arange(n), length)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    ok = np.asarray(column.is_valid()) & np.isfinite(out).all(axis=1)
    return out, ok


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of length one, whether a vector has a direction)."""
    top = np.abs(vectors).max(axis=1, initial=0.0)
    ok = top > 0
    scaled = vectors / np.where(ok, top, 1.0)[:, None]
    norm = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
    return scaled / np.where(ok, norm, 1.0)[:, None], ok


def centroids(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means of unit vectors; a centroid that loses all its
    vectors starts anew at the vector that fits its own centroid least."""
    rng = np.random.default_rng(seed)
    k = min(k, len(sample))
    found = sample[np.sort(rng.choice(len(sample), k, replace=False))]
    for _ in range(rounds):
        near = sample @ found.T
        own = near.argmax(axis=1)
        size = np.bincount(own, minlength=k)
        total = np.zeros_like(found)
        np.add.at(total, own, sample)
        for c, worst in zip(np.flatnonzero(size == 0), np.argsort(near[np.arange(len(sample)), own])):
            total[c] = sample[worst]
        found = unit(total)[0].astype(sample.dtype)
    return found


