"""Helpers of the vector operators: valid rows, bounded training sample, k-means, blocks of lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_finite(vector: Column) -> Column:
    """The vector is there and every component is a number."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(good, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(n, -1) if n else np.zeros((0, 0), dtype)


def sample_rows(vectors: DataFrame, column: str, by: str, most: int) -> np.ndarray:
    """At most ``most`` vectors, chosen by a hash of ``by``: the bounded sample that an index is trained on."""
    rows = vectors.select(column, F.xxhash64(by).alias("_h")).orderBy("_h").limit(most).select(column)
    return matrix(rows.toArrow().column(0))


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(1), 0.0)


def nearest(x: np.ndarray, centers: np.ndarray, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest centre of every row and its squared distance, for ``rows`` rows at a time."""
    own, most = np.zeros(len(x), np.int64), np.zeros(len(x))
    half = (centers * centers).sum(1) / 2
    for at in range(0, len(x), rows):
        score = x[at : at + rows] @ centers.T
        score -= half
        own[at : at + rows] = near = score.argmax(1)
        most[at : at + rows] = score[np.arange(len(score)), near]
    return own, np.maximum((x * x).sum(1) - 2 * most, 0.0)


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Centres by Lloyd's rounds from distinct rows; an empty centre moves to the row farthest from its own."""
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own, least = nearest(x, centers)
        count = np.bincount(own, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        full = count > 0
        centers[full] = sums[full] / count[full, None]
        if not full.all():
            far = np.argsort(least)[::-1][: (~full).sum()]
            centers[~full] = x[far]
    return centers


def list_count(n: int, most: int = 1024) -> int:
    return int(np.clip(round(n**0.5), 1, most))


def blocks_of_lists(counts: dict[int, int], lists: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of every list, so that a block has about ``rows`` rows: long lists get several, short ones share."""
    first, parts = np.zeros(lists, np.int64), np.ones(lists, np.int64)
    at = filled = 0
    for k in range(lists):
        n = counts.get(k, 0)
        if n > rows:
            at += bool(filled)
            first[k], parts[k], filled = at, -(-n // rows), 0
            at += parts[k]
            continue
        if filled + n > rows:
            at, filled = at + 1, 0
        first[k] = at
        filled += n
    return first, parts
