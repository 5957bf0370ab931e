"""Similarity of a vector column to a constant vector.

``dot``, ``squared_l2`` and ``cosine`` are plain Column expressions, fit for a few rows or a
rule. Ranking whole tables uses ``similarity_score``: Arrow hands each batch of vectors to
numpy as one matrix without copying, several times faster than a per-element lambda.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

SIMILARITIES = ("cosine", "dot_product", "l2")


def _fold(vector: Column, query: list[float], term) -> Column:
    other = F.array(*[F.lit(float(q)) for q in query])
    return F.aggregate(
        F.zip_with(vector.cast("array<double>"), other, term), F.lit(0.0), lambda a, x: a + x)


def dot(field, query: list[float]) -> Column:
    return _fold(col(field), query, lambda x, q: x * q)


def squared_l2(field, query: list[float]) -> Column:
    return _fold(col(field), query, lambda x, q: (x - q) * (x - q))


def norm(field) -> Column:
    return F.sqrt(F.aggregate(
        col(field).cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x))


def cosine(field, query: list[float]) -> Column:
    length = sum(q * q for q in query) ** 0.5
    return dot(field, query) / (norm(field) * F.lit(length))


def similarity_score(field, query: list[float], similarity: str = "cosine") -> Column:
    """Higher is better: (1+cos)/2, (1+dot)/2 or 1/(1+d²). Null for other dimensions."""
    if similarity not in SIMILARITIES:
        raise ValueError(f"unknown similarity: {similarity!r}")
    wanted = [float(q) for q in query]

    @F.arrow_udf("double")
    def score(vectors):
        import numpy as np
        import pyarrow as pa

        q = np.asarray(wanted)
        sizes = np.asarray(vectors.value_lengths().fill_null(-1))
        fits = np.flatnonzero(sizes == len(q))
        out = np.full(len(sizes), np.nan)
        rows = vectors if len(fits) == len(sizes) else vectors.take(pa.array(fits))
        m = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        m = m.reshape(-1, len(q))
        with np.errstate(divide="ignore", invalid="ignore"):
            if similarity == "l2":
                out[fits] = 1 / (1 + ((m - q) ** 2).sum(axis=1))
            elif similarity == "dot_product":
                out[fits] = (1 + m @ q) / 2
            else:
                out[fits] = (1 + m @ q / (np.sqrt((m * m).sum(axis=1)) * np.sqrt(q @ q))) / 2
        return pa.array(out, mask=np.isnan(out))

    return score(col(field))
