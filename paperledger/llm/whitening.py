"""Whitening of embeddings by a bidiagonal qd solver.

Components become whole numbers x = floor(64 c) + 1,000,000. Spark counts the rows and sums each dimension exactly. Rows centred
exactly (n x - S, whole numbers, then over n) are reduced by blockwise QR: a task folds its batches into one triangle, and
16 tasks fold the triangles of all others, so that the driver gets 16 triangles whatever the corpus. One triangle R is left, and
RᵀR / n is the covariance, which is never formed. `bidiagonal.py` takes its singular values by Householder bidiagonal form and
dqds, its right singular vectors by twisted factorisations. A row's whitened components are its centred vector times the unit
eigenvectors over the roots of their eigenvalues. `identity_error` is measured over the whitened rows by one more aggregate.

Rows with a null or empty vector, null or non-finite entries take no part, nor do those of another length than most vectors,
or with an entry over 2^52 / 64. Rows that repeat count and return each; a null vec_id stays null. Directions without variance
(a singular value under 1e-11 of the largest) are no components; a table of one row, of equal rows or without rows gives no
rows. A deviation that no long holds is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from paperledger.llm.bidiagonal import right_singular
from paperledger.llm.frames import as_text, numbers
from paperledger.llm.vectors import whole_vectors

FACTOR = 64
OFFSET = 1_000_000
COMPONENTS = 32
FOLDERS = 16

ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy())


def moments(vectors: DataFrame, length: int) -> tuple[int, list[int]]:
    """Rows and exact sums by dimension; each task sends one row for each dimension."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, sums = 0, [0] * length
        for batch in batches:
            # Halves of 32 bits: their sums over a batch fit a long.
            x = matrix(batch["x"])
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            sums = [s + (int(h) << 32) + int(w) for s, h, w in zip(sums, high, low)]
            n += len(x)
        if n:
            yield pd.DataFrame({"dim": np.arange(length), "n": n, "total": [str(s) for s in sums]})

    found = vectors.select("x").mapInPandas(partial, "dim int, n long, total string")
    rows = found.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    by_dim = {r["dim"]: r for r in rows}
    return (by_dim[0]["n"], [int(by_dim[d]["total"]) for d in range(length)]) if rows else (0, [])


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: longs if they hold it, else Python's whole numbers."""
    largest = max(int(np.abs(x).max(initial=0)) * n, *(abs(s) for s in sums))
    if largest < 1 << 62:
        return x * n - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def deviations(y: np.ndarray) -> list[int | None]:
    """Sums of squares by row; null where no long holds it."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * y.shape[1] < 1 << 62:
        return (y * y).sum(axis=1).tolist()
    exact = (y.astype(object) ** 2).sum(axis=1)
    return [v if v < 1 << 63 else None for v in exact]


def triangle(vectors: DataFrame, length: int, n: int, sums: list[int]) -> np.ndarray:
    """R of the QR of all centred rows."""

    def folded(blocks: Iterator[np.ndarray]) -> Iterator[pd.DataFrame]:
        r = np.zeros((0, length))
        for block in blocks:
            r = np.linalg.qr(np.vstack([r, block]), mode="r")
        if len(r):
            yield pd.DataFrame({"r": [r.ravel()]})

    def of_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return folded(centred(matrix(b["x"]), n, sums).astype(np.float64) / n for b in batches if len(b))

    def of_triangles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return folded(r.reshape(-1, length) for b in batches for r in b["r"])

    parts = vectors.select("x").mapInPandas(of_rows, "r array<double>")
    parts = parts.repartition(FOLDERS).mapInPandas(of_triangles, "r array<double>").collect()
    return np.linalg.qr(np.vstack([np.reshape(p["r"], (-1, length)) for p in parts]), mode="r")


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each row that takes part and each component."""
    vectors, length = whole_vectors(rows, vector, FACTOR, float(1 << 52), as_text("vec_id"))
    vectors = vectors.withColumn("x", F.transform("x", lambda v: v + OFFSET))
    spark = rows.sparkSession
    n, sums = moments(vectors, length) if length else (0, [])
    if not n:
        return spark.createDataFrame([], ROWS)
    r = triangle(vectors, length, n, sums)
    squares, directions = right_singular(r)
    eigenvalues, total = squares[:components] / n, float((r * r).sum()) / n
    k = len(eigenvalues)
    if not k:
        return spark.createDataFrame([], ROWS)
    weights = directions[:, :k] / np.sqrt(eigenvalues)

    def projected(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = centred(x, n, sums)
        return y, (y.astype(np.float64) / n) @ weights

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        second, first = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            z = projected(matrix(batch["x"]))[1]
            second += z.T @ z
            first += z.sum(axis=0)
        yield pd.DataFrame({"place": np.arange(k * k + k), "v": np.concatenate([second.ravel(), first])})

    measured = vectors.select("x").mapInPandas(products, "place int, v double").groupBy("place").agg(F.sum("v").alias("v")).collect()
    flat = np.array([r["v"] for r in sorted(measured, key=lambda r: r["place"])]) / n
    covariance = flat[:k * k].reshape(k, k) - np.outer(flat[k * k:], flat[k * k:])
    error = float(np.abs(covariance - np.eye(k)).max())

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                y, z = projected(matrix(batch["x"]))
                yield pd.DataFrame({"vec_id": numbers(batch["vec_id"]), "deviation": pd.array(deviations(y), "Int64"), "z": list(z)})

    explained = F.array(*(F.lit(float(e / total)) for e in eigenvalues))
    found = vectors.mapInPandas(written, "vec_id long, deviation long, z array<double>")
    found = found.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
    return found.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
