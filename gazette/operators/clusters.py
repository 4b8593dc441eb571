"""Clusters of vectors (R2): k-means|| start, Lloyd steps as aggregates, a stop rule.

Centres are few and travel to the tasks; each task assigns the vectors of its batches
and hands on one sum a centre, so a step shuffles as many rows as tasks times centres
and no vector. Steps end when the loss falls by less than a share of itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from gazette.functions.vectors import as_doubles

# A step that lowers the loss by less than this share is the last one.
LEAST_GAIN = 1e-3


def _usable(vectors: DataFrame, key: str, values: str) -> DataFrame:
    """Key and vector as doubles; null vectors and those with null or non-finite numbers are left out."""
    odd = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.select(F.col(key).alias("key"), as_doubles(F.col(values)).alias("x")).filter(
        (F.size("x") > 0) & ~odd)


def start(vectors: DataFrame, key: str, values: str, k: int, seed: int = 7) -> np.ndarray:
    """`k` centres by k-means||: vectors drawn in rounds by their distance to those drawn before."""
    rows = _usable(vectors, key, values).select(array_to_vector("x").alias("features"))
    model = KMeans(k=k, initMode="k-means||", maxIter=0, seed=seed).fit(rows)
    return np.array(model.clusterCenters())


def _nearest():
    """The task function of both passes; it holds all it calls, so tasks need not import this package."""

    def near(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1), 0)
        own = far.argmin(axis=1)
        return own, far[np.arange(len(x)), own]

    return near


def _sums(centres: np.ndarray):
    near, (k, dim) = _nearest(), centres.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, counts, loss = np.zeros((k, dim)), np.zeros(k, np.int64), np.zeros(k)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            if len(x):
                own, far = near(x, centres)
                counts += np.bincount(own, minlength=k)
                loss += np.bincount(own, far, minlength=k)
                np.add.at(total, own, x)
        at = np.flatnonzero(counts)
        yield pa.record_batch({
            "cluster": pa.array(at.astype(np.int32)), "n": pa.array(counts[at]), "loss": pa.array(loss[at]),
            "total": pa.array(list(total[at]), pa.list_(pa.float64()))})

    return work


def _assign(centres: np.ndarray):
    near, dim = _nearest(), centres.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            own, far = near(x, centres) if len(x) else (np.zeros(0, int), np.zeros(0))
            yield pa.record_batch({
                "key": batch.column("key"), "cluster": pa.array(own.astype(np.int32)), "distance": pa.array(np.sqrt(far))})

    return work


def step(vectors: DataFrame, key: str, values: str, centres: np.ndarray) -> tuple[np.ndarray, float]:
    """Centres after one Lloyd step, and the loss before it; a centre without vectors stays."""
    dim = centres.shape[1]
    rows = _usable(vectors, key, values).filter(F.size("x") == dim).select("x")
    parts = rows.mapInArrow(_sums(centres), "cluster int, n bigint, loss double, total array<double>")
    sums = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.sum("loss").alias("loss"),
        F.array(*[F.sum(F.col("total")[i]) for i in range(dim)]).alias("total"))
    moved, loss = centres.copy(), 0.0
    for r in sums.collect():  # one row a centre
        moved[r["cluster"]] = np.array(r["total"]) / r["n"]
        loss += r["loss"]
    return moved, loss


def fit_clusters(
    vectors: DataFrame, key: str, values: str, k: int, seed: int = 7, steps: int = 20, least_gain: float = LEAST_GAIN,
    centres: np.ndarray | None = None,
) -> tuple[np.ndarray, list[float]]:
    """Centres and the loss before each step; from a k-means|| start unless `centres` are given."""
    centres = start(vectors, key, values, k, seed) if centres is None else np.asarray(centres, float)
    losses: list[float] = []
    for _ in range(steps):
        moved, loss = step(vectors, key, values, centres)
        losses.append(loss)
        if len(losses) > 1 and losses[-2] - loss <= least_gain * losses[-2]:
            break
        centres = moved
    return centres, losses


def assigned(vectors: DataFrame, key: str, values: str, centres: np.ndarray) -> DataFrame:
    """`key`, `cluster` and `distance` of every usable vector: its nearest centre, the first of equal ones."""
    rows = _usable(vectors, key, values).filter(F.size("x") == centres.shape[1])
    kind = vectors.schema[key].dataType.simpleString()
    return rows.mapInArrow(_assign(centres), f"key {kind}, cluster int, distance double").withColumnRenamed("key", key)
