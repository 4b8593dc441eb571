"""Vector records: making, upserting and searching."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from gazette.functions.vectors import METRICS, as_doubles, similarity
from gazette.operators.incremental import first_per_key, latest_per_key

# Queries sent to every task at a time.
MAX_SMALL_QUERIES = 1000


def tokens(text: Column) -> Column:
    """Lower-case words of a text, split at white space and ASCII punctuation."""
    return F.array_remove(F.split(F.lower(text), r"[\s\p{Punct}]+"), "")


def embed(
    df: DataFrame,
    text: str,
    dim: int = 256,
    model: Callable[[pd.Series], pd.Series] | None = None,
    output: str = "values",
) -> DataFrame:
    """A vector for every text (V1).

    With a `model` (texts in, lists of float out) it runs batch by batch in the
    tasks. Without one the vector is the L2-normalised count of hashed words,
    the same on every run. A null text has a null vector.
    """
    if model is not None:
        @F.pandas_udf("array<float>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                out = pd.Series([None] * len(batch), index=batch.index, dtype=object)
                known = batch[batch.notna()]
                if len(known):
                    out.loc[known.index] = pd.Series(list(model(known)), index=known.index)
                yield out

        return df.withColumn(output, run(F.col(text)))
    words = df.withColumn("_words", F.coalesce(tokens(F.col(text)), F.array().cast("array<string>")))
    hashed = HashingTF(numFeatures=dim, inputCol="_words", outputCol="_counts").transform(words)
    unit = Normalizer(p=2.0, inputCol="_counts", outputCol="_unit").transform(hashed)
    vector = vector_to_array("_unit", dtype="float32")
    return unit.withColumn(output, F.when(F.col(text).isNotNull(), vector)).drop("_words", "_counts", "_unit")


def vector_records(articles: DataFrame, namespace: str, metadata: Column, values: str = "values") -> DataFrame:
    """Articles with a vector as vector records."""
    return articles.select(
        F.lit(namespace).alias("namespace"), F.col("article_id").alias("id"),
        F.col(values).cast("array<float>").alias("values"), metadata.alias("metadata"),
    )


def split_dimension(vectors: DataFrame, dim: int) -> tuple[DataFrame, DataFrame]:
    """Vectors of the index's dimension, and rejects."""
    right = F.coalesce(F.size("values") == dim, F.lit(False))
    return vectors.filter(right), vectors.filter(~right)


def upserted_vectors(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Vectors after an upsert: `updates` replace by `(namespace, id)` (K8).

    `updates` must hold one row per key.
    """
    both = current.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)))
    return latest_per_key(both, ["namespace", "id"], [F.desc("_new")]).drop("_new")


def _nearest_first(metric: str) -> Column:
    """Vectors without a score, such as one of length zero under cosine, come last."""
    return F.desc_nulls_last("score") if METRICS[metric] else F.asc_nulls_last("score")


def query_vectors(
    index: DataFrame,
    vector: list[float],
    top_k: int,
    namespace: str | None = None,
    filter: dict[str, str] | Column | None = None,
    metric: str = "cosine",
    dim: int | None = None,
) -> DataFrame:
    """The `top_k` vectors nearest to one query, ties by id.

    A dict `filter` asks for equal metadata entries (F10). It and the namespace
    are applied before any score is computed.
    """
    if dim is not None and len(vector) != dim:
        raise ValueError(f"query vector has {len(vector)} elements, the index {dim}")
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {sorted(METRICS)}")
    if namespace is not None:
        index = index.filter(F.col("namespace") == namespace)
    index = index.filter(_metadata_condition(filter))
    query = F.array(*[F.lit(float(x)) for x in vector])
    score = similarity(as_doubles(F.col("values")), query, metric)
    return (
        index.filter(F.size("values") == len(vector))
        .withColumn("score", score)
        .orderBy(_nearest_first(metric), "id")
        .limit(top_k)
        .filter("score IS NOT NULL")
    )


def _metadata_condition(wanted: dict[str, str] | Column | None) -> Column:
    if wanted is None:
        return F.lit(True)
    if isinstance(wanted, Column):
        return wanted
    condition = F.lit(True)
    for key, value in wanted.items():
        condition = condition & (F.col("metadata")[key] == F.lit(value))
    return condition


def search(
    index: DataFrame, queries: DataFrame, top_k: int, metric: str = "cosine",
    filter: dict[str, str] | Column | None = None,
) -> DataFrame:
    """The `top_k` nearest vectors of every query in its namespace.

    A `filter` of metadata is applied before any score is computed (F10). `queries` has `query_id`, `namespace`, `vector`. Up to `MAX_SMALL_QUERIES` of
    them go to every task, which scores a block of vectors against all of them
    and hands on the best `top_k` of the block, so neither the index moves nor
    any pair becomes a row. More queries are taken in groups of that size, one
    pass over the index for each.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {sorted(METRICS)}")
    index = index.filter(_metadata_condition(filter))
    asked = queries.select(
        F.col("query_id").cast("string").alias("query_id"), "namespace",
        as_doubles(F.col("vector")).alias("vector"),
    )
    few = asked.limit(MAX_SMALL_QUERIES + 1).collect()
    if len(few) <= MAX_SMALL_QUERIES:
        blocks = [_block_best(index, few, top_k, metric)]
    else:
        groups = -(-asked.count() // MAX_SMALL_QUERIES)
        group = F.pmod(F.xxhash64("query_id"), F.lit(groups))
        blocks = [
            _block_best(index, asked.filter(group == i).collect(), top_k, metric) for i in range(groups)
        ]
    best = first_per_key(
        reduce(DataFrame.unionByName, blocks), ["query_id", "namespace"], [_nearest_first(metric), F.asc("id")], top_k
    )
    type_ = queries.schema["query_id"].dataType
    return best.withColumn("query_id", F.col("query_id").cast(type_))


def _block_best(index: DataFrame, queries: list, top_k: int, metric: str) -> DataFrame:
    """The best `top_k` of each Arrow batch of the index for each of a few queries."""
    sizes = {len(q["vector"]) for q in queries}
    if len(sizes) > 1:
        raise ValueError(f"query vectors have different lengths: {sorted(sizes)}")
    dim = sizes.pop() if sizes else 0
    asked: dict[str, tuple[list[str], np.ndarray]] = {}
    for name in {q["namespace"] for q in queries}:
        mine = [q for q in queries if q["namespace"] == name]
        asked[name] = ([q["query_id"] for q in mine], np.array([q["vector"] for q in mine], dtype=float))
    sent = index.sparkSession.sparkContext.broadcast(asked)
    stored = index.filter(F.size("values") == dim).filter(F.col("namespace").isin(list(asked)))
    return stored.select(
        "namespace", F.col("id").cast("string").alias("id"), as_doubles(F.col("values")).alias("values")
    ).mapInArrow(
        _block_scorer(sent, dim, top_k, metric), "query_id string, namespace string, id string, score double"
    )


def _block_scorer(sent: Broadcast, dim: int, top_k: int, metric: str) -> Callable:
    """The task function; it holds all it calls, so tasks need not import this package."""
    sign = -1.0 if METRICS[metric] else 1.0

    def scored(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Scores of every vector (rows) for every query (columns)."""
        if metric == "euclidean":
            return np.stack([np.sqrt(((vectors - q) ** 2).sum(axis=1)) for q in queries], axis=1)
        dots = vectors @ queries.T
        if metric == "dotproduct":
            return dots
        with np.errstate(divide="ignore", invalid="ignore"):
            return dots / (np.linalg.norm(vectors, axis=1)[:, None] * np.linalg.norm(queries, axis=1))

    def best(cost: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Positions of the `top_k` lowest costs, ties by id; NaN is no cost."""
        known = np.flatnonzero(~np.isnan(cost))
        if len(known) > top_k:
            bound = np.partition(cost[known], top_k - 1)[top_k - 1]
            known = known[cost[known] <= bound]
        return known[np.lexsort((ids[known].astype(str), cost[known]))][:top_k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("namespace").to_numpy(zero_copy_only=False)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            vectors = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            out: list[tuple[str, str, str, float]] = []
            for name, (query_ids, matrix) in sent.value.items():
                rows = np.flatnonzero(names == name)
                scores = scored(vectors[rows], matrix)
                for query_id, column in zip(query_ids, scores.T):
                    hits = best(sign * column, ids[rows])
                    out += [(query_id, name, ids[rows[i]], column[i]) for i in hits]
            columns = list(zip(*out)) or [[], [], [], []]
            types = [pa.string(), pa.string(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["query_id", "namespace", "id", "score"]
            )

    return run
