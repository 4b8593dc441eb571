"""Stored vectors and the properties of their collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from gazette.functions.vectors import METRICS
from gazette.operators.incremental import latest_per_key
from gazette.operators.vectors import query_vectors, split_dimension
from gazette.schemas import VECTOR
from gazette.sinks.bucketed import Bucketed, read_bucketed, write_bucketed
from gazette.sources.files import none_if_missing

_PROPERTIES = "dim int, metric string"


def create_collection(spark: SparkSession, path: str, dim: int, metric: str) -> Row:
    """Fix dimension and metric of a collection if it is new (K9); returns those in force."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {sorted(METRICS)}")
    stored = none_if_missing(lambda: spark.read.schema(_PROPERTIES).json(f"{path}/properties"))
    if stored is None:
        spark.createDataFrame([(dim, metric)], _PROPERTIES).write.json(f"{path}/properties")
    return collection(spark, path)


def collection(spark: SparkSession, path: str) -> Row:
    """Dimension and metric of a collection; one that was never made is an error."""
    stored = none_if_missing(lambda: spark.read.schema(_PROPERTIES).json(f"{path}/properties"))
    if stored is None:
        raise KeyError(f"no vector collection at {path}")
    return stored.first()


def vector_table(path: str, buckets: int) -> Bucketed:
    """The vectors as a table bucketed by id."""
    return Bucketed(f"{path}/vectors", f"{VECTOR}, batch_id bigint", "id", buckets, ("namespace", "batch_id"))


def upsert_vectors(vectors: DataFrame, path: str, batch_id: int = 0, buckets: int | None = None) -> None:
    """Store vectors of one batch (K8); later batches win by `(namespace, id)`.

    Vectors of another dimension go to the `rejects` folder. A batch written
    again replaces itself; of two rows with one key in a batch the same one stays.
    With `buckets` (the same for all of a collection) later reads do not move them.
    """
    dim = collection(vectors.sparkSession, path)["dim"]
    kept, rejects = split_dimension(vectors, dim)
    latest = latest_per_key(kept, ["namespace", "id"], [F.asc(F.xxhash64("values"))])
    latest = latest.withColumn("batch_id", F.lit(batch_id).cast("long"))
    if buckets:
        write_bucketed(latest, vector_table(path, buckets))
    else:
        (
            latest.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("namespace", "batch_id")
            .parquet(f"{path}/vectors")
        )
    rejects.write.mode("overwrite").parquet(f"{path}/rejects/batch_id={batch_id}")


def read_vectors(
    spark: SparkSession, path: str, namespace: str | None = None, buckets: int | None = None
) -> DataFrame:
    """The current vectors, of one namespace if given; other namespaces are not read."""
    schema = f"{VECTOR}, batch_id bigint"
    if buckets:
        rows = read_bucketed(spark, vector_table(path, buckets))
    else:
        rows = none_if_missing(lambda: spark.read.schema(schema).parquet(f"{path}/vectors"))
    if rows is None:
        return spark.createDataFrame([], VECTOR)
    if namespace is not None:
        rows = rows.filter(F.col("namespace") == namespace)
    latest = latest_per_key(rows, ["namespace", "id"], [F.desc("batch_id")])
    return latest.select("namespace", "id", "values", "metadata")


def query_collection(
    spark: SparkSession, path: str, namespace: str, vector: list[float], top_k: int,
    filter: dict[str, str] | None = None,
) -> DataFrame:
    """T2 on a stored collection, by its own metric and dimension."""
    properties = collection(spark, path)
    return query_vectors(
        read_vectors(spark, path, namespace), vector, top_k, namespace, filter,
        properties["metric"], properties["dim"],
    )
