"""An index of a stored collection that answers exactly and opens few of its lists.

Vectors lie in folders by namespace and list: the list of their nearest centre. Beside
them is one row a list with its centre, its number of vectors and its radius, the
largest distance of a vector of the list to the centre. For a query these bound the
best score that a list can hold. The lists that come first by their bound are opened
until they hold enough vectors; of the others only those whose bound reaches the last
of the hits found so far. No list that could hold a better hit stays closed, so the
hits are those of a full scan; how many lists that takes depends on how well the
vectors are clustered.

Vectors that have no place (of length zero under cosine, with null or non-finite numbers)
lie in a list of their own that is always opened.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gazette.functions.vectors import METRICS, as_doubles, dot, norm, similarity
from gazette.operators.clusters import assigned, fit_clusters
from gazette.operators.incremental import first_per_key
from gazette.operators.vectors import _metadata_condition, _nearest_first, query_vectors
from gazette.session import stored
from gazette.sinks.vectors import collection, read_vectors

# Most vectors that centres are fitted on, and vectors of that sample for each centre at least.
SAMPLE, PER_CENTRE = 65_536, 16
UNPLACED = -1
# Computed bounds may be off by rounding.
_SLACK = 1e-9

_INDEXED = "id string, values array<float>, metadata map<string,string>, namespace string, list int"


def _place(values: Column, metric: str) -> Column:
    """Where a vector lies: on the unit sphere for cosine."""
    x = as_doubles(values)
    if metric != "cosine":
        return x
    return F.when(norm(x) > 0, F.transform(x, lambda v: v / norm(x)))


def build_index(spark: SparkSession, path: str, lists: int | None = None, seed: int = 7) -> int:
    """Index the current vectors of a collection; returns the number of centres.

    Without `lists` their number grows with the square root of the vectors, so lists and
    what they hold grow alike, up to one for PER_CENTRE vectors of the sample.
    """
    metric = collection(spark, path)["metric"]
    rows = stored(read_vectors(spark, path).withColumn("place", _place(F.col("values"), metric)), "to-index")
    total = rows.count()
    if lists is None:
        lists = max(1, min(math.isqrt(total), SAMPLE // PER_CENTRE))
    key = F.struct("namespace", "id")
    drawn = rows.select(key.alias("key"), "place").orderBy(F.xxhash64("key")).limit(SAMPLE)
    drawn = stored(drawn.withColumn("key", F.xxhash64("key")), "sample")
    centres = fit_clusters(drawn, "key", "place", lists, seed)[0] if drawn.count() > lists else None
    keyed = rows.withColumn("key", F.concat_ws("\u0000", "namespace", "id"))
    if centres is None:
        found = keyed.select("key").withColumns({"cluster": F.lit(UNPLACED), "distance": F.lit(0.0)}).limit(0)
    else:
        found = stored(assigned(keyed, "key", "place", centres), "lists")
    placed = keyed.join(found, "key", "left").withColumn("list", F.coalesce("cluster", F.lit(UNPLACED)))
    (
        placed.select("id", "values", "metadata", "namespace", "list")
        .repartition("namespace", "list", F.pmod(F.xxhash64("id"), F.lit(4))).write.mode("overwrite")
        .partitionBy("namespace", "list").parquet(f"{path}/index/vectors")
    )
    made = [] if centres is None else [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    named = spark.createDataFrame(made, "list int, centre array<double>")
    placed.groupBy("namespace", "list").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max("distance"), F.lit(0.0)).alias("radius")
    ).join(named, "list", "left").write.mode("overwrite").parquet(f"{path}/index/lists")
    return len(made)


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    """`namespace`, `list`, `n`, `radius`, `centre` of every list."""
    return spark.read.parquet(f"{path}/index/lists").select("namespace", "list", "n", "radius", "centre")


def read_indexed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_INDEXED).parquet(f"{path}/index/vectors")


def _least_cost(vector: Column, centre: Column, radius: Column, metric: str) -> Column:
    """What the best vector of a list costs at least: a distance, or a similarity turned round."""
    if metric == "dotproduct":
        return -(dot(vector, centre) + norm(vector) * radius)
    apart = F.greatest(similarity(vector, centre, "euclidean") - radius, F.lit(0.0))
    return apart if metric == "euclidean" else apart * apart / 2 - 1


def _cost(score: Column, metric: str) -> Column:
    return -score if METRICS[metric] else score


def query_index(
    spark: SparkSession, path: str, namespace: str, vector: list[float], top_k: int,
    filter: dict[str, str] | Column | None = None,
) -> tuple[DataFrame, int]:
    """The `top_k` nearest vectors to one query (T2), and how many lists were opened."""
    properties = collection(spark, path)
    metric, dim = properties["metric"], properties["dim"]
    if len(vector) != dim:
        raise ValueError(f"query vector has {len(vector)} elements, the index {dim}")
    q = np.array(vector, float)
    unit = q / np.linalg.norm(q) if metric == "cosine" and q.any() else q
    query = F.array(*[F.lit(float(x)) for x in unit])
    # at most one row a list: SAMPLE // PER_CENTRE of them and one
    bounds = read_lists(spark, path).filter(F.col("namespace") == namespace).select(
        "list", "n", F.coalesce(_least_cost(query, F.col("centre"), F.col("radius"), metric), F.lit(float("-inf"))).alias("least"),
    ).orderBy("least", "list").collect()
    index = read_indexed(spark, path).filter(F.col("namespace") == namespace)
    hits, opened, wanted = [], 0, top_k
    rest = list(bounds)
    while rest:
        if len(hits) >= top_k:
            last = hits[top_k - 1]["score"]
            last = -last if METRICS[metric] else last
            take = [b for b in rest if b["least"] <= last + _SLACK * (1 + abs(last))]
            rest = []
        else:
            # as many lists as hold what is asked for; twice as much where a filter left too little
            held, upto = 0, 0
            while upto < len(rest) and held < wanted:
                held += rest[upto]["n"]
                upto += 1
            take, rest, wanted = rest[:upto], rest[upto:], 2 * wanted
        if not take:
            break
        opened += len(take)
        some = index.filter(F.col("list").isin([b["list"] for b in take])).drop("list")
        hits += query_vectors(some, list(vector), top_k, None, filter, metric, dim).collect()
        hits.sort(key=lambda r: ((-r["score"] if METRICS[metric] else r["score"]), r["id"]))
        hits = hits[:top_k]
    schema = "id string, values array<float>, metadata map<string,string>, namespace string, score double"
    return spark.createDataFrame([tuple(r) for r in hits], schema), opened


def search_index(
    spark: SparkSession, path: str, queries: DataFrame, top_k: int, filter: dict[str, str] | Column | None = None,
) -> DataFrame:
    """The `top_k` nearest vectors of every query in its namespace (J6): `query_id`, `namespace`, `id`, `score`.

    `queries` has `query_id`, `namespace`, `vector`. Two passes, whatever the number of
    queries: lists that hold enough come first, and give each query a last hit; the
    lists whose bound reaches it come second. A vector meets the queries that ask for
    its list, and each task hands on its best hits only.
    """
    metric = collection(spark, path)["metric"]
    asked = queries.select("query_id", "namespace", as_doubles(F.col("vector")).alias("vector"))
    place = F.coalesce(_place(F.col("vector"), metric), F.col("vector"))
    pairs = asked.join(read_lists(spark, path), "namespace").withColumn("least", F.coalesce(
        _least_cost(place, F.col("centre"), F.col("radius"), metric), F.lit(float("-inf"))))
    order = Window.partitionBy("query_id", "namespace").orderBy("least", "list")
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    pairs = stored(pairs.select(
        "query_id", "namespace", "vector", "list", "least", (F.coalesce(before, F.lit(0)) < top_k).alias("soon")), "asked-lists")
    index = read_indexed(spark, path).filter(_metadata_condition(filter))
    best = [_nearest_first(metric), F.asc("id")]

    def hits(some: DataFrame) -> DataFrame:
        met = index.join(some.select("query_id", "namespace", "vector", "list"), ["namespace", "list"]).filter(
            F.size("values") == F.size("vector"))
        scored = met.select("query_id", "namespace", "id", similarity(
            as_doubles(F.col("values")), F.col("vector"), metric).alias("score")).filter("score IS NOT NULL")
        return first_per_key(scored, ["query_id", "namespace"], best, top_k)

    first = stored(hits(pairs.filter("soon")), "first-hits")
    cost = _cost(F.col("score"), metric)
    last = first.groupBy("query_id", "namespace").agg(
        F.max(cost).alias("last"), F.count(F.lit(1)).alias("found")).filter(F.col("found") >= top_k)
    later = pairs.filter("NOT soon").join(last, ["query_id", "namespace"], "left").filter(
        F.col("last").isNull() | (F.col("least") <= F.col("last") + _SLACK * (1 + F.abs("last"))))
    return first_per_key(first.unionByName(hits(later)), ["query_id", "namespace"], best, top_k)
