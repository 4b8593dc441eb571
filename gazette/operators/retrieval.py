"""Search for articles by their words, and by words and vectors together.

The index is a table of posting lists: for each term and block of articles, which of
them have it, how often, and how long they are, in folders by the term's hash, so a
query reads the folders of its own terms only. Scores are BM25; lists of hits are
joined by reciprocal rank.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gazette.operators.incremental import first_per_key
from gazette.operators.vectors import tokens

# Usual weights of BM25, and of reciprocal ranks.
K1, B = 1.2, 0.75
RANK_SHIFT = 60
# Folders of terms.
BUCKETS = 64
# Words and articles from which a task closes a block.
BLOCK_WORDS, BLOCK_ARTICLES = 1 << 21, 1 << 14

_LISTS = "term string, ids array<string>, ns array<int>, lengths array<int>"
_POSTINGS = f"{_LISTS}, bucket int"


def _bucket(term, buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _posting_lists(block_words: int, block_articles: int) -> Callable:
    """The task function; it holds all it calls, so tasks need not import this package."""

    def lists(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        """The posting lists of one block: words are numbered, then word and article are counted as one number."""
        table = pa.Table.from_batches(parts).combine_chunks()
        ids, words = table.column("id").combine_chunks(), table.column("words").combine_chunks()
        length = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int32)
        coded = words.flatten().dictionary_encode()
        place = np.repeat(np.arange(len(ids)), length)
        pairs, n = np.unique(coded.indices.to_numpy().astype(np.int64) * len(ids) + place, return_counts=True)
        article = pairs % len(ids)
        offsets = np.zeros(len(coded.dictionary) + 1, np.int32)
        np.cumsum(np.bincount(pairs // len(ids), minlength=len(coded.dictionary)), out=offsets[1:])
        per_term = lambda values: pa.ListArray.from_arrays(pa.array(offsets), values)
        # the block's totals stand beside its first term
        first = np.arange(len(coded.dictionary)) == 0
        return pa.record_batch({
            "term": coded.dictionary, "ids": per_term(ids.take(pa.array(article))),
            "ns": per_term(pa.array(n.astype(np.int32))), "lengths": per_term(pa.array(length[article])),
            "articles": pa.array(np.where(first, len(ids), 0)), "words": pa.array(np.where(first, length.sum(), 0))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_words, n_articles = [], 0, 0
        for batch in batches:
            length = pc.fill_null(pc.list_value_length(batch.column("words")), 0)
            batch = batch.filter(pc.greater(length, 0))
            upto = np.cumsum(length.filter(pc.greater(length, 0)).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < len(upto):
                before = int(upto[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(upto, before + block_words - n_words, "right")))
                to = min(to, at + block_articles - n_articles)
                held.append(batch.slice(at, to - at))
                n_words, n_articles = n_words + int(upto[to - 1]) - before, n_articles + to - at
                # a block is closed as well when the next article would not go in any more
                if to < len(upto) or n_words >= block_words or n_articles >= block_articles:
                    yield lists(held)
                    held, n_words, n_articles = [], 0, 0
                at = to
        if held:
            yield lists(held)

    return run


def postings(articles: DataFrame, key: str, text: str) -> DataFrame:
    """`term`, `ids`, `ns` (occurrences) and `lengths` (words of the article), a row for each term of a block.

    A task counts the words of a block of its articles at once; what leaves it is a row for
    each different term of the block, however many articles have it. `articles` and `words`
    are the block's totals on one of its rows, zero on the others. An article without words
    is in no block; rows that repeat a key are articles of their own.
    """
    split = articles.select(F.col(key).cast("string").alias("id"), tokens(F.col(text)).alias("words"))
    return split.mapInArrow(
        _posting_lists(BLOCK_WORDS, BLOCK_ARTICLES), f"{_LISTS}, articles bigint, words bigint")


def write_index(articles: DataFrame, key: str, text: str, path: str, buckets: int = BUCKETS) -> None:
    """Posting lists in folders by bucket, sorted by term, and one row of totals (articles, words, buckets).

    Articles are read once. Their lists are shuffled once, by bucket and a part of the block,
    so a term that most articles have is written by several tasks.
    """
    rows = postings(articles, key, text).withColumn("bucket", _bucket("term", buckets))
    part = F.pmod(F.xxhash64(F.get("ids", F.lit(0))), F.lit(8))
    (
        rows.repartition("bucket", part).sortWithinPartitions("bucket", "term")
        .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    )
    totals = articles.sparkSession.read.schema("articles bigint, words bigint").parquet(f"{path}/postings")
    totals.agg(
        F.coalesce(F.sum("articles"), F.lit(0)).alias("articles"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")
    ).withColumn("buckets", F.lit(buckets)).write.mode("overwrite").parquet(f"{path}/totals")


def query_terms(spark: SparkSession, queries: Mapping[str, str]) -> DataFrame:
    """`query`, `term` of a few queries by name, each term once."""
    asked = spark.createDataFrame(list(queries.items()), "query string, text string")
    return asked.select("query", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))


def search_words(spark: SparkSession, path: str, queries: Mapping[str, str], top_k: int) -> DataFrame:
    """`query`, `id`, `score`, `rank` of the `top_k` articles by BM25 for each query, ties by id.

    Queries are few and come from the caller: their terms are named in the scan, which
    reads the folders of those terms. Rows that repeat a key and a length are one article.
    A task hands on its best `top_k` only.
    """
    totals = spark.read.parquet(f"{path}/totals").first()
    asked = query_terms(spark, queries)
    terms = [r["term"] for r in asked.select("term").distinct().collect()]
    buckets = [
        r["bucket"] for r in asked.select(_bucket("term", totals["buckets"]).alias("bucket")).distinct().collect()]
    found = spark.read.schema(_POSTINGS).parquet(f"{path}/postings").filter(
        F.col("bucket").isin(buckets) & F.col("term").isin(terms)).select(
        "term", F.inline(F.arrays_zip("ids", "ns", "lengths")).alias("id", "n", "length")).groupBy(
        "id", "term", "length").agg(F.sum("n").alias("n"))
    rarity = found.groupBy("term").agg(F.count(F.lit(1)).alias("df")).withColumn(
        "idf", F.log(1 + (totals["articles"] - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    mean = totals["words"] / max(1, totals["articles"])
    weight = F.col("idf") * F.col("n") * (K1 + 1) / (F.col("n") + K1 * (1 - B + B * F.col("length") / mean))
    scores = (
        found.join(F.broadcast(asked.join(rarity, "term")), "term")
        .groupBy("query", "id").agg(F.sum(weight).alias("score")))
    return ranked(scores, top_k)


def ranked(scores: DataFrame, top_k: int) -> DataFrame:
    """The `top_k` best rows of each query with their `rank`; scores equal to nine places tie by id."""
    order = [F.desc(F.round("score", 9)), F.asc("id")]
    best = first_per_key(scores, ["query"], order, top_k)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))


def fused(hits: list[DataFrame], top_k: int) -> DataFrame:
    """Lists of hits (`query`, `id`, `rank`) joined by reciprocal rank: `query`, `id`, `score`, `rank`.

    An article counts with 1 / (60 + rank) in each list that has it; every list is
    short, at most its own `top_k` a query.
    """
    parts = [h.select("query", F.col("id").cast("string").alias("id"), (1 / (RANK_SHIFT + F.col("rank"))).alias("part")) for h in hits]
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return ranked(every.groupBy("query", "id").agg(F.sum("part").alias("score")), top_k)


def with_articles(hits: DataFrame, articles: DataFrame, key: str) -> DataFrame:
    """Hits with the articles they name: the hits are few, the articles are not moved."""
    return articles.withColumn("id", F.col(key).cast("string")).join(F.broadcast(hits), "id").drop("id")
