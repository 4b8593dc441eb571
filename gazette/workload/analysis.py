"""Queries of analysis: classification, search, clusters, cost."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from gazette.operators import classify, clusters, counts, mergeable, retrieval, vectors
from gazette.session import shared_dir
from gazette.sinks import vector_index, vectors as vector_store
from gazette.sources import pages as page_source
from gazette.workload import tables as t
from gazette.workload.queries import _rounded, query

# Five questions, one of them with words that no document has.
QUESTIONS = {
    "english": "Thhewh, the Ouen and tiin",
    "german": "chver der erheit",
    "french": "l'aiment outre étre",
    "spanish": "ciónga asción para",
    "nothing": "qqqq zzzz",
}
CLUSTERS, STEPS = 6, 4


@query
def article_quality(spark, sf_dir):
    """Every document's quality by a model fitted on labelled ones that are not held out, stored and loaded."""
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = t.table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = classify.drawn(labels.filter(~classify.held_out(F.col("doc_id"))), "doc_id")
    path = shared_dir(spark, "quality-model")
    classify.save_model(classify.fit_classifier(docs.join(F.broadcast(known), "doc_id"), "text", "quality"), path)
    out = classify.classify(docs, classify.load_model(path), "text", "quality")
    return out.select("doc_id", classify.held_out(F.col("doc_id")).alias("held_out"), "quality",
                      F.round(F.col("quality_scores")[1], 4).alias("score"))


def _word_hits(spark, sf_dir, top_k: int):
    path = shared_dir(spark, "word-index")
    retrieval.write_index(t.table(spark, sf_dir, "documents"), "doc_id", "text", path)
    return retrieval.search_words(spark, path, QUESTIONS, top_k)


@query
def article_search(spark, sf_dir):
    """Ten best documents for five questions, with their source."""
    hits = _word_hits(spark, sf_dir, 10)
    found = retrieval.with_articles(hits, t.table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return _rounded(found.select("query", "doc_id", "source", "rank", "score"), "score")


@query
def article_search_fused(spark, sf_dir):
    """Hits by words and hits by vectors joined by reciprocal rank; a document's vector is the one of its number."""
    words = _word_hits(spark, sf_dir, 50)
    index = t.vector_index(spark, sf_dir)
    mean = t.mean_vector(spark, sf_dir)
    near = vectors.query_vectors(index, mean, 50, "all")
    every = F.explode(F.array(*[F.lit(q) for q in QUESTIONS]))
    near = retrieval.ranked(near.select(every.alias("query"), "id", F.round("score", 6).alias("score")), 50)
    return _rounded(retrieval.fused([words, near], 10).select("query", "id", "score", "rank"), "score")


@query
def article_clusters(spark, sf_dir):
    """R2: every vector with its cluster, from a k-means|| start."""
    rows = t.table(spark, sf_dir, "embeddings")
    centres, _ = clusters.fit_clusters(rows, "vec_id", "embedding", CLUSTERS)
    return _rounded(clusters.assigned(rows, "vec_id", "embedding", centres), "distance")


@query
def cluster_steps(spark, sf_dir):
    """R2: clusters after four steps from given centres, those of the first vectors."""
    rows = t.table(spark, sf_dir, "embeddings")
    given = rows.filter(F.col("vec_id") < CLUSTERS).orderBy("vec_id").collect()
    centres, _ = clusters.fit_clusters(
        rows, "vec_id", "embedding", CLUSTERS, steps=STEPS, least_gain=-1.0, centres=np.array([r["embedding"] for r in given]))
    return _rounded(clusters.assigned(rows, "vec_id", "embedding", centres), "distance")


@query
def feed_cost(spark, sf_dir):
    """Tokens and price of annotating each feed's articles."""
    return _rounded(counts.annotation_cost(t.document_articles(spark, sf_dir), 0.25), "cost")


def _indexed(spark, sf_dir, metric: str, lists: int | None = None) -> str:
    path = shared_dir(spark, "collection")
    vector_store.create_collection(spark, path, 64, metric)
    vector_store.upsert_vectors(t.vector_index(spark, sf_dir), path, 0)
    vector_index.build_index(spark, path, lists)
    return path


def _label_queries(spark, sf_dir):
    return t.label_vectors(spark, sf_dir).select(
        F.col("label").alias("query_id"), F.lit("all").alias("namespace"), "vector")


@query
def vector_indexed_topk(spark, sf_dir):
    """Ten nearest by angle, dot product and distance from indexed collections, opened list by list."""
    out = None
    for metric in ("cosine", "dotproduct", "euclidean"):
        hits, _ = vector_index.query_index(spark, _indexed(spark, sf_dir, metric), "all", t.mean_vector(spark, sf_dir), 10)
        hits = hits.select(F.lit(metric).alias("metric"), "id", F.round("score", 4).alias("score"))
        out = hits if out is None else out.unionByName(hits)
    return out


@query
def vector_indexed_search(spark, sf_dir):
    """Five nearest to each label's mean, from an indexed collection."""
    hits = vector_index.search_index(spark, _indexed(spark, sf_dir, "cosine"), _label_queries(spark, sf_dir), 5)
    return _rounded(hits.select("query_id", "id", "score"), "score")


@query
def vector_search_filtered(spark, sf_dir):
    """Five nearest to each label's mean among the vectors of label 3, with and without an index."""
    asked, wanted = _label_queries(spark, sf_dir), {"label": "3"}
    plain = vectors.search(t.vector_index(spark, sf_dir), asked, 5, "cosine", wanted)
    indexed = vector_index.search_index(spark, _indexed(spark, sf_dir, "cosine"), asked, 5, wanted)
    shown = lambda hits, how: hits.select(F.lit(how).alias("how"), "query_id", "id", F.round("score", 4).alias("score"))
    return shown(plain, "scan").unionByName(shown(indexed, "index"))


@query
def monthly_profile_merged(spark, sf_dir):
    """Events profiled by day, the states of January merged, quartiles exact."""
    events = t.table(spark, sf_dir, "events").select(
        "ts", "event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    path = shared_dir(spark, "states")
    mergeable.write_states(mergeable.day_states(events, "ts"), path)
    month = events.filter("ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'")
    out = mergeable.profile_of(month, mergeable.read_states(spark, path, 2024, 1))
    return _rounded(out, "mean", "std", "min", "25%", "50%", "75%", "max")


@query
def page_main_text(spark, sf_dir):
    """The run of blocks of every page that reads like its article."""
    return page_source.main_texts(t.table(spark, sf_dir, "pages")).select("page_id", "content", "score")
