"""Commit log, message queue, bucketed tables, indexed collections, classification, search, clusters."""

import datetime as dt
import json
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gazette.operators import classify, clusters, counts, joins, retrieval, vectors
from gazette.plans import ingest
from gazette.sinks import articles as article_store, bucketed, commits, vector_index, vectors as vector_store
from gazette.sources import queue
from gazette.streaming import runner
from gazette.workload import tables as t

SF = "/root/testdata/sf0.001"
NOON = dt.datetime(2024, 11, 7, 12, tzinfo=dt.timezone.utc)
LATER = dt.datetime(2024, 11, 8, 0, 10, tzinfo=dt.timezone.utc)


def exchanged(df) -> list[str]:
    """The columns that each shuffle of a plan carries."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan)


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# -- commits ----------------------------------------------------------------------------


def test_a_batch_keeps_the_instant_of_its_beginning(spark, tmp_path):
    path = str(tmp_path / "commits")
    assert commits.begin_batch(spark, path, 0, NOON) == NOON
    assert commits.begin_batch(spark, path, 0, LATER) == NOON
    assert commits.begin_batch(spark, path, 1, LATER) == LATER
    assert commits.committed_batches(spark, path).count() == 0
    commits.commit_batch(spark, path, 0, 5)
    commits.commit_batch(spark, path, 0, 5)
    assert [tuple(r)[0::3] for r in commits.committed_batches(spark, path).select("batch_id", "instant", "day", "rows_stored").collect()] == [(0, 5)]
    rows = spark.createDataFrame([(0, "a"), (1, "b"), (7, "c")], "batch_id long, x string")
    assert [r.x for r in commits.only_committed(rows, path).collect()] == ["a"]


@pytest.mark.parametrize("step", ["begun", "articles", "cursors", "returned"])
def test_a_batch_that_dies_anywhere_is_stored_once(spark, tmp_path, step):
    root = str(tmp_path)
    stores = ingest.Stores(*(f"{root}/{x}" for x in ("registry", "articles", "rejects", "metrics")),
                           commits=f"{root}/commits", queue=f"{root}/queue", dead=f"{root}/dead")
    docs, pages = t.feed_documents(spark, SF), t.fetched_pages(spark, SF)
    messages = t.page_feeds(spark, SF).select(
        F.col("u").alias("message_id"), F.to_json(F.struct("u")).alias("value"), F.lit(0).alias("attempts"))

    def die(at):
        if at == step:
            raise RuntimeError(at)

    with pytest.raises(RuntimeError):
        ingest.ingest_batch(messages, docs, pages, stores, 0, NOON, after=die)
    if step != "begun":
        assert article_store.read_articles(spark, stores.articles, commits=stores.commits).isEmpty()
    ingest.ingest_batch(messages, docs, pages, stores, 0, LATER)
    rows = article_store.read_articles(spark, stores.articles, commits=stores.commits)
    assert rows.count() == rows.select("article_id").distinct().count() == t.table(spark, SF, "pages").select("url").distinct().count()
    assert [r[0] for r in rows.select(F.dayofmonth("ingest_ts")).distinct().collect()] == [7]


# -- queue -------------------------------------------------------------------------------


def test_the_queue_offers_whole_deliveries_in_order(spark, tmp_path):
    path = str(tmp_path / "queue")
    reader = queue.QueueReader(path)
    assert reader.latestOffset() == reader.initialOffset() == {"sent": 0, "returned": 0}
    lines = spark.createDataFrame([("one",), ("zwei ü",), ("",)], "value string")
    assert [queue.deliver(lines, path) for _ in range(2)] == [0, 1]
    failed = spark.createDataFrame([("m1", "one", 2)], "message_id string, value string, attempts int")
    queue.return_messages(failed, path, 0)
    assert reader.latestOffset() == {"sent": 2, "returned": 1}
    (tmp_path / "queue/sent/delivery=0000000001/_SUCCESS").unlink()
    assert reader.latestOffset() == {"sent": 1, "returned": 1}
    parts = reader.partitions({"sent": 0, "returned": 0}, {"sent": 1, "returned": 1})
    rows = [r for p in parts for r in reader.read(p)]
    assert sorted(r[1:] for r in rows) == [("", 0), ("one", 0), ("one", 2), ("zwei ü", 0)]
    assert len({r[0] for r in rows}) == 4
    assert reader.partitions({"sent": 1, "returned": 1}, {"sent": 1, "returned": 1}) == []


def test_failed_messages_come_back_and_the_third_time_is_the_last(spark, tmp_path):
    root = str(tmp_path)
    stores = ingest.Stores(*(f"{root}/{x}" for x in ("registry", "articles", "rejects", "metrics")),
                           queue=f"{root}/queue", dead=f"{root}/dead")
    docs = spark.createDataFrame([
        ("good", "<rss><channel><item><link>https://a/1</link><pubDate>Thu, 07 Nov 2024 10:00:00 +0000</pubDate></item></channel></rss>"),
        ("bad", "<rss><channel><item>")], "feed_url string, xml string")
    pages = spark.createDataFrame([("https://a/1", "<title>T</title><body>x</body>")], "url string, html string")
    queue.deliver(spark.createDataFrame([('{"u":"good"}',), ('{"u":"bad"}',), ("no json",)], "value string"), stores.queue)
    seen = []
    for _ in range(4):
        runner.run_ingest(
            queue.queue_stream(spark, stores.queue), docs, pages, stores, f"{root}/checkpoint", clock=lambda b: NOON, once=True,
        ).awaitTermination()
        again = spark.read.schema(queue.SCHEMA).json(f"{stores.queue}/returned/*")
        seen.append(sorted((r.value, r.attempts) for r in again.collect()))
    assert seen[0] == [("no json", 1), ('{"u":"bad"}', 1)]
    assert seen[2] == seen[3] == sorted([(v, n) for v in ("no json", '{"u":"bad"}') for n in (1, 2)])
    dead = spark.read.schema(queue.SCHEMA).parquet(f"{stores.dead}/*").collect()
    assert sorted((r.value, r.attempts) for r in dead) == [("no json", 3), ('{"u":"bad"}', 3)]
    assert article_store.read_articles(spark, stores.articles).count() == 1


# -- bucketed tables -----------------------------------------------------------------------


def test_no_shuffle_carries_text_or_vectors(spark, tmp_path, no_broadcast):
    root = str(tmp_path)
    pages = bucketed.bucketed_pages(t.fetched_pages(spark, SF), f"{root}/pages", 8)
    made, _ = ingest.ingest_feeds(
        t.page_feeds(spark, SF), t.page_registry(spark, SF), t.feed_documents(spark, SF),
        bucketed.read_bucketed(spark, pages), t.NOW)
    moved = exchanged(made)
    assert moved and not [x for x in moved if re.search("html|content|title", x)]
    article_store.save_articles(made, f"{root}/articles", NOON, 0, buckets=8)
    article_store.save_articles(made.limit(3), f"{root}/articles", LATER, 1, buckets=8)
    stored = article_store.read_articles(spark, f"{root}/articles", buckets=8)
    assert not [x for x in exchanged(stored) if "content" in x]
    assert stored.count() == made.count() + 3  # three of them on another day too
    path = f"{root}/collection"
    vector_store.create_collection(spark, path, 64, "cosine")
    index = t.vector_index(spark, SF)
    vector_store.upsert_vectors(index, path, 0, 8)
    vector_store.upsert_vectors(index.limit(5), path, 1, 8)
    rows = vector_store.read_vectors(spark, path, buckets=8)
    assert not [x for x in exchanged(rows) if "values" in x]
    assert rows.count() == index.count()
    # without buckets the same reads do move them
    article_store.save_articles(made, f"{root}/plain", NOON, 0)
    assert [x for x in exchanged(article_store.read_articles(spark, f"{root}/plain")) if "content" in x]


def test_a_bucketed_batch_written_again_replaces_itself(spark, tmp_path):
    table = bucketed.Bucketed(str(tmp_path / "t"), "k string, v int, p int", "k", 4, ("p",))
    rows = spark.createDataFrame([(f"k{i}", i, i % 2) for i in range(20)], "k string, v int, p int")
    bucketed.write_bucketed(rows, table)
    bucketed.write_bucketed(rows.filter("p = 1").withColumn("v", F.lit(-1)), table)
    found = {(r.k, r.v) for r in bucketed.read_bucketed(spark, table).collect()}
    assert found == {(f"k{i}", -1 if i % 2 else i) for i in range(20)}


def test_rows_without_a_key_stay_in_a_left_join(spark, no_broadcast):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "k string, v int")
    table = spark.createDataFrame([("a", "A"), (None, "never")], "k string, x string")
    assert sorted((r.v, r.x) for r in joins.lookup(df, table, "k", "left").collect()) == [(1, None), (2, None), (3, "A"), (4, None)]
    assert [r.v for r in joins.lookup(df, table, "k").collect()] == [3]


def test_a_lookup_is_broadcast_by_bytes_too(spark, monkeypatch):
    table = spark.createDataFrame([("a", "x" * 5000)], "k string, x string")
    assert joins._small(table)
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 4000)
    assert not joins._small(table)


# -- indexed collections ---------------------------------------------------------------------


def clustered(n, dim, groups, seed):
    draw = np.random.default_rng(seed)
    bases = draw.normal(size=(groups, dim)) * 5
    return [bases[i % groups] + draw.normal(size=dim) * 0.3 for i in range(n)]


@pytest.mark.parametrize("metric", ["cosine", "dotproduct", "euclidean"])
def test_the_index_is_exact_and_opens_few_lists(spark, tmp_path, metric):
    rows = [("a", f"v{i:04d}", [float(x) for x in v], {"half": str(i % 2)}) for i, v in enumerate(clustered(2000, 8, 40, 1))]
    rows += [("b", "b0", [1.0] * 8, None), ("a", "zero", [0.0] * 8, None), ("a", "v0000x", rows[0][2], {"half": "0"})]
    frame = spark.createDataFrame(rows, "namespace string, id string, values array<float>, metadata map<string,string>")
    path = str(tmp_path / "c")
    vector_store.create_collection(spark, path, 8, metric)
    vector_store.upsert_vectors(frame, path)
    n_lists = vector_index.build_index(spark, path)
    assert n_lists >= 40
    asked = [[float(x) for x in v] for v in clustered(6, 8, 40, 1)]
    opened = []
    for q in asked:
        for wanted in (None, {"half": "1"}, {"half": "none"}):
            want = vectors.query_vectors(vector_store.read_vectors(spark, path), q, 7, "a", wanted, metric, 8)
            got, n = vector_index.query_index(spark, path, "a", q, 7, wanted)
            assert [(r.id, round(r.score, 9)) for r in got.collect()] == [(r.id, round(r.score, 9)) for r in want.collect()]
            if wanted is None:
                opened.append(n)
    if metric != "dotproduct":
        assert max(opened) <= n_lists / 4, opened
    queries = spark.createDataFrame([(i, "a", q) for i, q in enumerate(asked)] + [(99, "b", asked[0])], "query_id int, namespace string, vector array<double>")
    for wanted in (None, {"half": "1"}):
        want = vectors.search(vector_store.read_vectors(spark, path), queries, 7, metric, wanted)
        got = vector_index.search_index(spark, path, queries, 7, wanted)
        shown = lambda df: sorted((r.query_id, r.id, round(r.score, 9)) for r in df.collect())
        assert shown(got) == shown(want)


def test_an_index_reads_only_the_lists_it_opens(spark, tmp_path):
    frame = spark.createDataFrame([("a", str(i), [float(x) for x in v], None) for i, v in enumerate(clustered(300, 4, 10, 2))],
                                  "namespace string, id string, values array<float>, metadata map<string,string>")
    path = str(tmp_path / "c")
    vector_store.create_collection(spark, path, 4, "euclidean")
    vector_store.upsert_vectors(frame, path)
    vector_index.build_index(spark, path, 10)
    some = vector_index.read_indexed(spark, path).filter((F.col("namespace") == "a") & F.col("list").isin(3))
    assert re.search(r"PartitionFilters: \[.*list", some._jdf.queryExecution().toString())
    assert some.select(F.input_file_name()).distinct().count() < len(vector_index.read_indexed(spark, path).inputFiles()) / 3


def test_an_empty_collection_has_an_index(spark, tmp_path):
    path = str(tmp_path / "c")
    vector_store.create_collection(spark, path, 3, "cosine")
    vector_store.upsert_vectors(spark.createDataFrame([], "namespace string, id string, values array<float>, metadata map<string,string>"), path)
    assert vector_index.build_index(spark, path) == 0
    assert vector_index.query_index(spark, path, "a", [1.0, 0.0, 0.0], 3)[0].count() == 0


# -- classification --------------------------------------------------------------------------


def test_quality_is_learned_stored_and_the_same_on_every_run(spark, tmp_path):
    docs = t.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    labels = t.table(spark, "/root/testdata/sf0.01", "labels").groupBy("doc_id").agg(F.max("quality").alias("y"))
    known = classify.drawn(labels.filter(~classify.held_out(F.col("doc_id"))), "doc_id")
    rows = docs.join(F.broadcast(known), "doc_id")
    models = [classify.fit_classifier(rows, "text", "y") for _ in range(2)]
    assert np.allclose(*(m.stages[-1].coefficients.toArray() for m in models), atol=1e-6)
    classify.save_model(models[0], str(tmp_path / "m"))
    held = docs.join(labels.filter(classify.held_out(F.col("doc_id"))), "doc_id")
    out = classify.classify(held, classify.load_model(str(tmp_path / "m")), "text", "quality").collect()
    bad = [r.quality_scores[0] for r in out if r.y == 0]
    good = [r.quality_scores[0] for r in out if r.y == 1]
    area = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert area > 0.75, area
    assert sum(r.quality == r.y for r in out) / len(out) > 0.8


def test_drawn_rows_are_bounded_and_the_same(spark):
    rows = spark.range(1000).withColumn("x", F.lit("t"))
    some = classify.drawn(rows, "id", 100)
    assert some.count() == 100 and some.exceptAll(classify.drawn(rows.repartition(9), "id", 100)).count() == 0


def test_a_classifier_takes_nulls_and_more_classes(spark):
    rows = [(None, 0), ("", 0)] + [(f"{w} {i}", y) for y, w in enumerate(["alpha", "beta", "gamma"]) for i in range(20)] + [("x", None)]
    df = spark.createDataFrame(rows, "text string, y int")
    out = classify.classify(df, classify.fit_classifier(df, "text", "y", dim=256), "text").collect()
    assert all(len(r.label_scores) == 3 for r in out)
    assert sum(r.label == r.y for r in out if r.text and r.y is not None) >= 55
    with pytest.raises(ValueError):
        classify.fit_classifier(df.filter("y = 1"), "text", "y")


# -- search ------------------------------------------------------------------------------------


def words_of(text):
    return [w for w in re.split(r"[\s!-/:-@\[-`{-~]+", (text or "").lower()) if w]


def test_search_is_bm25(spark, tmp_path):
    r = random.Random(3)
    texts = [" ".join(r.choice(["red", "green", "blue", "Grey,", "x-y", "rare"] + ["red"] * 8) for _ in range(r.randint(0, 30))) for _ in range(200)]
    texts += [None, "", "...", "red " * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    path = str(tmp_path / "i")
    retrieval.write_index(docs, "doc_id", "text", path, buckets=8)
    asked = {"one": "Rare grey", "two": "red red!", "none": "absent", "empty": ""}
    got = {(x.query, x.id): (x.rank, round(x.score, 9)) for x in retrieval.search_words(spark, path, asked, 15).collect()}
    split = [words_of(x) for x in texts]
    full = [s for s in split if s]
    mean, want = sum(map(len, full)) / len(full), {}
    for q, text in asked.items():
        scores = []
        for i, ws in enumerate(split):
            score = 0.0
            for term in dict.fromkeys(words_of(text)):
                n, df = ws.count(term), sum(term in s for s in split)
                if n:
                    score += math.log(1 + (len(full) - df + 0.5) / (df + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ws) / mean))
            if score:
                scores.append((-round(score, 9), str(i)))
        want |= {(q, i): (k, -s) for k, (s, i) in enumerate(sorted(scores)[:15], 1)}
    assert got == want
    found = retrieval.with_articles(retrieval.search_words(spark, path, asked, 3), docs, "doc_id")
    assert {"doc_id", "text", "query", "rank", "score"} <= set(found.columns) and found.count() == 6
    plan = retrieval.search_words(spark, path, asked, 3)._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[.*bucket", plan) and re.search(r"PushedFilters: \[.*term", plan)


@pytest.mark.parametrize("words, articles", [(1 << 21, 1 << 14), (40, 1 << 14), (1 << 21, 3), (1, 1)])
def test_a_block_of_articles_makes_one_row_a_term(spark, monkeypatch, words, articles):
    monkeypatch.setattr(retrieval, "BLOCK_WORDS", words)
    monkeypatch.setattr(retrieval, "BLOCK_ARTICLES", articles)
    texts = ["Red grey.", "red red blue", None, "...", "grey " * 90, ""] * 20 + ["one"]
    docs = spark.createDataFrame([(i % 50, x) for i, x in enumerate(texts)], "doc_id int, text string").coalesce(1)
    rows = retrieval.postings(docs, "doc_id", "text").collect()
    want = Counter(
        (term, str(i % 50), n, len(words_of(x or "")))
        for i, x in enumerate(texts) for term, n in Counter(words_of(x or "")).items())
    assert Counter((r.term, *hit) for r in rows for hit in zip(r.ids, r.ns, r.lengths)) == want
    full = [words_of(x) for x in texts if words_of(x or "")]
    assert sum(r.articles for r in rows) == len(full) and sum(r.words for r in rows) == sum(map(len, full))
    assert max(len(r.ids) for r in rows) <= articles
    if words > 40 and articles > 3:
        assert sorted(r.term for r in rows) == ["blue", "grey", "one", "red"]


def test_repeated_articles_of_one_length_are_one_hit(spark, tmp_path):
    docs = spark.createDataFrame([(1, "red grey"), (1, "red blue"), (1, "red"), (None, "red"), (2, "blue")], "doc_id int, text string")
    path = str(tmp_path / "i")
    retrieval.write_index(docs, "doc_id", "text", path, buckets=8)
    assert spark.read.parquet(f"{path}/totals").first()[:2] == (5, 7)
    got = {r.id: r.score for r in retrieval.search_words(spark, path, {"q": "red"}, 9).collect()}
    # (1, two words) has the term twice, (1, one word) and (null, one word) once: three articles have it
    weight = lambda n, length: math.log(1 + 2.5 / 3.5) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * length / 1.4))
    assert got == pytest.approx({"1": weight(2, 2) + weight(1, 1), None: weight(1, 1)})


def test_lists_are_joined_by_reciprocal_rank(spark):
    lists = [[("q", "a", 1), ("q", "b", 2), ("p", "a", 1)], [("q", "b", 1), ("q", "c", 2)]]
    frames = [spark.createDataFrame(x, "query string, id string, rank int") for x in lists]
    got = [(r.query, r.id, r.rank) for r in retrieval.fused(frames, 2).orderBy("query", "rank").collect()]
    assert got == [("p", "a", 1), ("q", "b", 1), ("q", "a", 2)]


# -- clusters ------------------------------------------------------------------------------------


def test_clusters(spark):
    points = clustered(400, 5, 6, 4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(points)] + [(900, None), (901, []), (902, [float("nan")] * 5), (903, [1.0, None, 1.0, 1.0, 1.0])]
    frame = spark.createDataFrame(rows, "id long, v array<double>")
    centres, losses = clusters.fit_clusters(frame, "id", "v", 6)
    assert all(a >= b - 1e-9 for a, b in zip(losses, losses[1:])) and len(losses) >= 2
    again, _ = clusters.fit_clusters(frame.repartition(1), "id", "v", 6)
    out = clusters.assigned(frame, "id", "v", centres).collect()
    assert len(out) == 400 and again.shape == centres.shape
    for r in out:
        far = np.linalg.norm(centres - points[r.id], axis=1)
        assert abs(far.min() - r.distance) < 1e-6 and abs(far[r.cluster] - r.distance) < 1e-6
    assert len(clusters.fit_clusters(frame, "id", "v", 3, steps=1)[1]) == 1


def test_every_document_vector_has_its_nearest_centre(spark):
    rows = t.table(spark, "/root/testdata/sf0.01", "embeddings")
    centres, losses = clusters.fit_clusters(rows, "vec_id", "embedding", 6)
    assert all(a >= b - 1e-9 for a, b in zip(losses, losses[1:]))
    every = {r.vec_id: np.array(r.embedding, float) for r in rows.collect()}
    for r in clusters.assigned(rows, "vec_id", "embedding", centres).collect():
        assert r.distance <= np.linalg.norm(centres - every[r.vec_id], axis=1).min() + 1e-6


def test_cost(spark):
    rows = spark.createDataFrame([("f", "abcde"), ("f", None), ("g", ""), ("g", "x" * 4000)], "rss string, content string")
    assert sorted(map(tuple, counts.annotation_cost(rows, 2.0).collect())) == [("f", 2, 2, 0.004), ("g", 2, 1000, 2.0)]
