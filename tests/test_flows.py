"""Stores and whole flows: round trips, replays, stream against batch."""

import datetime as dt
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gazette.operators import joins, registry
from gazette.operators.filters import in_range
from gazette.plans import export, ingest, monthly
from gazette.schemas import ARTICLE, ARTICLE_COLUMNS
from gazette.sinks import articles as article_store, export as export_sink, messages as message_sink
from gazette.sinks import metrics as metric_store, registry as registry_store, vectors as vector_store
from gazette.sources import feeds, objects
from gazette.streaming import counts as stream_counts, runner
from gazette.operators.incremental import deduplicated_stream
from gazette.workload import queries
from gazette.workload.tables import EPOCH, PAGE_STEP

UTC = dt.timezone.utc
NOW = dt.datetime(2024, 11, 7, 12, tzinfo=UTC)
FEED_A, FEED_B = "https://a.example/rss", "https://b.example/rss"


def item(link, published):
    link = f"<link>{link}</link>" if link else ""
    return f"<item><title>t</title>{link}<pubDate>{published}</pubDate></item>"


def feed(*items):
    return f"<rss><channel>{''.join(items)}</channel></rss>"


def epoch(day):
    return int(dt.datetime(2024, 11, day, tzinfo=UTC).timestamp())


def on(day):
    return f"{day:02} Nov 2024 00:00:00 +0000"


@pytest.fixture
def world(spark, tmp_path):
    """Two feeds sharing an article, one broken feed, one entry without a link, one without a page."""
    docs = spark.createDataFrame([
        (FEED_A, feed(item("u1", on(1)), item("u2", on(2)), item("u3", on(3)), item("", on(4)))),
        (FEED_B, feed(item("u3", on(2)), item("u4", "no date"))),
        ("broken", "<rss><channel>"),
        ("not asked", feed(item("u9", on(9)))),
    ], "feed_url string, xml string")
    pages = spark.createDataFrame([
        (f"u{i}", f"<title>T{i}</title><body>text {i}\nsee http://x.y/z\nhere</body>") for i in (1, 2, 3, 3, 9)
    ], "url string, html string")
    root = str(tmp_path)
    stores = ingest.Stores(*[f"{root}/{n}" for n in ("registry", "articles", "rejects", "metrics", "vectors")])
    registry_store.write_cursors(
        spark.createDataFrame([(FEED_A, epoch(1)), ("broken", 5)], "url string, dt bigint"), stores.registry, registry_store.SEED
    )
    return docs, pages, stores


def messages(spark, *bodies):
    return spark.createDataFrame([(b,) for b in bodies], "value string")


ASKED = [json.dumps({"u": u, "dt": None}) for u in (FEED_A, FEED_B, "broken")] + ["{cut", json.dumps({"u": FEED_A, "dt": 3})]


def state(spark, stores):
    rows = article_store.read_articles(spark, stores.articles)
    return (
        {r["link"]: (r["rss"], r["title"], r["unixTime"]) for r in rows.collect()},
        {r["url"]: r["dt"] for r in registry_store.read_registry(spark, stores.registry).collect()},
    )


AFTER = (
    {"u2": (FEED_A, "T2", epoch(2)), "u3": (FEED_A, "T3", epoch(3)), "u4": (FEED_B, None, int(NOW.timestamp()))},
    {FEED_A: epoch(4), FEED_B: int(NOW.timestamp()), "broken": 5},
)


def test_batch_and_replay(spark, world):
    docs, pages, stores = world
    asked = messages(spark, *ASKED)
    ingest.ingest_batch(asked, docs, pages, stores, 0, NOW)
    assert state(spark, stores) == AFTER
    files = sorted(f for _, _, names in os.walk(stores.articles) for f in names if f.endswith(".parquet"))
    # The same batch again, as after a crash before its acknowledgement.
    ingest.ingest_batch(asked, docs, pages, stores, 0, NOW)
    assert state(spark, stores) == AFTER
    assert len([f for _, _, names in os.walk(stores.articles) for f in names if f.endswith(".parquet")]) == len(files)
    # A redelivery in a later batch finds nothing new but what has no date.
    ingest.ingest_batch(asked, docs, pages, stores, 1, NOW)
    assert state(spark, stores) == AFTER
    rejects = spark.read.parquet(f"{stores.rejects}/batch_id=0")
    assert sorted((r["kind"], str(r["feed"])) for r in rejects.collect()) == [
        ("document", "broken"), ("entry", FEED_A), ("message", "None")
    ]
    numbers = metric_store.read_metrics(spark, stores.metrics).filter("batch_id = 0 AND feed IS NOT NULL")
    assert {(r["feed"], r["metric_name"]): r["value"] for r in numbers.collect()} == {
        (FEED_A, "ProcessedArticles"): 2, (FEED_A, "ExtractionErrors"): 0,
        (FEED_B, "ProcessedArticles"): 2, (FEED_B, "ExtractionErrors"): 1,
        ("broken", "ProcessedArticles"): 0, ("broken", "ExtractionErrors"): 1,
    }
    times = metric_store.read_metrics(spark, stores.metrics).filter("metric_name = 'ProcessingTime'")
    assert times.count() == 2 and times.filter("value > 0 AND unit = 'Seconds'").count() == 2


def test_replay_after_cursors_were_written(spark, world):
    """Cursors of the batch itself do not hide its entries from the second try."""
    docs, pages, stores = world
    registry_store.write_cursors(spark.createDataFrame([(FEED_A, epoch(4))], "url string, dt bigint"), stores.registry, 0)
    ingest.ingest_batch(messages(spark, *ASKED), docs, pages, stores, 0, NOW)
    assert state(spark, stores) == AFTER


def test_stream_equals_batch(spark, world, tmp_path):
    docs, pages, stores = world
    inbox = str(tmp_path / "inbox")
    messages(spark, *ASKED).write.text(inbox)
    for _ in range(2):
        runner.run_ingest(
            runner.message_stream(spark, inbox, max_files=100), docs, pages, stores, str(tmp_path / "checkpoint"),
            clock=lambda batch_id: NOW, once=True,
        ).awaitTermination()
    assert state(spark, stores) == AFTER


def test_vector_strategies(spark, world):
    docs, pages, stores = world
    with pytest.raises(KeyError):
        ingest.ingest_batch(messages(spark, *ASKED), docs, pages, stores, 0, NOW, "both")
    vector_store.create_collection(spark, stores.vectors, 32, "cosine")
    ingest.ingest_batch(messages(spark, *ASKED), docs, pages, stores, 0, NOW, "both")
    assert state(spark, stores) == AFTER
    current = vector_store.read_vectors(spark, stores.vectors, "articles")
    assert {r["metadata"]["link"] for r in current.collect()} == {"u2", "u3"}
    # The article without a text has no vector and is kept aside.
    assert spark.read.parquet(f"{stores.vectors}/rejects").count() == 1
    with pytest.raises(ValueError, match="strategy"):
        ingest.ingest_batch(messages(spark, *ASKED), docs, pages, stores, 0, NOW, "tape")


def test_cleaned_ingestion(spark, world):
    docs, pages, stores = world
    asked = spark.createDataFrame([(FEED_A, None)], "u string, dt bigint")
    known = registry_store.read_registry(spark, stores.registry)
    for clean, want in ((False, "text 2 see http://x.y/z here"), (True, "text 2 see  here")):
        articles, cursors = ingest.ingest_feeds(asked, known, docs, pages, int(NOW.timestamp()), clean)
        assert articles.columns == ARTICLE_COLUMNS
        assert articles.filter("link = 'u2'").first()["content"] == want
        assert cursors.collect() == [(FEED_A, epoch(4))]


def test_shared_links_and_many_feeds(spark, world, monkeypatch):
    """The same articles when the registry is too large to send and links are crowded."""
    docs, pages, stores = world
    known = registry_store.read_registry(spark, stores.registry)
    asked = spark.createDataFrame([(FEED_A, None), (FEED_B, None)], "u string, dt bigint")
    want = sorted(map(str, ingest.ingest_feeds(asked, known, docs, pages, 0)[0].collect()))
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 1)
    for rows in (0, 1):
        monkeypatch.setattr(joins, "HOT_ROWS", rows)
        for keys in (1, 100):
            monkeypatch.setattr(joins, "MAX_HOT_KEYS", keys)
            got = ingest.ingest_feeds(asked, known, docs, pages, 0)[0]
            assert sorted(map(str, got.collect())) == want
    assert len(want) == 4 and sum("u3" in w for w in want) == 2


def test_no_nested_loops(spark, world):
    docs, pages, stores = world
    known = registry_store.read_registry(spark, stores.registry)
    asked = spark.createDataFrame([(FEED_A, None)], "u string, dt bigint")
    articles, _ = ingest.ingest_feeds(asked, known, docs, pages, 0)
    plan = articles._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- registry ---------------------------------------------------------------------


def test_seed_and_compact(spark, tmp_path):
    path = str(tmp_path / "feeds.json")
    with open(path, "w") as f:
        json.dump([{"u": u, "dt": 1699830841, "update": 1} for u in ("a", "b", "b")], f)
    store = str(tmp_path / "registry")
    registry_store.write_cursors(spark.createDataFrame([("a", 7)], "url string, dt bigint"), store, registry_store.SEED)
    listed = feeds.read_feed_list(spark, path)
    assert registry_store.seed_registry(listed, store) == 1
    assert registry_store.seed_registry(listed, store) == 0
    for batch, cursor in ((0, 9), (1, 8), (2, 30)):
        registry_store.write_cursors(spark.createDataFrame([("a", cursor)], "url string, dt bigint"), store, batch)
    assert sorted(map(tuple, registry_store.read_registry(spark, store, before_batch=2).collect())) == [("a", 9), ("b", 0)]
    smaller = str(tmp_path / "compact")
    registry_store.compact_registry(spark, store, smaller, 3)
    assert sorted(map(tuple, registry_store.read_registry(spark, smaller).collect())) == [("a", 30), ("b", 0)]
    assert feeds.read_feed_list(spark, str(tmp_path / "none.json")).count() == 0
    assert registry_store.read_registry(spark, str(tmp_path / "none")).count() == 0


def test_sent_messages_are_counted(spark, tmp_path):
    known = spark.createDataFrame([("a", 1), ("", 2), ("b", None)], "url string, dt bigint")
    path = str(tmp_path / "inbox")
    assert message_sink.send_messages(known, path) == 2
    assert message_sink.send_messages(known, path) == 2
    good, bad = registry.decoded_messages(spark.read.text(path))
    assert good.count() == 4 and bad.count() == 0


# --- objects and exports -------------------------------------------------------------


def article(i, **over):
    row = dict(zip(ARTICLE_COLUMNS, (f"l{i}", "r", f"title {i}", f"line\n\"quoted\", {i} \\ ", i, "rid", f"id{i}", None, None)))
    return row | over


def articles_of(spark, *rows_):
    return spark.createDataFrame([tuple(r[c] for c in ARTICLE_COLUMNS) for r in rows_], ARTICLE)


def test_json_objects(spark, tmp_path):
    stored = {
        "1.json": json.dumps(article(1), indent=1), "2.json": json.dumps([article(2), article(3)]),
        "3.json": "{bad", "4.json": "3", "5.json": json.dumps([article(4), 5]),
    }
    (tmp_path / "2024").mkdir()
    for name, body in stored.items():
        path = tmp_path / "2024" / name
        path.write_text(body)
        os.utime(path, (epoch(17), epoch(17)))
    good, bad = objects.read_objects(spark, str(tmp_path))
    assert sorted(r["link"] for r in good.collect()) == ["l1", "l2", "l3"] and bad.count() == 3
    for (start, end), n in {("2024-11-17", "2024-11-17"): 3, ("2024-11-18", None): 0, (None, "2024-11-16"): 0}.items():
        assert objects.read_objects(spark, str(tmp_path), ARTICLE, start, end)[0].count() == n
    days = objects.object_days(spark, str(tmp_path))
    assert [tuple(r) for r in days.groupBy("date").count().collect()] == [(dt.date(2024, 11, 17), 5)]
    out = export.export_articles(spark, str(tmp_path / "2024"), str(tmp_path / "out"), "json", source_format="json")
    assert objects.read_json_lines(spark, out).count() == 3


def test_objects_are_listed_in_passes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(objects, "PASS", 4)
    want = []
    folders = {"": 6, "a": 3, "b [x]{1}*?": 5, "c/d=1": 9, "c/e": 1, "_f": 5, "c/.g": 2, "h/empty": 0}
    for folder, n in folders.items():
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        for i in range(n):
            (tmp_path / folder / f"{i} %41.json").write_text(json.dumps(article(f"{folder}/{i}")))
        if "_f" not in folder and ".g" not in folder:
            want += [f"l{folder}/{i}" for i in range(n)]
    (tmp_path / "a" / "_hidden.json").write_text("no")
    (tmp_path / "a" / "bad.json").write_text("{bad")
    held = []
    monkeypatch.setattr(objects, "in_range", lambda files, *days: held.append(len(files.inputFiles())) or in_range(files, *days))
    good, bad = objects.read_objects(spark, str(tmp_path))
    assert sorted(r.link for r in good.collect()) == sorted(want) and bad.count() == 1
    assert max(held) <= 4 and sum(held) == len(want) + 1
    good, _ = objects.read_objects(spark, f"{tmp_path}/c/[de]*")
    assert sorted(r.link for r in good.collect()) == sorted(x for x in want if x.startswith("lc/"))
    assert objects.read_objects(spark, str(tmp_path / "a" / "1 %41.json"))[0].first().link == "la/1"
    assert objects.read_objects(spark, str(tmp_path / "h"))[0].count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        objects.read_objects(spark, str(tmp_path / "none"))


def test_object_files_in_folders(spark, tmp_path, monkeypatch):
    pages = [(i if i % 5 else None, f"http://h{i % 3}.example/{i % 20}" if i % 7 else None, "<p>x</p>") for i in range(60)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2).write.parquet(str(tmp_path / "pages.parquet"))
    monkeypatch.setattr(queries, "_FOLDER", 8)
    monkeypatch.setattr(objects, "PASS", 20)
    passes, walk = [], objects._passes
    monkeypatch.setattr(objects, "_passes", lambda *a: (passes.append(x) or x for x in walk(*a)))
    got = queries.QUERIES["object_files"](spark, str(tmp_path)).collect()
    want = [(url, url and url.split("/")[2], None if i is None else EPOCH + i * PAGE_STEP) for i, url, _ in pages]
    assert sorted(map(str, ((r.link, r.rss, r.unixTime) for r in got))) == sorted(map(str, want))
    folders = [one.removeprefix("file:") for x in passes for one in x]
    n = [len([f for f in os.listdir(one) if f.endswith(".json")]) for one in folders]
    assert max(n) <= 8 and sum(n) == 2 * len(pages) and len(passes) >= 6


@pytest.mark.parametrize("file_format", ["csv", "json"])
def test_export_round_trip(spark, tmp_path, file_format):
    src = str(tmp_path / "articles")
    instants = [dt.datetime(2024, 11, 16, 23, 59, 59), dt.datetime(2024, 11, 17), dt.datetime(2024, 11, 22), dt.datetime(2024, 11, 22, 0, 0, 1)]
    for i, ts in enumerate(instants):
        article_store.save_articles(articles_of(spark, article(i), article(i + 10, article_id="")), src, ts.replace(tzinfo=UTC), i)
    out = export.export_articles(spark, src, str(tmp_path / "out"), file_format, "2024-11-17", "2024-11-22")
    back = objects.read_export(spark, out) if file_format == "csv" else objects.read_json_lines(spark, out)
    got = sorted((r.asDict() for r in back.select(ARTICLE_COLUMNS).collect()), key=lambda r: r["link"])
    assert got == [article(1), article(2)]
    paths = export.export_slices(spark, src, str(tmp_path / "slice"), [("2024-11-16", "2024-11-17"), ("2024-11-22", "2024-11-23")], file_format)
    assert [p[-1] for p in paths] == ["1", "2"]


def test_unknown_format_is_refused_first(spark, tmp_path):
    with pytest.raises(ValueError, match="format"):
        export.export_articles(spark, str(tmp_path / "missing"), str(tmp_path / "out"), "xlsx")


def test_range_reads_only_its_folders(spark, tmp_path):
    src = str(tmp_path / "articles")
    for day in (7, 8, 9):
        article_store.save_articles(articles_of(spark, article(day)), src, dt.datetime(2024, 11, day, 1, tzinfo=UTC))
    df = article_store.read_articles(spark, src, "2024-11-08", "2024-11-09")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in plan.split("PartitionFilters")[1]
    assert [r["link"] for r in df.collect()] == ["l8"]


def test_last_write_of_a_day_stays(spark, tmp_path):
    src = str(tmp_path / "articles")
    for batch, (day, title) in enumerate([(7, "first"), (7, "second"), (8, "other day")]):
        article_store.save_articles(articles_of(spark, article(1, title=title)), src, dt.datetime(2024, 11, day, tzinfo=UTC), batch)
    got = article_store.read_articles(spark, src).orderBy("day")
    assert [(r["day"], r["title"], r["path"]) for r in got.collect()] == [
        (7, "second", "2024/11/7/id1.json"), (8, "other day", "2024/11/8/id1.json")
    ]


# --- monthly -------------------------------------------------------------------------


def test_month(spark, tmp_path):
    rows_ = [article(1, title="a"), article(2, title=None), article(3, title="", content="NA"), article(4, title='b\n"q"'), article(5, title="NA")]
    slices = [str(tmp_path / f"slice-{i}") for i in range(3)]
    export_sink.write_csv(articles_of(spark, *rows_[:2]), slices[0])
    export_sink.write_csv(articles_of(spark, *rows_[2:]).drop("llm_summary"), slices[1])
    month = monthly.prepare_exports(spark, slices, str(tmp_path / "month"))
    assert "llm_summary" not in month.clean.columns and "embedding" not in month.clean.columns
    assert sorted(r["title"] for r in month.clean.collect()) == ["a", 'b\n"q"']
    before = {r["column_name"]: r["null_percent"] for r in month.null_before.collect()}
    after = {r["column_name"]: r["null_percent"] for r in month.null_after.collect()}
    assert (before["title"], before["content"], before["link"]) == (60.0, 20.0, 0.0)
    assert (after["title"], after["content"]) == (50.0, 0.0)
    summary = {r["column_name"]: r for r in month.summary.collect()}
    assert summary["unixTime"]["p50"] == 2.5 and summary["title"]["top"] == "a"
    assert [r["article_id"] for r in month.head.collect()] == ["id1", "id4"]
    assert spark.read.parquet(str(tmp_path / "month" / "clean")).count() == 2
    with pytest.raises(FileNotFoundError):
        monthly.prepare_exports(spark, [str(tmp_path / "none")], str(tmp_path / "other"))


# --- vectors -----------------------------------------------------------------------


def test_vector_collection(spark, tmp_path):
    path = str(tmp_path / "vectors")
    with pytest.raises(KeyError):
        vector_store.collection(spark, path)
    assert tuple(vector_store.create_collection(spark, path, 2, "cosine")) == (2, "cosine")
    assert tuple(vector_store.create_collection(spark, path, 3, "euclidean")) == (2, "cosine")
    schema = "namespace string, id string, values array<float>, metadata map<string,string>"
    first = spark.createDataFrame([("n", "a", [1.0, 0.0], {"k": "1"}), ("n", "b", [0.0, 1.0], None), ("n", "c", [1.0], None), ("m", "a", [5.0, 5.0], None)], schema)
    for _ in range(2):
        vector_store.upsert_vectors(first, path, 0)
    vector_store.upsert_vectors(spark.createDataFrame([("n", "a", [0.0, 2.0], {"k": "2"})], schema), path, 1)
    got = {(r["namespace"], r["id"]): r["values"] for r in vector_store.read_vectors(spark, path).collect()}
    assert got == {("n", "a"): [0.0, 2.0], ("n", "b"): [0.0, 1.0], ("m", "a"): [5.0, 5.0]}
    hits = vector_store.query_collection(spark, path, "n", [0.0, 1.0], 5)
    assert [(r["id"], r["score"]) for r in hits.collect()] == [("a", 1.0), ("b", 1.0)]
    assert vector_store.query_collection(spark, path, "n", [0.0, 1.0], 5, {"k": "2"}).count() == 1
    with pytest.raises(ValueError):
        vector_store.query_collection(spark, path, "n", [1.0], 5)


# --- streams -------------------------------------------------------------------------


def test_streams_of_objects(spark, tmp_path):
    src = str(tmp_path / "in")
    rows_ = [("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:00:05"), ("b", "2024-01-02 00:00:00"), ("c", "2024-01-02 09:00:00")]
    df = spark.createDataFrame(rows_, "article_id string, s string").select("article_id", F.col("s").cast("timestamp").alias("ts"))
    df.write.parquet(src)

    def run(stream, mode, name):
        stream.writeStream.format("memory").queryName(name).outputMode(mode).option(
            "checkpointLocation", str(tmp_path / name)
        ).trigger(availableNow=True).start().awaitTermination()
        return spark.table(name)

    source = spark.readStream.schema(df.schema).parquet(src)
    assert {str(r["date"]): r["objects"] for r in run(stream_counts.daily_counts(source, "ts"), "complete", "all_days").collect()} == {
        "2024-01-01": 2, "2024-01-02": 2
    }
    closed = run(stream_counts.daily_counts(source, "ts", "1 hour"), "append", "closed_days").collect()
    assert {str(r["date"]): r["objects"] for r in closed} == {"2024-01-01": 2}
    once = run(deduplicated_stream(source, "ts", "1 day"), "append", "once")
    assert sorted(r["article_id"] for r in once.collect()) == ["a", "b", "c"]
