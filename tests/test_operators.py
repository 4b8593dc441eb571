"""Operators on small frames: nulls, empty values, duplicates, equal cursors."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gazette.functions.vectors import similarity
from gazette.operators import counts, filters, incremental, merge, profile, registry, vectors
from gazette.sources.feeds import broken_feeds, feed_entries
from gazette.sources.files import require_columns

UTC = dt.timezone.utc


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def registry_of(spark, *pairs):
    return spark.createDataFrame(list(pairs), "url string, dt bigint")


# --- registry -----------------------------------------------------------------


def test_seed(spark):
    listed = spark.createDataFrame([("a", 9, 1), ("b", 9, 0), ("b", 9, 1), (None, 1, 1), ("", 1, 1)], "u string, dt bigint, update int")
    known = registry_of(spark, ("a", 5))
    assert rows(registry.new_feeds(listed, known)) == [("b", 0)]
    assert rows(registry.seed_counts(listed, known)) == [(1, 2)]
    assert rows(registry.known_feeds(listed, known)) == [("a", 9, 1)]
    empty = registry_of(spark)
    assert rows(registry.seed_counts(listed.limit(0), empty)) == [(0, 0)]


def test_messages_skip_feeds_without_url(spark):
    messages = registry.feed_messages(registry_of(spark, ("a", 1), ("", 2), (None, 3), ("b", None)))
    assert sorted(r[0] for r in messages.collect()) == ['{"u":"a","dt":1}', '{"u":"b","dt":null}']


def test_incremental_filter_and_cursor(spark):
    entries = spark.createDataFrame(
        [("f", t) for t in (90, 100, 130, 110)] + [("h", 5), ("unknown", 1)], "rss string, unixTime bigint"
    )
    known = registry_of(spark, ("f", 100), ("g", 100), ("h", None))
    new = incremental.new_entries(entries, known)
    assert rows(new, "rss", "unixTime") == [("f", 110), ("f", 130), ("h", 5)]
    assert rows(registry.advanced_cursors(known, new), "url") == [("f", 130), ("g", 100), ("h", 5)]


def test_cursors_never_move_back(spark):
    known = registry_of(spark, ("a", 100), ("b", 100), ("c", None))
    updates = registry_of(spark, ("a", 50), ("a", 70), ("b", 150), ("c", 1), ("d", 7))
    assert rows(registry.upserted_cursors(known, updates), "url") == [("a", 100), ("b", 150), ("c", 1), ("d", 7)]


def test_last_write_and_cap(spark):
    df = spark.createDataFrame(
        [("k", 1, "x"), ("k", 3, "y"), ("k", 3, "z"), (None, 1, "n")], "key string, ts int, v string"
    )
    latest = incremental.latest_per_key(df, ["key"], [F.desc("ts"), F.asc("v")])
    assert rows(latest, "key") == [(None, 1, "n"), ("k", 3, "y")]
    articles = spark.createDataFrame(
        [("f", i, f"{i:02}") for i in range(15)] + [("g", 1, "x")], "rss string, unixTime bigint, article_id string"
    )
    capped = incremental.capped_per_feed(articles, 10)
    assert rows(capped.groupBy("rss").agg(F.min("unixTime"), F.count("*")), "rss") == [("f", 5, 10), ("g", 1, 1)]
    assert incremental.capped_per_feed(articles).count() == 16


def test_last_write_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = incremental.latest_per_key(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_dead_letters(spark):
    df = spark.createDataFrame([("a", 2), ("b", 3), ("c", 4), ("d", None)], "u string, attempts int")
    again, dead = incremental.split_dead_letters(df)
    assert rows(again, "u") == [("a", 2), ("d", None)] and rows(dead, "u") == [("b", 3), ("c", 4)]


# --- filters --------------------------------------------------------------------


@pytest.mark.parametrize("whole, want", [(False, [1, 2]), (True, [1, 2, 3, 4])])
def test_date_range(spark, whole, want):
    stamps = ["2024-11-16 23:59:59", "2024-11-17 00:00:00", "2024-11-22 00:00:00", "2024-11-22 00:00:01",
              "2024-11-22 23:59:59", "2024-11-23 00:00:00"]
    df = spark.createDataFrame(list(enumerate(stamps)), "i int, s string").withColumn("ts", F.col("s").cast("timestamp"))
    assert [r["i"] for r in filters.in_range(df, "ts", "2024-11-17", "2024-11-22", whole).orderBy("i").collect()] == want
    assert filters.in_range(df, "ts", None, "2024-11-17").count() == 2
    assert filters.in_range(df, "ts", "2024-11-17").count() == 5
    assert filters.in_range(df, "ts").count() == 6


def test_splits(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "article_id string")
    kept, rejects = filters.split_keyed(df)
    assert rows(kept) == [("a",)] and rejects.count() == 2


def test_null_rows_and_columns(spark):
    df = spark.createDataFrame([("t", None, "x"), (None, None, "y")], "title string, content string, n string")
    assert filters.without_null_columns(df).columns == ["title", "n"]
    assert filters.with_title(df).count() == 1 and filters.with_content(df).count() == 0


def test_required_columns(spark):
    with pytest.raises(ValueError, match="a, b"):
        require_columns(spark.range(1), ["a", "id", "b"], "input")


# --- merging ----------------------------------------------------------------------


def test_metadata_wins(spark):
    df = spark.createDataFrame(
        [("body", 1, {"TITLE": "", "unixtime": "17", "extra": "e"}), ("kept", 2, {"unixTime": "later"}), ("kept", 3, None)],
        "title string, unixTime bigint, metadata map<string,string>",
    )
    merged = merge.merged_metadata(df, new_keys=["extra", "title"])
    assert merged.columns == ["title", "unixTime", "extra"]
    assert sorted(rows(merged), key=str) == sorted([("", 17, "e"), ("kept", None, None), ("kept", 3, None)], key=str)


def test_concatenation(spark):
    a = spark.createDataFrame([(1, "x")], "i int, only_a string")
    b = spark.createDataFrame([(2, "y"), (2, "y")], "i int, only_b string")
    both = merge.concatenated(spark, [a, b])
    assert sorted(rows(both), key=str) == sorted([(1, "x", None), (2, None, "y"), (2, None, "y")], key=str)
    empty = merge.concatenated(spark, [])
    assert empty.count() == 0 and "article_id" in empty.columns


# --- feeds ------------------------------------------------------------------------


def test_feed_dialects(spark):
    docs = [
        ("rss", "<rss><channel><item><title><![CDATA[a <b>]]></title><link> l1 </link><pubDate>d</pubDate></item>"
                "<item><link>l2</link></item></channel></rss>"),
        ("atom", "<feed xmlns='http://www.w3.org/2005/Atom'><entry><title type='html'>t</title>"
                 "<link rel='self' href='no'/><link href='l3'/><published>p</published></entry></feed>"),
        ("rdf", "<rdf:RDF xmlns:rdf='r' xmlns:dc='d'><channel/><item><title>q</title><link>l4</link>"
                "<dc:date>2024-11-18</dc:date></item></rdf:RDF>"),
        ("none", "<rss><channel></channel></rss>"), ("cut", "<rss><channel><item><title>x"), ("null", None),
    ]
    df = spark.createDataFrame(docs, "feed_url string, xml string")
    got = {(r["feed_url"], r["link"]): (r["title"], r["published"]) for r in feed_entries(df).collect()}
    assert got == {
        ("rss", "l1"): ("a <b>", "d"), ("rss", "l2"): (None, None), ("atom", "l3"): ("t", "p"),
        ("rdf", "l4"): ("q", "2024-11-18"),
    }
    assert {r["feed_url"] for r in broken_feeds(df).collect()} == {"cut", "null"}


# --- counts -----------------------------------------------------------------------


def test_counts(spark):
    df = spark.createDataFrame([("f", None, None), ("f", "t", None), ("g", "t", "c")], "rss string, title string, content string")
    assert rows(counts.processed_per_feed(df), "rss") == [("f", 2), ("g", 1)]
    assert rows(counts.errors_per_feed(df), "rss") == [("f", 1), ("g", 0)]
    metrics = counts.feed_metrics(counts.outcomes(df), F.lit(dt.datetime(2024, 1, 1, tzinfo=UTC)))
    got = {(r["feed"], r["metric_name"]): r["value"] for r in metrics.collect()}
    assert got == {("f", "ProcessedArticles"): 2.0, ("f", "ExtractionErrors"): 1.0,
                   ("g", "ProcessedArticles"): 1.0, ("g", "ExtractionErrors"): 0.0}
    assert rows(counts.shape(df)) == [(3, 3)]


def test_observed_count(spark, tmp_path):
    df, observed = counts.counted(spark.range(7), "seven")
    df.write.parquet(str(tmp_path / "out"))
    assert observed.get["rows"] == 7


def test_sample_is_repeatable(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    one, two, other = (counts.sample(df.repartition(n), "doc_id", 20, seed) for n, seed in ((3, 1), (7, 1), (3, 2)))
    assert rows(one) == rows(two) != rows(other) and one.count() == 20


# --- profile ------------------------------------------------------------------------


def test_null_profile_rounds_before_scaling(spark):
    df = spark.range(3).select(F.when(F.col("id") > 0, 1).alias("a"), F.lit(None).cast("string").alias("b"))
    assert rows(profile.null_profile(df), "column_name") == [("a", 33.33), ("b", 100.0)]


def test_describe_example(spark):
    data = [("a", None, 1.0, "p"), (None, None, 2.0, "p"), (None, None, 3.0, "q"), ('b\n"q"', None, 4.0, "q"), (None, None, None, None)]
    df = spark.createDataFrame(data, "title string, content string, n double, x string")
    got = {r["column_name"]: r.asDict() for r in profile.describe(df).collect()}
    n = got["n"]
    assert (n["count"], n["mean"], round(n["std"], 6), n["min"], n["p25"], n["p50"], n["p75"], n["max"]) == (
        4, 2.5, 1.290994, 1, 1.75, 2.5, 3.25, 4
    )
    assert [got["x"][k] for k in ("count", "unique", "top", "freq")] == [4, 2, "p", 2]
    assert [got["title"][k] for k in ("count", "unique", "top", "freq")] == [2, 2, "a", 1]
    assert [got["content"][k] for k in ("count", "unique", "top", "freq")] == [0, 0, None, None]


NUMBERS = {
    "few": lambda r: r.choice([1.0, 2.0, 2.0, 2.0, 3.0]),
    "one": lambda r: 7.0,
    "wide": lambda r: r.lognormvariate(0, 4),
    "third": lambda r: 0.0 if r.random() < 1 / 3 else r.gauss(0, 1),
    "holes": lambda r: r.choice([None, float("nan"), r.random()]),
}


@pytest.mark.parametrize("candidates, accuracy", [(100_000, 10_000), (50, 100)])
def test_quartiles_equal_pandas(spark, monkeypatch, candidates, accuracy):
    """Exact for any data, also when brackets must be narrowed many times."""
    monkeypatch.setattr(profile, "MAX_CANDIDATES", candidates)
    monkeypatch.setattr(profile, "_ACCURACY", accuracy)
    monkeypatch.setattr(profile, "_MARGIN", 3.0 / accuracy)
    r = random.Random(3)
    data = pd.DataFrame({k: [f(r) for _ in range(2500)] for k, f in NUMBERS.items()}, dtype=float)
    schema = ", ".join(f"{k} double" for k in NUMBERS)
    df = spark.createDataFrame([tuple(x) for x in data.itertuples(index=False)], schema).repartition(5)
    want = data.describe()
    for row in profile.describe(df).collect():
        expected = want[row["column_name"]]
        for ours, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert math.isclose(row[ours], expected[theirs], rel_tol=1e-9, abs_tol=1e-12), (row, ours)


def test_describe_tops_by_join(spark, monkeypatch):
    monkeypatch.setattr(profile, "_MAX_TOP_KEYS", 1)
    df = spark.createDataFrame([("b", "x"), ("b", "y"), ("a", "x"), ("a", "z"), ("c", "x")], "t string, u string")
    got = {r["column_name"]: (r["top"], r["freq"], r["unique"]) for r in profile.describe(df).collect()}
    assert got == {"t": ("a", 2, 3), "u": ("x", 3, 3)}


def test_describe_of_nothing(spark):
    df = spark.createDataFrame([], "n double, t string, a array<float>")
    assert [r["count"] for r in profile.describe(df).collect()] == [0, 0, 0]


# --- vectors -------------------------------------------------------------------------


def index_of(spark, n=300, dim=8, seed=5):
    r = np.random.default_rng(seed)
    data = r.normal(size=(n, dim)).astype("float32")
    if n > 40:
        data[10] = data[20] = data[30]  # copies tie
        data[40] = 0
    out = [(f"ns{i % 3 if i % 4 else 0}", f"{i:04}", data[i].tolist(), {"kind": str(i % 2)}) for i in range(n)]
    schema = "namespace string, id string, values array<float>, metadata map<string,string>"
    return spark.createDataFrame(out, schema).repartition(4), out


def brute(rows_, vector, k, metric, namespace=None, kind=None):
    scored = []
    q = np.asarray(vector, dtype=float)
    for ns, id_, values, meta in rows_:
        v = np.asarray(values, dtype="float32").astype(float)
        if (namespace and ns != namespace) or (kind and meta["kind"] != kind):
            continue
        if metric == "cosine":
            if not v.any():
                continue
            s = float(v @ q / (np.linalg.norm(v) * np.linalg.norm(q)))
        else:
            s = float(v @ q) if metric == "dotproduct" else float(np.linalg.norm(v - q))
        scored.append((s if metric == "euclidean" else -s, id_, s))
    return [(i, round(s, 6)) for _, i, s in sorted((round(a, 9), i, s) for a, i, s in scored)[:k]]


@pytest.mark.parametrize("metric", ["cosine", "dotproduct", "euclidean"])
def test_query_against_brute_force(spark, metric):
    index, data = index_of(spark)
    vector = data[30][2]
    for args, kwargs in (({}, {}), ({"namespace": "ns0"}, {"namespace": "ns0"}),
                         ({"namespace": "ns1", "filter": {"kind": "1"}}, {"namespace": "ns1", "kind": "1"})):
        hits = vectors.query_vectors(index, vector, 12, metric=metric, dim=8, **args)
        assert [(r["id"], round(r["score"], 6)) for r in hits.collect()] == brute(data, vector, 12, metric, **kwargs)


@pytest.mark.parametrize("limit", [1000, 4])
@pytest.mark.parametrize("metric", ["cosine", "dotproduct", "euclidean"])
def test_search_against_brute_force(spark, monkeypatch, metric, limit):
    """Also when the queries do not go out all at once."""
    monkeypatch.setattr(vectors, "MAX_SMALL_QUERIES", limit)
    index, data = index_of(spark)
    asked = [(i, f"ns{i % 3}", data[i * 7][2]) for i in range(11)]
    queries = spark.createDataFrame(asked, "query_id int, namespace string, vector array<float>")
    got = {}
    for r in vectors.search(index, queries, 5, metric).collect():
        got.setdefault(r["query_id"], []).append((r["id"], round(r["score"], 6)))
    for query_id, namespace, vector in asked:
        assert sorted(got[query_id]) == sorted(brute(data, vector, 5, metric, namespace))


def test_query_checks(spark):
    index, data = index_of(spark, 5)
    with pytest.raises(ValueError):
        vectors.query_vectors(index, [1.0], 3, dim=8)
    with pytest.raises(ValueError):
        vectors.query_vectors(index, data[0][2], 3, metric="manhattan")
    with pytest.raises(ValueError):
        similarity(F.lit(1), F.lit(1), "nope")


def test_single_query_needs_no_shuffle(spark):
    index, data = index_of(spark, 9)
    plan = vectors.query_vectors(index, data[0][2], 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_upsert_and_dimension(spark):
    index, _ = index_of(spark, 6)
    new = spark.createDataFrame([("ns0", "0000", [1.0, 2.0], None)], index.schema)
    after = vectors.upserted_vectors(index, new)
    assert after.count() == 6 and after.filter("id = '0000'").first()["values"] == [1.0, 2.0]
    kept, rejects = vectors.split_dimension(after, 8)
    assert kept.count() == 5 and rejects.count() == 1


def test_hashed_vectors(spark):
    from pyspark.ml.feature import HashingTF

    texts = ["Red fox, red DOG", "", None, "fox"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r["values"] for r in vectors.embed(df, "t", 16).orderBy("i").collect()]
    place = HashingTF(numFeatures=16).indexOf
    want = np.zeros(16)
    for word in "red fox red dog".split():
        want[place(word)] += 1
    assert np.allclose(got[0], want / np.linalg.norm(want)) and got[1] == [0.0] * 16 and got[2] is None
    assert got[3][place("fox")] == 1.0


def test_vectors_of_a_model(spark):
    df = spark.createDataFrame([(0, "ab"), (1, None), (2, "abc")], "i int, t string")
    out = vectors.embed(df, "t", model=lambda s: [[float(len(x)), 0.5] for x in s])
    assert [r["values"] for r in out.orderBy("i").collect()] == [[2.0, 0.5], None, [3.0, 0.5]]
