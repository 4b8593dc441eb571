"""The SQL each query must agree with, for DuckDB over the same tables."""

from __future__ import annotations

from gazette.workload.tables import DOCUMENT_STEP, EPOCH, NOW, PAGE_STEP

URL = r"http\S+|www\S+"
NA = (
    "('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"
)
BLOCKS = (
    r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
    r'|<nav\b.*?</nav\s*>|<div class="ad">.*?</div\s*>'
)


def _clean(x: str) -> str:
    return f"regexp_replace(replace({x}, chr(10), ''), '{URL}', '', 'g')"


def _key(x: str) -> str:
    return f"substr(sha256({x}), 1, 10)"


def _plain(x: str) -> str:
    text = f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"
    for name, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{char}')"
    return rf"nullif(trim(regexp_replace({text}, '\s+', ' ', 'g')), '')"


def _part(name: str) -> str:
    return rf"regexp_extract(html, '(?is)<{name}[^>]*>(.*?)</{name}\s*>', 1)"


PAGES = f"""
pages_p AS (
  SELECT page_id, url AS link, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS rss,
         {EPOCH} + page_id * {PAGE_STEP} AS t, regexp_replace(html, '{BLOCKS}', ' ', 'g') AS html
  FROM pages),
pages_t AS (
  SELECT page_id, link, rss, t,
         {_plain(_part("title"))} AS title,
         coalesce({_plain(_part("article"))}, {_plain(_part("body"))}) AS content
  FROM pages_p)"""

REGISTRY = """
reg AS (
  SELECT rss AS url, (min(t) + max(t)) // 2 AS dt FROM pages_p GROUP BY rss HAVING count(*) >= 2)"""

FRESH = f"""WITH {PAGES}, {REGISTRY},
fresh AS (
  SELECT p.* FROM pages_t p LEFT JOIN reg ON p.rss = reg.url WHERE p.t > coalesce(reg.dt, 0))"""


def _articles(clean: bool) -> str:
    title, content = (_clean("title"), _clean("content")) if clean else ("title", "content")
    return f"""{FRESH}
SELECT link, rss, {title} AS title, {content} AS content, t AS "unixTime",
       {_key("rss")} AS rss_id, {_key("link")} AS article_id
FROM fresh"""


DOCS = f"""
docs AS (
  SELECT d.doc_id, d.lang, 'https://' || source || '.example/' || doc_id AS link, source AS rss,
         CASE WHEN toxic = 1 THEN NULL ELSE split_part(text, chr(10), 1) END AS title,
         CASE WHEN quality = 0 THEN 'NA' ELSE text END AS content,
         {EPOCH} + doc_id * {DOCUMENT_STEP} AS "unixTime",
         substr(sha256(source), 1, 10) AS rss_id,
         substr(sha256('https://' || source || '.example/' || doc_id), 1, 10) AS article_id
  FROM documents d LEFT JOIN labels USING (doc_id)),
docs_na AS (
  SELECT * REPLACE (CASE WHEN content IN {NA} THEN NULL ELSE content END AS content) FROM docs),
docs_csv AS (
  SELECT * REPLACE (CASE WHEN title IN {NA} THEN NULL ELSE title END AS title) FROM docs_na)"""

EXPORTED = 'link, rss, title, content, "unixTime", rss_id, article_id'

EVENTS = """
ev AS (
  SELECT event_id, 'feed/' || user_id AS rss, floor(epoch(ts))::BIGINT AS t, event_type, ts FROM events)"""

SEED = f"""
listed AS (SELECT doc_id AS dt, {_key("text")} AS u FROM documents),
known AS (SELECT DISTINCT {_key("text")} AS url FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))"""

CURSORS = f"""{EVENTS},
reg AS (SELECT rss AS url, min(t) AS dt FROM ev WHERE event_type = 'signup' GROUP BY 1),
upd AS (SELECT rss AS url, max(t) AS dt FROM ev WHERE event_type = 'click' GROUP BY 1)"""
UPSERT = f"""WITH {CURSORS}
SELECT coalesce(reg.url, upd.url) AS url,
       greatest(coalesce(reg.dt, upd.dt), coalesce(upd.dt, reg.dt)) AS dt
FROM reg FULL JOIN upd ON reg.url = upd.url"""

MEAN = """
parts AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
mean AS (SELECT list(x ORDER BY pos) AS q FROM (SELECT pos, avg(x) AS x FROM parts GROUP BY pos)),
means AS (
  SELECT label AS query_id, list(x ORDER BY pos) AS q
  FROM (SELECT label, pos, avg(x) AS x FROM parts GROUP BY label, pos) GROUP BY label),
index AS (SELECT vec_id::VARCHAR AS id, label, embedding::DOUBLE[] AS v FROM embeddings)"""


def _top(score: str, order: str, where: str = "TRUE", index: str = "index") -> str:
    return f"""WITH {MEAN},
flipped AS (
  SELECT id, label, CASE WHEN label >= 5 THEN list_transform(v, lambda x: -x) ELSE v END AS v FROM index)
SELECT id, round({score}, 4) AS score FROM {index}, mean WHERE {where}
ORDER BY {score} {order}, id LIMIT 10"""


def _search(score: str, order: str, where: str) -> str:
    return f"""WITH {MEAN},
scored AS (
  SELECT query_id, id, {score} AS score FROM index, means WHERE {where})
SELECT query_id, id, round(score, 4) AS score FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score {order}, id) <= 5"""


def _numeric(column: str, source: str) -> str:
    x = f"{column}::DOUBLE"
    return f"""SELECT '{column}' AS column_name, count({x}) AS "count",
       round(avg({x}), 4) AS mean, round(stddev_samp({x}), 4) AS std, round(min({x}), 4) AS "min",
       round(quantile_cont({x}, 0.25), 4) AS p25, round(quantile_cont({x}, 0.5), 4) AS p50,
       round(quantile_cont({x}, 0.75), 4) AS p75, round(max({x}), 4) AS "max"
FROM {source}"""


def _textual(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS column_name, sum(n)::BIGINT AS "count", count(*) AS "unique",
       min(v) FILTER (WHERE n = m) AS top, max(n) AS freq
FROM (SELECT v, n, max(n) OVER () AS m FROM (
  SELECT {column} AS v, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1))"""


def _nulls(column: str, name: str = "null_percent", where: str = "TRUE", source: str = "docs_na") -> str:
    return (
        f"SELECT '{column}' AS column_name, "
        f"round(round(avg(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END), 4) * 100, 2) AS {name} "
        f"FROM {source} WHERE {where}"
    )


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


ARTICLE_COLUMNS = ["link", "rss", "title", "content", '"unixTime"', "rss_id", "article_id"]
CLEAN = f"SELECT {EXPORTED} FROM docs_csv WHERE content IS NOT NULL AND title IS NOT NULL"

ORACLES: dict[str, str] = {
    "article_keys": f"""WITH {PAGES}
SELECT page_id, {_key("rss")} AS rss_id, {_key("link")} AS article_id, sha256(link) AS full_key FROM pages_p""",
    "clean_newlines_urls": f"""
SELECT 'document' AS kind, doc_id AS id,
       {_clean("'https://' || source || '.example/' || lang || chr(10) || text")} AS cleaned FROM documents
UNION ALL
SELECT 'page', page_id, {_clean("url || ' ' || html")} FROM pages""",
    "na_tokens": f"""WITH {DOCS}
SELECT doc_id, (content IS NULL)::INTEGER AS no_content, coalesce(title, '') AS title,
       "unixTime"::VARCHAR AS time_text, '' AS summary FROM docs_na""",
    "object_paths": """
SELECT event_id, year(ts) || '/' || month(ts) || '/' || day(ts) || '/' || event_id || '.json' AS path,
       strftime(ts, '%Y-%m-%d') AS date FROM events""",
    "pub_date_ladder": f"""WITH {EVENTS}
SELECT event_id, CASE event_type WHEN 'click' THEN t - 3600 WHEN 'view' THEN t WHEN 'purchase' THEN t
       WHEN 'error' THEN epoch(ts::DATE)::BIGINT ELSE {NOW} END AS "unixTime" FROM ev""",
    "queue_messages": """
SELECT url AS u, CASE WHEN contains(url, '?') THEN page_id END AS dt FROM pages WHERE starts_with(url, 'https')""",
    "decode_messages": r"""
SELECT event_id, CASE WHEN event_type <> 'error' THEN regexp_extract(props, ': (\d+)', 1)::BIGINT END AS k,
       (event_type = 'error')::INTEGER AS rejected FROM events""",
    "object_bodies": """
SELECT doc_id, length(text)::INTEGER AS n_chars FROM documents WHERE lang NOT IN ('fr', 'es')
UNION ALL
SELECT doc_id, length(text)::INTEGER FROM documents WHERE lang = 'de'""",
    "metadata_merge": f"""WITH {DOCS}
SELECT doc_id, coalesce(title, '') AS title, 17::BIGINT AS "unixTime", rss, article_id, 'xx' AS added FROM docs""",
    "feed_seed_new": f"""WITH {SEED}
SELECT DISTINCT u AS url, 0::BIGINT AS dt FROM listed WHERE NOT EXISTS (SELECT 1 FROM known WHERE url = u)""",
    "feed_seed_known": f"""WITH {SEED}
SELECT u, dt FROM listed WHERE EXISTS (SELECT 1 FROM known WHERE url = u)""",
    "feed_seed_counts": f"""WITH {SEED},
new AS (SELECT count(DISTINCT u) AS n FROM listed WHERE NOT EXISTS (SELECT 1 FROM known WHERE url = u))
SELECT n AS new_items, (SELECT count(*) FROM listed) - n AS existing_items FROM new""",
    "seeded_registry": f"""WITH {SEED} SELECT DISTINCT u AS url, 0::BIGINT AS dt FROM listed""",
    "incremental_articles": f"""WITH {EVENTS}, cut AS (SELECT rss, min(t) + 15 * 86400 AS dt FROM ev GROUP BY 1)
SELECT event_id, rss, t AS "unixTime" FROM ev JOIN cut USING (rss) WHERE t > dt""",
    "cursor_advance": f"""WITH {CURSORS}
SELECT reg.url, greatest(reg.dt, coalesce(upd.dt, reg.dt)) AS dt FROM reg LEFT JOIN upd ON reg.url = upd.url""",
    "cursor_update": UPSERT,
    "cursor_store": UPSERT,
    "latest_per_key": f"""WITH {EVENTS}
SELECT strftime(ts, '%Y-%m-%d') AS date, rss, event_id, t AS "unixTime" FROM ev
QUALIFY row_number() OVER (PARTITION BY ts::DATE, rss ORDER BY t DESC, event_id DESC) = 1""",
    "cap_per_feed": f"""WITH {DOCS}
SELECT rss, article_id, "unixTime" FROM docs
QUALIFY row_number() OVER (PARTITION BY rss ORDER BY "unixTime" DESC, article_id) <= 10""",
    "dead_letters": f"""WITH {EVENTS}
SELECT rss, event_type, strftime(ts, '%Y-%m-%d') AS date, count(*) AS attempts,
       (count(*) >= 3)::INTEGER AS dead FROM ev GROUP BY 1, 2, 3""",
    "rss_roundtrip": f"""WITH {PAGES} SELECT rss, link, title, t AS "unixTime" FROM pages_t""",
    "atom_roundtrip": f"""WITH {PAGES} SELECT rss, link, title, t AS "unixTime" FROM pages_t""",
    "broken_feeds": f"""WITH {PAGES}
SELECT rss AS feed_url, CASE WHEN starts_with(rss, 'www') THEN 0 ELSE count(*) END AS entries,
       starts_with(rss, 'www')::INTEGER AS broken FROM pages_p GROUP BY rss""",
    "page_title_text": f"""WITH {PAGES} SELECT page_id, title, content FROM pages_t""",
    "ingest_articles": _articles(clean=False),
    "ingest_cursors": f"""{FRESH}
SELECT f.rss AS url, greatest(coalesce(max(reg.dt), 0), coalesce(max(fresh.t), 0)) AS dt
FROM (SELECT DISTINCT rss FROM pages_p) f LEFT JOIN reg ON reg.url = f.rss LEFT JOIN fresh ON fresh.rss = f.rss
GROUP BY f.rss""",
    "ingest_articles_clean": _articles(clean=True),
    "stream_ingest": f"""SELECT *, '2024/11/7/' || article_id || '.json' AS path, "unixTime"::VARCHAR AS stored_time
FROM ({_articles(clean=False)})""",
    "stream_cursors": f"""WITH {PAGES} SELECT rss AS url, max(t) AS dt FROM pages_p GROUP BY 1""",
    "stream_vectors": f"""SELECT article_id AS id, 64 AS dim, 1.0::DOUBLE AS length, link
FROM ({_articles(clean=False)}) WHERE content IS NOT NULL""",
    "stream_daily_counts": """SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS objects FROM events GROUP BY 1""",
    "objects_per_day": """SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS objects FROM events GROUP BY 1 ORDER BY 1""",
    "ingest_metrics": f"""WITH {DOCS}
SELECT 'RSS/FeedProcessor' AS namespace, 'ProcessedArticles' AS metric_name, count(*)::DOUBLE AS value,
       'Count' AS unit, {NOW}::BIGINT AS time, rss AS feed FROM docs_na GROUP BY rss
UNION ALL
SELECT 'RSS/FeedProcessor', 'ExtractionErrors', (count(*) FILTER (WHERE title IS NULL AND content IS NULL))::DOUBLE,
       'Count', {NOW}::BIGINT, rss FROM docs_na GROUP BY rss""",
    "metric_summary": """
SELECT 'RSS/FeedProcessor' AS namespace, event_type AS metric_name, 'Seconds' AS unit, count(*) AS points,
       round(sum(value), 4) AS total, round(avg(value), 4) AS mean, round(max(value), 4) AS largest
FROM events GROUP BY event_type""",
    "table_shape": f"""WITH {DOCS} SELECT count(*) AS n_rows, 11 AS n_columns FROM docs_na WHERE content IS NOT NULL""",
    "head_rows": f"""WITH {DOCS} SELECT article_id, link FROM docs ORDER BY article_id LIMIT 5""",
    "sample_repeatable": """
SELECT doc_id, source FROM documents ORDER BY sha256('7:' || doc_id), doc_id LIMIT 20""",
    "date_range_export": """
SELECT event_id, 0 AS whole_end_day FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'
UNION ALL
SELECT event_id, 1 FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'""",
    "export_slices": f"""WITH {DOCS}
SELECT article_id, '2024-11-16' AS start FROM docs WHERE lang IN ('fr', 'de')
UNION ALL SELECT article_id, '2024-11-17' FROM docs WHERE lang IN ('de', 'en')
UNION ALL SELECT article_id, '2024-11-22' FROM docs WHERE lang NOT IN ('fr', 'de')""",
    # Metadata lies over the body, and a CSV reader takes an empty title as missing.
    "export_csv": f"""WITH {DOCS} SELECT {EXPORTED} FROM docs_csv WHERE lang IN ('de', 'en')""",
    "export_json": f"""WITH {DOCS}
SELECT link, rss, coalesce(title, '') AS title, content, "unixTime", rss_id, article_id
FROM docs WHERE lang <> 'fr'""",
    "stored_articles": f"""WITH {DOCS}, s AS (
  SELECT *, CASE WHEN rss = 'src1' THEN 'second write' ELSE title END AS stored FROM docs WHERE lang <> 'fr')
SELECT article_id, '2024/11/7/' || article_id || '.json' AS path, stored AS title,
       coalesce(stored, '') AS stored_title, "unixTime"::VARCHAR AS stored_time FROM s""",
    "listed_objects": """SELECT source, 1::BIGINT AS files, 1::BIGINT AS dated_today FROM documents GROUP BY source""",
    "corrupt_records": """
SELECT CASE WHEN lang <> 'fr' THEN doc_id END AS doc_id,
       CASE WHEN lang <> 'fr' THEN length(text) ELSE 12 END::INTEGER AS n_chars FROM documents""",
    "object_files": f"""WITH {PAGES}
SELECT link, rss, t AS "unixTime", {_key("link")} AS article_id FROM pages_p""",
    "vector_rejects": """SELECT vec_id::VARCHAR AS id, (label = 3)::INTEGER AS rejected FROM embeddings""",
    "monthly_union": """
SELECT doc_id, text, source, NULL::VARCHAR AS url FROM documents
UNION ALL SELECT NULL, html, NULL, url FROM pages
UNION ALL SELECT NULL, text, role, NULL FROM conversations""",
    "null_profile": f"""WITH {DOCS},
o AS (SELECT nullif(o_orderstatus, 'P') AS o_orderstatus,
             CASE WHEN o_totalprice > 1e5 THEN o_totalprice END AS o_totalprice FROM orders)
""" + _union(
        [_nulls(c).replace("'\"unixTime\"'", "'unixTime'") for c in ["doc_id", "lang", *ARTICLE_COLUMNS]]
        + ["SELECT 'llm_summary', 100.0::DOUBLE", "SELECT 'embedding', 100.0::DOUBLE"]
        + [_nulls(c, source="o") for c in ("o_orderstatus", "o_totalprice")]
    ),
    "drop_null_rows_cols": f"""WITH {DOCS}
SELECT doc_id, lang, {EXPORTED} FROM docs_na WHERE content IS NOT NULL AND title IS NOT NULL""",
    "describe_numeric": _union([_numeric(c, "orders") for c in ("o_orderkey", "o_custkey", "o_totalprice")]),
    "describe_lineitem": _union([
        _numeric(c, "lineitem") for c in ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    ]),
    "describe_text": _union([_textual(c, "documents") for c in ("text", "lang", "source")]),
    "monthly_clean": f"""WITH {DOCS} {CLEAN}""",
    "monthly_profile": f"""WITH {DOCS},
b AS ({_union([_nulls(c, "before", source="docs_csv") for c in ARTICLE_COLUMNS])}),
a AS ({_union([_nulls(c, '"after"', "content IS NOT NULL", "docs_csv") for c in ARTICLE_COLUMNS])})
SELECT * FROM b JOIN a USING (column_name)""".replace("'\"unixTime\"'", "'unixTime'"),
    "monthly_summary": f"""WITH {DOCS}, m AS ({CLEAN}),
n AS ({_numeric('"unixTime"', "m").replace("'\"unixTime\"'", "'unixTime'")}),
x AS ({_union([_textual(c, "m") for c in ARTICLE_COLUMNS if c != '"unixTime"'])})
SELECT column_name, "count", "unique", top, freq, mean, std, "min", p25, p50, p75, "max"
FROM (SELECT * FROM n UNION ALL BY NAME SELECT * FROM x)""",
    "vector_topk_cosine": _top("list_cosine_similarity(v, q)", "DESC"),
    "vector_topk_dot": _top("list_dot_product(v, q)", "DESC"),
    "vector_topk_euclidean": _top("list_distance(v, q)", "ASC"),
    "vector_topk_filtered": _top("list_cosine_similarity(v, q)", "DESC", "label = 3"),
    "vector_collection": _top("list_dot_product(v, q)", "DESC", index="flipped"),
    "vector_search_labels": _search("list_cosine_similarity(v, q)", "DESC", "TRUE"),
    "vector_search_namespaces": _search("list_distance(v, q)", "ASC", "label = query_id"),
    "vector_upsert": """
SELECT 'all' AS namespace, vec_id::VARCHAR AS id,
       round(CASE WHEN label >= 5 THEN -embedding[1] ELSE embedding[1] END::DOUBLE, 4) AS first_value FROM embeddings""",
    "embedded_documents": r"""
SELECT doc_id, 64 AS dim, CASE WHEN regexp_matches(text, '[^[:punct:]\s]') THEN 1.0 ELSE 0.0 END::DOUBLE AS length
FROM documents""",
    "duplicate_articles": """
SELECT lpad(doc_id::VARCHAR, 12, '0') AS id,
       CASE WHEN text IS NULL THEN lpad(doc_id::VARCHAR, 12, '0') ELSE min(lpad(doc_id::VARCHAR, 12, '0')) OVER w END AS first_key,
       CASE WHEN text IS NULL THEN 1 ELSE count(*) OVER w END AS copies
FROM documents WINDOW w AS (PARTITION BY text)""",
    "reliable_feeds": """
SELECT user_id FROM events GROUP BY user_id
HAVING avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) <= 0.2""",
    "pub_dates_free": """
SELECT event_id, epoch(date_trunc(CASE WHEN event_id % 12 IN (3, 5, 11) THEN 'minute' WHEN event_id % 12 IN (4, 6, 9) THEN 'day'
                                  ELSE 'second' END, ts))::BIGINT AS "unixTime"
FROM events""",
    "csv_float_integers": """SELECT o_orderkey AS "unixTime", o_orderkey AS key FROM orders""",
    "json_lines_blank": """SELECT doc_id::VARCHAR AS link FROM documents""",
    "export_union_keys": """
SELECT doc_id::VARCHAR AS article_id, 'http://x/' || doc_id AS link,
       CASE WHEN doc_id % 2 = 0 THEN lang END AS category FROM documents""",
    "null_profile_nan": """
SELECT 'event_id' AS column_name, round(round(avg((event_id IS NULL)::INT), 4) * 100, 2) AS null_percent FROM events
UNION ALL
SELECT 'value', round(round(avg((event_type = 'error' OR value IS NULL)::INT), 4) * 100, 2) FROM events""",
    "describe_boolean": """
SELECT 'failed' AS column_name, sum(n)::BIGINT AS "count", count(*) AS "unique",
       (array_agg(f ORDER BY n DESC, f))[1] AS top, max(n) AS freq
FROM (SELECT (event_type = 'error')::VARCHAR AS f, count(*) AS n FROM events GROUP BY 1)""",
}
