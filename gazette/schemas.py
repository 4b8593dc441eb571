"""Table schemas and the fixed values results depend on."""

from __future__ import annotations

FEED_LIST = "u string, dt bigint, update int"
REGISTRY = "url string, dt bigint"
MESSAGE = "u string, dt bigint"
ARTICLE = (
    "link string, rss string, title string, content string, unixTime bigint, "
    "rss_id string, article_id string, llm_summary string, embedding array<float>"
)
ARTICLE_COLUMNS = [
    "link", "rss", "title", "content", "unixTime",
    "rss_id", "article_id", "llm_summary", "embedding",
]
# An article as stored: object metadata and path, ingest time, and the folder columns.
STORED = (
    f"{ARTICLE}, metadata map<string,string>, path string, ingest_ts timestamp, "
    "year int, month int, day int, batch_id bigint"
)
# An article as one line of an exported CSV: arrays travel as JSON text.
ARTICLE_CSV = ARTICLE.replace("array<float>", "string")
VECTOR = "namespace string, id string, values array<float>, metadata map<string,string>"
METRIC = "namespace string, metric_name string, value double, unit string, ts timestamp"

# Fixed value: object metadata entries, in stored order.
METADATA_KEYS = ["rss", "title", "unixTime", "article_id", "link", "rss_id"]

# Fixed value: length of feed and article keys in hex characters.
KEY_LENGTH = 10

# Fixed value: strings that a CSV reader takes as missing (pandas `read_csv` defaults).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

# Metric namespace, names and units.
METRIC_NAMESPACE = "RSS/FeedProcessor"
PROCESSED_ARTICLES = "ProcessedArticles"
PROCESSING_TIME = "ProcessingTime"
EXTRACTION_ERRORS = "ExtractionErrors"
UNIT_COUNT = "Count"
UNIT_SECONDS = "Seconds"

# Storage strategies and the order of their writes.
STRATEGIES = {
    "s3": ["articles"],
    "pinecone": ["vectors"],
    "both": ["vectors", "articles"],
}

# Export formats.
EXPORT_FORMATS = ["csv", "json"]
