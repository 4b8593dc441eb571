"""The numbered queries over the supplied tables, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm import lines, manifest, mixing, neardup, pieces, pii, quality, sitetree, substrings, toxicity, trie, vectors, warc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(name: str):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return add


@_query("op3_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-word windows that an earlier document has."""
    left = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


_WORDS_SQL = r"""[w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> '']"""

ORACLES["op3_substring_dedup"] = rf"""
WITH docs AS (SELECT doc_id, {_WORDS_SQL} AS ws FROM documents),
windows AS (
    SELECT doc_id, s, md5(array_to_string(ws[s:s + 49], ' ')) AS h
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM docs)),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i
    FROM windows JOIN firsts USING (h) WHERE first < doc_id),
gone_lists AS (SELECT doc_id, list(i) AS gone, count(*) AS n FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM docs),
left_over AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t
    FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN gone_lists USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""


@_query("op5_near_dedup")
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose four-word shingles agree to four fifths."""
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4).drop("text_key")


_COMPONENTS_SQL = """
reach AS (
    SELECT n AS node, n AS root FROM nodes
    UNION
    SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
components AS (SELECT node, min(root) AS component FROM reach GROUP BY node)
"""

ORACLES["op5_near_dedup"] = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, {_WORDS_SQL.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, md5(array_to_string(ws[s:s + 3], ' ')) AS h
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS s FROM docs WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
    FROM shingles x JOIN shingles y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
    WHERE 100 * n_both >= 80 * (s.n + t.n - n_both)),
nodes AS (SELECT doc_id AS n FROM docs),
{_COMPONENTS_SQL}
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component AS component_id, doc_id = component AS kept
FROM docs JOIN components ON node = doc_id LEFT JOIN sizes USING (doc_id)
"""


@_query("op9_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that nearly equal an earlier one."""
    left = lines.unique_lines(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLES["op9_line_dedup"] = rf"""
WITH RECURSIVE raw AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
numbered AS (SELECT doc_id, unnest(ls) AS whole, unnest(range(len(ls))) AS i FROM raw),
every AS (
    SELECT doc_id, i, whole, regexp_replace(whole, '^[ 	-
]+|[ 	-
]+$', '', 'g') AS line
    FROM numbered),
classes AS (SELECT line, row_number() OVER (ORDER BY line) AS node FROM (SELECT DISTINCT line FROM every WHERE line <> '')),
nodes AS (SELECT node AS n FROM classes),
shingles AS (
    SELECT DISTINCT node, hash(substr(line, s, 5)) AS h
    FROM (SELECT node, line, unnest(range(1, greatest(length(line) - 3, 2))) AS s FROM classes)),
sizes AS (SELECT node, count(*) AS n FROM shingles GROUP BY node),
pairs AS (
    SELECT x.node AS a, y.node AS b, count(*) AS n_both
    FROM shingles x JOIN shingles y ON x.h = y.h AND x.node <> y.node GROUP BY 1, 2),
links AS (
    SELECT a, b FROM pairs JOIN sizes s ON s.node = a JOIN sizes t ON t.node = b
    WHERE 100 * n_both >= 80 * (s.n + t.n - n_both)),
{_COMPONENTS_SQL},
placed AS (
    SELECT doc_id, i, whole, component,
           component IS NULL OR row_number() OVER (PARTITION BY component ORDER BY doc_id, i) = 1 AS stays
    FROM every LEFT JOIN classes USING (line) LEFT JOIN components USING (node))
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM documents d LEFT JOIN (
    SELECT doc_id, count(component) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
           string_agg(whole, chr(10) ORDER BY i) FILTER (stays) AS t
    FROM placed GROUP BY doc_id) p ON p.doc_id = d.doc_id
"""


def encoded(docs: DataFrame) -> DataFrame:
    """Digests of the ids, of the decoded text and of where each piece ends in the text's bytes, for each document."""
    out = pieces.encode(docs, pieces.read_model(public_tokenizers.path("piece_bpe_32k.model")))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.sha2(F.array_join(F.col("ends").cast("array<string>"), " "), 256).alias("ends_sha256"))


@_query("op8_sentencepiece")
def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as ids of the public 32,000-piece model, and decoded again."""
    return encoded(_table(spark, sf_dir, "documents"))


@_query("op2_source_mixing")
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


@_query("op4_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the threshold table for each document."""
    return quality.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_STOP_SQL = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)

ORACLES["op4_quality_rules"] = rf"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, {_WORDS_SQL} AS ws,
           [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^ 	-
]')] AS ls
    FROM documents),
windows AS (
    SELECT doc_id, s, array_to_string(ws[s:s + 2], ' ') AS t
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS s FROM docs)),
again AS (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, t) AS n FROM windows),
covered AS (
    SELECT doc_id, count(DISTINCT i) AS n FROM (
        SELECT doc_id, unnest(range(s, s + 3)) AS i FROM again WHERE n > 1) GROUP BY doc_id),
counts AS (
    SELECT doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars,
           len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
           coalesce(n, 0) AS n_repeat_words,
           len([w FOR w IN ws IF lower(w) IN ({_STOP_SQL})]) AS n_stop,
           len([x FOR x IN ls IF regexp_matches(x, '(\.\.\.|…)[ 	-
]*$')]) AS n_ellipsis,
           len([x FOR x IN ls IF regexp_matches(x, '^[ 	-
]*[•*‣-]')]) AS n_bullet
    FROM docs LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words BETWEEN 50 AND 1e7 AND word_chars / n_words BETWEEN 2 AND 20
       AND n_symbols / n_words <= 0.1 AND n_stop / n_words >= 0.005 AND n_dup_lines / n_lines <= 0.3
       AND n_ellipsis / n_lines <= 0.3 AND n_bullet / n_lines <= 0.9 AS kept
FROM judged
"""


@_query("op10_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans counted and named, and all spans."""
    found = pii.find(_table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


@_query("op1_toxicity")
def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from labelled rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    net = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, net).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query("op6_warc_audit")
def warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, its segment's root in two replicas, and whether the second is damaged.

    The second replica is the first one after decay: the first character of every page
    whose id is divisible by 50 has turned into another.
    """
    pages = _table(spark, sf_dir, "pages")
    rotten = pages.withColumn("html", F.when(
        F.col("page_id") % 50 == 0, F.concat(F.lit("#"), F.substring("html", 2, 1 << 30))).otherwise(F.col("html")))
    mine, other = warc.records(pages), warc.records(rotten)
    trees = warc.tree(mine), warc.tree(other)
    damaged = warc.audit(*trees).withColumn("damaged", F.lit(True))
    roots = [t[-1].select("segment", "part", F.col("hash").alias(name)) for t, name in zip(trees, ("root", "other_root"))]
    return (
        mine.join(damaged, ["segment", "part", "at"], "left")
        .join(roots[0], ["segment", "part"]).join(roots[1], ["segment", "part"])
        .select("page_id", "segment", "at", "start", "length", "sha256", "root", "other_root",
                F.coalesce("damaged", F.lit(False)).alias("damaged")))


def _replica_sql(name: str, html: str) -> str:
    return rf"""
{name}_texts AS (
    SELECT page_id, page_id // 1024 AS segment, sha256(page_id::VARCHAR || ' ' || url) AS name,
           'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
           || 'WARC-Record-ID: <urn:sha256:' || sha256(page_id::VARCHAR || ' ' || url) || '>' || chr(13) || chr(10)
           || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
           || 'Content-Length: ' || octet_length(encode({html}))::VARCHAR || chr(13) || chr(10) || chr(13) || chr(10)
           || {html} || chr(13) || chr(10) || chr(13) || chr(10) AS t
    FROM pages),
{name}_records AS (
    SELECT page_id, segment, row_number() OVER w - 1 AS "at",
           (sum(octet_length(encode(t))) OVER w - octet_length(encode(t)))::BIGINT AS start,
           octet_length(encode(t)) AS length, sha256(t) AS sha256
    FROM {name}_texts WINDOW w AS (PARTITION BY segment ORDER BY page_id, name ROWS UNBOUNDED PRECEDING)),
{name}_0 AS (SELECT segment, "at", sha256(start::VARCHAR || ':' || length::VARCHAR || ':' || sha256) AS h FROM {name}_records),
{name}_1 AS (SELECT segment, "at" // 16 AS "at", sha256(string_agg(h, '' ORDER BY "at")) AS h FROM {name}_0 GROUP BY 1, "at" // 16),
{name}_2 AS (SELECT segment, "at" // 16 AS "at", sha256(string_agg(h, '' ORDER BY "at")) AS h FROM {name}_1 GROUP BY 1, "at" // 16),
{name}_3 AS (SELECT segment, sha256(string_agg(h, '' ORDER BY "at")) AS h FROM {name}_2 GROUP BY 1)"""


ORACLES["op6_warc_audit"] = f"""
WITH {_replica_sql("a", "html")},
{_replica_sql("b", "CASE WHEN page_id % 50 = 0 THEN '#' || substr(html, 2) ELSE html END")}
SELECT r.page_id, r.segment, r."at", r.start, r.length, r.sha256, x.h AS root, y.h AS other_root,
       p.h <> q.h AS damaged
FROM a_records r JOIN a_3 x USING (segment) JOIN b_3 y USING (segment)
JOIN a_0 p USING (segment, "at") JOIN b_0 q USING (segment, "at")
"""


@_query("op7_vector_dedup")
def vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of vectors whose cosine is 0.95 or more."""
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


ORACLES["op7_vector_dedup"] = f"""
WITH RECURSIVE good AS (
    SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.95),
nodes AS (SELECT vec_id AS n FROM embeddings),
{_COMPONENTS_SQL},
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component AS component_id, vec_id = component AS kept
FROM embeddings JOIN components ON node = vec_id LEFT JOIN counts ON a = vec_id
"""


@_query("op12_dataset_manifest")
def dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and the root that its row gives after tampering."""
    proven = manifest.verify(_table(spark, sf_dir, "documents"))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root", "verified")


def _crc32_sql(text: str) -> str:
    """The checksum of a text of ASCII characters, bit by bit."""
    byte = "xor(crc, ch)"
    for _ in range(8):
        byte = f"list_transform([{byte}], lambda x: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)[1]"
    return f"""xor(list_reduce([ord(c)::UBIGINT FOR c IN string_split({text}, '')],
        lambda crc, ch: {byte}, 4294967295::UBIGINT), 4294967295::UBIGINT)"""


def _tree_sql(name: str, levels: int) -> str:
    """Levels and proof steps of the trees of table `name`_0 (tree, at, h)."""
    made = [f"{name}_n AS (SELECT tree, count(*) AS n FROM {name}_0 GROUP BY tree)"]
    for k in range(1, levels + 1):
        made.append(f"""{name}_{k} AS (
    SELECT tree, "at" // 8 AS "at", sha256(string_agg(h, '' ORDER BY "at")) AS h
    FROM {name}_{k - 1} JOIN {name}_n USING (tree) WHERE n > {8 ** (k - 1)} GROUP BY tree, "at" // 8)""")
    made += [f"""{name}_runs_{k} AS (
    SELECT tree, "at" // 8 AS run, list(h ORDER BY "at") AS hs FROM {name}_{k} GROUP BY tree, "at" // 8)"""
             for k in range(levels)]
    made.append(f"{name}_roots AS (" + " UNION ALL ".join(
        f"SELECT tree, h AS root FROM {name}_{k} JOIN {name}_n USING (tree) WHERE n <= {8 ** k}"
        + (f" AND n > {8 ** (k - 1)}" if k else "") for k in range(levels + 1)) + ")")
    steps = ", ".join(f"""
        CASE WHEN n > {8 ** k} THEN array_to_string(r{k}.hs[1:("at" // {8 ** k}) % 8], '') END AS before_{k},
        CASE WHEN n > {8 ** k} THEN array_to_string(r{k}.hs[("at" // {8 ** k}) % 8 + 2:], '') END AS after_{k}"""
                      for k in range(levels))
    joins = " ".join(f"""
        LEFT JOIN {name}_runs_{k} r{k} ON r{k}.tree = z.tree AND r{k}.run = "at" // {8 ** (k + 1)}""" for k in range(levels))
    made.append(f"{name}_paths AS (SELECT z.*, {steps} FROM {name}_0 z JOIN {name}_n m ON m.tree = z.tree {joins})")
    return ",\n".join(made)


def _fold_sql(leaf: str, levels: int) -> str:
    for k in range(levels):
        leaf = (f"list_transform([{leaf}], lambda x: CASE WHEN before_{k} IS NULL THEN x "
                f"ELSE sha256(before_{k} || x || after_{k}) END)[1]")
    return leaf


_DOC_LEVELS, _LANG_LEVELS = 7, 3
_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(
        f"coalesce(octet_length(encode({c}))::VARCHAR || ':' || {c}, '-')"
        for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"


def _steps_sql(levels: int) -> str:
    return " || ".join(f"coalesce(before_{k}, '') || coalesce(after_{k}, '')" for k in range(levels))


ORACLES["op12_dataset_manifest"] = f"""
WITH leaves AS (
    SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree, {_leaf_sql("text")} AS h,
           CASE WHEN {_crc32_sql("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf_sql(_LOWER_SQL)} ELSE {_leaf_sql("text")} END AS seen
    FROM documents),
docs_0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS "at" FROM leaves),
{_tree_sql("docs", _DOC_LEVELS)},
langs_0 AS (SELECT '' AS tree, tree AS name, root AS h, row_number() OVER (ORDER BY tree) - 1 AS "at" FROM docs_roots),
{_tree_sql("langs", _LANG_LEVELS)},
below AS (
    SELECT doc_id, tree, h AS leaf, {_steps_sql(_DOC_LEVELS)} AS steps, {_fold_sql("seen", _DOC_LEVELS)} AS folded FROM docs_paths),
whole AS (
    SELECT b.*, p.h AS subroot, (SELECT root FROM langs_roots) AS root, b.steps || ({_steps_sql(_LANG_LEVELS)}) AS every,
           {_fold_sql("folded", _LANG_LEVELS)} AS folded_root
    FROM below b JOIN langs_paths p ON p.name = b.tree)
SELECT doc_id, leaf, subroot, root, sha256(every) AS proof_sha256, folded_root, folded_root = root AS verified FROM whole
"""


@_query("op13_conversation_trie")
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix of the rebuilt conversations, with totals over its subtree."""
    return trie.trie(_table(spark, sf_dir, "conversations"))


ORACLES["op13_conversation_trie"] = f"""
WITH turns AS (
    SELECT conv_id, sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS h,
           length(coalesce(text, '')) AS n_chars, turn
    FROM conversations WHERE conv_id IS NOT NULL),
original AS (
    SELECT conv_id, list(h ORDER BY turn NULLS FIRST, h) AS hs, list(n_chars ORDER BY turn NULLS FIRST, h) AS ns,
           ({_crc32_sql("conv_id::VARCHAR")} % 6)::BIGINT AS head
    FROM turns GROUP BY conv_id),
rebuilt AS (
    SELECT o.conv_id, coalesce(b.hs[1:o.head], []) || o.hs[o.head + 1:] AS hs, coalesce(b.ns[1:o.head], []) || o.ns[o.head + 1:] AS ns
    FROM original o LEFT JOIN original b ON b.conv_id = o.conv_id - o.conv_id % 100),
met AS (
    SELECT conv_id, d AS depth, array_to_string(hs[1:d], ',') AS k, array_to_string(hs[1:d - 1], ',') AS up, ns[d] AS n_chars,
           d = len(hs) AS last, hs
    FROM (SELECT *, unnest(range(0, len(hs) + 1)) AS d FROM rebuilt)),
nodes AS (
    SELECT k, depth, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, max(n_chars) AS n_chars, any_value(hs[1:depth]) AS hs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
    FROM met GROUP BY k, depth),
children AS (SELECT up AS k, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
wide AS (
    SELECT x.*, p.conv_id AS parent_conv_id, coalesce(c.n, 0) AS n_children, (x.n_convs - 1) * coalesce(x.n_chars, 0) AS saved
    FROM nodes x LEFT JOIN nodes p ON p.k = x.up AND p.depth = x.depth - 1
    LEFT JOIN children c ON c.k = x.k AND c.depth = x.depth),
above AS (
    SELECT d AS depth, array_to_string(hs[1:d], ',') AS k, n_children, saved
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM wide)),
sums AS (SELECT k, depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY ALL)
SELECT conv_id, w.depth::BIGINT AS depth, parent_conv_id, n_convs, n_children::BIGINT AS n_children, n_leaves, saved_tokens, ends_sha256
FROM wide w JOIN sums USING (k, depth)
"""


@_query("op11_main_text")
def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page, without what its host's pages share."""
    return sitetree.extract(_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


# SQL has no style tree: this is what the supplied pages have in their one article, which no tree may take away.
ORACLES["op11_main_text"] = r"""
WITH inner_html AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS t FROM pages),
marked AS (
    SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\s+', ' ', 'g'),
        '</?(p|h1)>', chr(10), 'g'), '<br>', ' ', 'g'), '</?b>', '', 'g') AS t FROM inner_html),
decoded AS (
    SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        t, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g') AS t FROM marked),
joined AS (
    SELECT page_id, url, array_to_string([x FOR x IN [
        trim(regexp_replace(y, '\s+', ' ', 'g')) FOR y IN string_split(t, chr(10))] IF x <> ''], chr(10)) AS text FROM decoded)
SELECT page_id, url, text, length(text) AS n_chars FROM joined
"""
