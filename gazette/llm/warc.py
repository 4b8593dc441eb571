r"""Merkle fixity audit of WARC replicas: compare roots, descend only where they differ.

A segment holds a bounded number of records in order, each with its offset. The leaf of
a record is the hash of its offset, length and bytes' hash; each node above hashes the
hashes of up to FANOUT children in order and stands for one range of offsets. Two
replicas are compared by the roots of their segments; from a segment that differs, the
children of differing nodes are compared, level by level, down to the records. There, a
record that one replica lacks, or that moved, differs like one whose bytes changed;
`differences` aligns the records of differing segments by name and tells these apart.

Rows: a record for each page; pages that repeat in id, address and content are numbered
as copies, so a lost or an added one shows. Pages without an id
form segments of their own; null texts are empty. Where more than SEGMENT records fall
to one segment, it is split by a hash of the record and its copy number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import kept, pick

SEGMENT = 1024
FANOUT = 16
#: Levels above the records; the last is the root, over all that is left.
LEVELS = 3


def record(uri: Column, name: Column, payload: Column) -> Column:
    """One WARC/1.0 resource record as text; lengths count UTF-8 bytes."""
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:sha256:"), name,
        F.lit(">\r\nWARC-Target-URI: "), uri, F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def records(pages: DataFrame) -> DataFrame:
    """segment, part, at, page_id, name, copy, start, length and sha256 of every record of one replica, in order."""
    rows = pick(pages, page_id="long", url="string", html="string")
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    name = F.sha2(F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("")), url), 256)
    text = record(url, name, html)
    different = rows.select(
        F.coalesce(F.floor(F.col("page_id") / SEGMENT), F.lit(-1)).alias("segment"), "page_id", name.alias("name"),
        F.octet_length(text).cast("long").alias("length"), F.sha2(text, 256).alias("sha256"),
    ).groupBy("segment", "page_id", "name", "length", "sha256").agg(F.count("*").alias("n"))
    # many copies of one page are numbered by several tasks
    lots = different.withColumn("copy", F.explode(F.expr(f"sequence(0L, n - 1, {SEGMENT}L)"))).repartition("name", "copy")
    leaves = kept(lots.withColumn(
        "copy", F.explode(F.expr(f"sequence(copy, least(copy + {SEGMENT}, n) - 1)"))).drop("n"), "records")
    parts = leaves.groupBy("segment").agg(F.ceil(F.count("*") / SEGMENT).alias("n_parts"))
    order = Window.partitionBy("segment", "part").orderBy("page_id", "name", "sha256", "copy")
    return (
        leaves.join(kept(parts, "segments"), "segment")
        .withColumn("part", F.pmod(F.pmod(F.xxhash64("name", "sha256"), "n_parts") + F.col("copy"), "n_parts"))
        .select(
            "segment", "part", (F.row_number().over(order) - 1).cast("long").alias("at"), "page_id", "name", "copy",
            (F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")).alias("start"),
            "length", "sha256"))


def tree(replica: DataFrame) -> list[DataFrame]:
    """(segment, part, at, hash) of the leaves, then of each level above; the last has the roots."""
    leaf = F.sha2(F.concat_ws(":", F.col("start").cast("string"), F.col("length").cast("string"), "sha256"), 256)
    levels = [kept(replica.select("segment", "part", "at", leaf.alias("hash")), "leaves")]
    for top in [False] * (LEVELS - 1) + [True]:
        above = F.lit(0).cast("long") if top else F.floor(F.col("at") / FANOUT)
        children = F.transform(F.sort_array(F.collect_list(F.struct("at", "hash"))), lambda c: c["hash"])
        levels.append(kept(
            levels[-1].withColumn("above", above).groupBy("segment", "part", "above")
            .agg(F.sha2(F.array_join(children, ""), 256).alias("hash")).withColumnRenamed("above", "at"), "nodes"))
    return levels


def audit(first: list[DataFrame], second: list[DataFrame]) -> DataFrame:
    """(segment, part, at) of the records in which two replicas differ, found from the roots down."""
    place = ["segment", "part", "at"]
    differing = None
    for level in range(LEVELS, -1, -1):
        mine, other = first[level], second[level].withColumnRenamed("hash", "other")
        if differing is not None:
            above = F.lit(0).cast("long") if level == LEVELS - 1 else F.floor(F.col("at") / FANOUT)
            branch = differing.withColumnRenamed("at", "above")
            mine, other = (x.withColumn("above", above).join(branch, ["segment", "part", "above"], "left_semi").drop("above")
                           for x in (mine, other))
        differing = kept(
            mine.join(other, place, "full").where(~F.col("hash").eqNullSafe(F.col("other"))).select(*place), "differing")
    return differing


def differences(first: tuple[DataFrame, list[DataFrame]], second: tuple[DataFrame, list[DataFrame]]) -> DataFrame:
    """What became of the records of differing segments: `changed`, `moved`, `missing` or `extra` in the second.

    Each replica is its records and its tree. A record with equal bytes at the same place
    is left out; those without an equal are paired within their name, in order.
    """
    (mine, tree_), (other, other_tree) = first, second
    roots = tree_[-1].join(other_tree[-1].withColumnRenamed("hash", "other"), ["segment", "part", "at"], "full")
    segments = kept(roots.where(~F.col("hash").eqNullSafe(F.col("other"))).select("segment").distinct(), "segments")
    own = ["page_id", "part", "start", "length"]
    keys = ["segment", "name", "sha256", "copy"]
    mine = mine.join(segments, "segment", "left_semi").select(*keys, *own)
    other = other.join(segments, "segment", "left_semi").select(
        *keys, *[F.col(c).alias(f"other_{c}") for c in own])
    both = kept(mine.join(other, keys, "full"), "aligned")
    moved = both.where("part <> other_part or start <> other_start").withColumn("state", F.lit("moved"))
    nth = F.row_number().over(Window.partitionBy("segment", "name").orderBy("sha256", "copy"))
    gone = both.where("other_part is null").select("segment", "name", nth.alias("nth"), *own)
    came = both.where("part is null").select("segment", "name", nth.alias("nth"), *[f"other_{c}" for c in own])
    state = F.when(F.col("other_part").isNull(), "missing").when(F.col("part").isNull(), "extra").otherwise("changed")
    shown = ["segment", F.coalesce("page_id", "other_page_id").alias("page_id"), "name", "state", "start", "other_start",
             "length", "other_length"]
    return moved.select(*shown).unionByName(
        gone.join(came, ["segment", "name", "nth"], "full").withColumn("state", state).select(*shown))
