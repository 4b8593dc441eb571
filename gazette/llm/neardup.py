"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation, components.

A document's set holds its distinct word shingles after lower-casing A-Z; a text with
fewer words than a shingle is one shingle. Equal sets are merged first. 300 MinHash
samples give 50 bands of 6: two sets at similarity 0.8 share no band once in four
million times. Inside a candidate cluster the samples folded into parity bitmaps
estimate each pair's similarity from the population count of their XOR; pairs that
cannot reach the threshold are dropped there, at over five standard deviations, and
the others are compared on their full sets.

Rows: one for each document. Texts without words have an empty set, no links and stay.
Rows with a null doc_id take no part, have a null component and stay. Rows that share
a doc_id are one node, whatever their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import grouped, in_arrow, kept, numbered, pick, texts_of, window_hashes, word_hashes
from gazette.llm.graph import components
from gazette.llm.minhash import (
    band_keys, block_pairs, clusters, link_batch, links_of, odd_similarity, odd_sketches, permutations, signature,
)

SHINGLE = 5
THRESHOLD = (4, 5)
BANDS, ROWS = 50, 6
SKETCH_BITS = 1024
#: How far below the threshold an estimate may lie: over five standard deviations of 300 samples.
MARGIN = 0.15


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """The sorted distinct shingles of a text as 64-bit hashes."""
    h = word_hashes(text.lower())
    if 0 < len(h) < width:
        h = np.append(h, np.uint64(len(h)))
        return window_hashes(h, len(h))
    return np.unique(window_hashes(h, width))


def _signed(width: int):
    a = permutations(BANDS * ROWS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bands = [], [], []
            for text in texts_of(batch):
                s = shingle_set(text, width)
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                bands.append(band_keys(signature(s, np.zeros(1, np.int64), a), ROWS).tobytes() if len(s) else b"")
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "n_shingles": pa.array(sizes, pa.int64()),
                "digest": pa.array(digests, pa.binary()), "bands": pa.array(bands, pa.binary()),
            })

    return work


def _sets(width: int):
    a = permutations(BANDS * ROWS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text, width) for text in texts_of(batch)]
            odd = [odd_sketches(signature(s, np.zeros(1, np.int64), a), SKETCH_BITS).tobytes() for s in sets]
            yield pa.record_batch({
                "node": batch.column("node"), "cluster": batch.column("cluster"),
                "n_blocks": batch.column("n_blocks"),
                "shingles": pa.array([s.tobytes() for s in sets], pa.binary()), "odd": pa.array(odd, pa.binary()),
            })

    return work


def _compare(threshold: tuple[int, int]):
    samples, floor = BANDS * ROWS, threshold[0] / threshold[1] - MARGIN

    def work(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = key[1].as_py(), key[2].as_py()
        table = pa.Table.from_batches(list(batches))
        node, mine = table.column("node").to_pylist(), np.array(table.column("mine").to_pylist())
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        odd = np.frombuffer(b"".join(table.column("odd").to_pylist()), np.uint64).reshape(len(node), -1)
        first = np.flatnonzero(mine == low)
        second = np.flatnonzero(mine == high)
        likely = []
        for i in first.tolist():
            others = second[second > i] if low == high else second
            if len(others):
                differing = np.bitwise_count(odd[others] ^ odd[i]).sum(axis=1).astype(np.int64)
                estimate = odd_similarity(differing, SKETCH_BITS, samples)
                passed = estimate >= floor
                likely.append(np.c_[np.full(passed.sum(), i), others[passed], differing[passed]])
        pairs = np.concatenate(likely) if likely else np.empty((0, 3), np.int64)
        pairs = pairs[np.argsort(pairs[:, 2], kind="stable")][:, :2]
        yield link_batch(links_of(node, sets, pairs, threshold), pa.int64())

    return work


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD,
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept and text_key, for each document.

    `text_key` is xxhash64 of the text.
    """
    rows = pick(docs, doc_id="long", text="string")
    signed = kept(in_arrow(
        rows.withColumn("text_key", F.xxhash64("text")), _signed(shingle),
        "doc_id long, text_key long, n_shingles long, digest binary, bands binary"), "signed")
    classes = kept(
        signed.where("digest is not null and doc_id is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("node")), "set-classes")
    members = (
        signed.where("digest is not null").withColumnRenamed("doc_id", "node")
        .join(classes, ["digest", "node"], "left_semi").select("node", "bands"))
    found = kept(clusters(members, BANDS), "candidates")
    chosen = rows.where("text is not null").withColumnRenamed("doc_id", "node").join(found, "node")
    sets = in_arrow(chosen, _sets(shingle), "node long, cluster long, n_blocks int, shingles binary, odd binary")
    links = grouped(
        block_pairs(sets), ["cluster", "low", "high"], _compare(threshold), "a long, b long")
    parts = components(kept(links, "links"))
    named = kept(
        classes.join(parts, "node", "left").select("digest", F.coalesce("component", "node").alias("class_id")),
        "class-ids")
    own = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return (
        signed.select("doc_id", "text_key", "n_shingles", "digest").join(named, "digest", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), own))
        .select("doc_id", "n_shingles", "component_id",
                F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "text_key"))


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The rows of `docs`, all columns, of which one row of each component of near duplicates stays.

    Of rows that share the kept doc_id the one with the least text_key stays; rows
    without words or without doc_id all stay.
    """
    judged = near_duplicates(docs, **how).where("n_shingles > 0 and doc_id is not null")
    keys = kept(judged.groupBy("doc_id", "text_key").agg(
        F.first("kept").alias("stays"), F.count("*").alias("many")), "judged")
    chosen = keys.where("stays").groupBy("doc_id").agg(F.min("text_key").alias("chosen"))
    verdicts = kept(
        keys.join(chosen, "doc_id", "left").withColumn("stays", F.col("stays") & (F.col("text_key") == F.col("chosen")))
        .where("not stays or many > 1").select("doc_id", "text_key", "stays"), "verdicts")
    plain, at = numbered(docs)
    names = plain.columns
    rows = plain.withColumns({
        "doc_id": F.col(at("doc_id")).cast("long"), "text_key": F.xxhash64(F.col(at("text")).cast("string")),
    }).join(verdicts, ["doc_id", "text_key"], "left")
    alone = rows.where("stays is null").select(*names)
    repeated = rows.where("stays").dropDuplicates(["doc_id", "text_key"]).select(*names)
    return alone.unionByName(repeated).toDF(*docs.columns)
