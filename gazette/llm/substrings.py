"""Exact removal of word windows repeated across documents, behind a count-min prefilter.

Every window of 50 words has an anchor: the 20-word run inside it with the least hash.
Equal windows have equal anchors, so the number of times an anchor is chosen is never
below the number of times any of its windows occurs, and neighbouring windows mostly
share one. Partition sketches count the anchors and are merged; windows whose anchor is
estimated to be chosen once cannot repeat and go no further. The others are grouped
exactly, first as whole runs of windows with one anchor, which joins copies cheaply, and
then window by window. A window is named by two independent 64-bit hashes.

Rows: one for each document. Null or empty text has no words. Documents of one doc_id
never remove from each other; a null doc_id comes after every other. Repeated rows give
repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import as_long, in_arrow, kept, lists, mix, pick, texts_of, window_hashes, word_hashes
from gazette.llm.sketch import PARTS, Seen, bits_for, parts

WINDOW = 50
ANCHOR = 20
#: Anchors per document assumed where the sketch is sized; a wrong guess costs time only.
_ANCHORS_A_ROW = 40
_LAST = (1 << 63) - 1

_RUN = pa.struct([
    ("anchor", pa.int64()), ("digest", pa.int64()), ("start", pa.int32()), ("windows", pa.list_(pa.int64())),
])
_DOCS = (
    "doc_id long, place long, text_key long, n_words long, text string, "
    "runs array<struct<anchor: long, digest: long, start: int, windows: array<long>>>"
)
_RESULT = "doc_id long, n_words long, n_removed long, text string"


def anchors(h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The first window of each run of windows that choose one place, and the runs' anchors."""
    grams = window_hashes(h, gram, salt=1)
    inside = window - gram + 1
    if len(grams) < inside:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    place = np.lib.stride_tricks.sliding_window_view(grams, inside).argmin(axis=1)
    place += np.arange(len(place))
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return starts, grams[place[starts]]


def _sketch(window: int, gram: int, bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (anchors(word_hashes(t), window, gram)[1] for b in batches for t in texts_of(b))
        yield from parts(keys, bits)

    return work


def _runs(window: int, gram: int, seen: Seen):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                n_words, texts, text_keys, n_runs = [], [], [], []
                found = {"anchor": [], "digest": [], "start": [], "size": [], "windows": []}
                for text in texts_of(batch):
                    h = word_hashes(text)
                    n_words.append(len(h))
                    texts.append(b" ".join(text.split()))
                    text_keys.append(xxhash.xxh3_64_intdigest(texts[-1]))
                    starts, keys = anchors(h, window, gram)
                    again = seen.test(keys) if len(keys) else np.empty(0, bool)
                    n_runs.append(int(again.sum()))
                    if not n_runs[-1]:
                        continue
                    each = window_hashes(h, window)
                    sizes = np.diff(np.r_[starts, len(each)])
                    inside = np.arange(len(each)) - np.repeat(starts, sizes)
                    digests = mix(np.add.reduceat(
                        mix(each + inside.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)), starts))
                    found["anchor"].append(keys[again])
                    found["digest"].append(digests[again])
                    found["start"].append(starts[again].astype(np.int32))
                    found["size"].append(sizes[again])
                    found["windows"].append(each[np.repeat(again, sizes)])
                join = lambda k, kind: np.concatenate(found[k]) if found[k] else np.empty(0, kind)
                runs = pa.StructArray.from_arrays([
                    as_long(join("anchor", np.uint64)), as_long(join("digest", np.uint64)),
                    pa.array(join("start", np.int32)),
                    lists(as_long(join("windows", np.uint64)), join("size", np.int64)),
                ], fields=list(_RUN))
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id"),
                    "place": batch.column("doc_id").fill_null(_LAST),
                    "text_key": as_long(np.array(text_keys, np.uint64)),
                    "n_words": pa.array(n_words, pa.int64()),
                    "text": pa.array(texts, pa.binary()).cast(pa.string()),
                    "runs": lists(runs, n_runs),
                })

    return work


def _without(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, texts = [], []
            for text, starts in zip(texts_of(batch), batch.column("starts")):
                found = text.split()
                starts = np.unique(np.array(starts.as_py() or [], np.int64))
                edge = np.zeros(len(found) + window + 1, np.int64)
                edge[starts] += 1
                edge[starts + window] -= 1
                gone = np.cumsum(edge)[:len(found)] > 0
                removed.append(int(gone.sum()))
                texts.append(b" ".join([w for w, g in zip(found, gone.tolist()) if not g]))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_words": batch.column("n_words"),
                "n_removed": pa.array(removed, pa.int64()),
                "text": pa.array(texts, pa.binary()).cast(pa.string()),
            })

    return work


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed and the text left: kept words joined by one space.

    A word goes if a window of `window` words that covers it also starts in a document
    of smaller doc_id; windows are judged on the whole input.
    """
    rows = pick(docs, doc_id="long", text="string")
    spark = rows.sparkSession
    bits = bits_for(rows.count() * _ANCHORS_A_ROW)
    seen = Seen(spark, in_arrow(rows.select("text"), _sketch(window, gram, bits), PARTS), 2, bits)
    every = kept(in_arrow(rows, _runs(window, gram, seen), _DOCS), "window-runs")

    found = every.where(F.size("runs") > 0).select("place", "text_key", F.explode("runs").alias("run"))
    alike = kept(
        found.groupBy("run.anchor", "run.digest").agg(
            F.min("place").alias("lo"), F.max("place").alias("hi"), F.first("run.windows").alias("windows"))
        .withColumn("n", F.size("windows")),
        "run-classes")
    # an anchor with one run of windows needs no look at its windows one by one
    mixed = kept(alike.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "mixed-anchors")
    plain = alike.where("lo < hi").join(mixed, "anchor", "left_anti").select(
        "anchor", "digest", F.expr("array(named_struct('at', 0, 'n', n, 'first', lo))").alias("owners"))
    each = kept(
        alike.join(mixed, "anchor", "left_semi")
        .select("anchor", "digest", "lo", "hi", F.posexplode("windows").alias("at", "window")), "mixed-windows")
    first = kept(
        each.groupBy("anchor", "window").agg(F.min("lo").alias("first"), F.max("hi").alias("last"))
        .where("first < last").drop("last"), "repeated-windows")
    owners = (
        each.join(first, ["anchor", "window"]).where("hi > first").groupBy("anchor", "digest")
        .agg(F.collect_list(F.expr("named_struct('at', at, 'n', 1, 'first', first)")).alias("owners")))
    starts = (
        found.select("place", "text_key", "run.anchor", "run.digest", "run.start")
        .join(kept(plain.unionByName(owners), "window-owners"), ["anchor", "digest"])
        .select("place", "text_key", F.expr("""
            flatten(transform(filter(owners, o -> o.first < place),
                              o -> sequence(start + o.at, start + o.at + o.n - 1)))""").alias("starts"))
        .where(F.size("starts") > 0)
        .groupBy("place", "text_key").agg(F.flatten(F.collect_list("starts")).alias("starts")))
    touched = (
        every.where(F.size("runs") > 0).select("doc_id", "place", "text_key", "n_words", "text")
        .join(starts, ["place", "text_key"], "left").select("doc_id", "n_words", "text", "starts"))
    untouched = every.where(F.size("runs") == 0).select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "text")
    return untouched.unionByName(in_arrow(touched, _without(window), _RESULT))
