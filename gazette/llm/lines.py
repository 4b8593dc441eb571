r"""One line kept of each group of nearly equal lines across all documents.

A line is what stands between \n, without white space at its ends; lines without a word
are left alone. Its set holds its 5-character shingles (a shorter line is one shingle).
Equal lines are merged first. 144 MinHash samples in 24 bands of 6 propose pairs: two lines
at similarity 0.8 share no band seven times in ten thousand, at 0.9 once in eighty million.
Within a band, two bits of each sample estimate the similarity; pairs that cannot reach the
threshold are dropped at five standard deviations, and the others join lines into candidate
clusters, so lines that meet by chance do not pull clusters together. Inside a cluster every
pair is compared exactly, block by block, and linked at 0.8 or more. Of each component the line of the smallest (doc_id, line
number) stays; the others go with their line breaks.

Rows: one for each document, all columns kept. Null text stays null. A null doc_id comes
after every other. Rows that repeat both doc_id and text are one document and keep the
same lines. Texts that lose all their lines become empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import as_long, discard, fixed, grouped, in_arrow, kept, numbered, slices, texts_of, window_hashes
from gazette.llm.graph import components
from gazette.llm.minhash import BLOCK, Union, band_keys, band_sketch, block_pairs, link_batch, permutations, signature
from gazette.llm.sketch import PARTS, Seen, bits_for, parts

CHARS = 5
THRESHOLD = (4, 5)
BANDS, ROWS = 24, 6
#: How far below the threshold an estimate may lie: five standard deviations of two bits of each sample.
MARGIN = 0.2
#: Most lines of a band compared in one group, and shared bands that small ones fill a group with.
BAND_BLOCK, PACKED, SMALL = 2048, 8192, 8
_ENDS = b" \t\n\x0b\x0c\r"
#: Lines a task remembers so as not to hand them on twice; forgetting costs time only.
_REMEMBERED = 200_000
_LAST = (1 << 63) - 1


def shingles(lines: list[str], chars: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of stripped, non-empty lines one after another, and where each line's begin."""
    padded = [line if len(line) >= chars else line.ljust(chars, "\n") for line in lines]
    points = np.frombuffer("".join(padded).encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.array([len(line) for line in padded], np.int64)
    ends = np.cumsum(sizes)
    inside = np.ones(len(points), bool)
    for back in range(1, chars):
        inside[ends - back] = False
    starts = np.zeros(len(lines), np.int64)
    np.cumsum(sizes[:-1] - chars + 1, out=starts[1:])
    return window_hashes(points, chars)[inside[:len(points) - chars + 1]], starts


def _lines(text: bytes) -> list[tuple[int, bytes]]:
    return [(i, line) for i, line in enumerate(x.strip(_ENDS) for x in text.split(b"\n")) if line]


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each line's place; its text too where it is new to the task."""
    known: set[bytes] = set()
    for whole in batches:
        for batch in slices(whole, "text", 1000):
            row, number, node, new = [], [], [], []
            for i, text in enumerate(texts_of(batch)):
                for n, line in _lines(text):
                    digest = xxhash.xxh3_128_digest(line)
                    row.append(i)
                    number.append(n)
                    node.append(digest)
                    new.append(None if digest in known else line)
                    known.add(digest)
            if len(known) > _REMEMBERED:
                known.clear()
            rows = pa.array(row, pa.int64())
            yield pa.record_batch({
                "place": batch.column("place").take(rows), "text_key": batch.column("text_key").take(rows),
                "line": pa.array(number, pa.int32()), "node": pa.array(node, pa.binary()),
                "is_new": pa.array([x is not None for x in new], pa.bool_()), "text": pa.array(new, pa.binary()).cast(pa.string())})


def _node_keys(batch: pa.RecordBatch) -> np.ndarray:
    return fixed(batch.column("node"), np.uint64)[::2]


def _node_sketch(bits: int):
    """The sketch of a task's lines."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from parts((_node_keys(batch) for batch in batches), bits)

    return work


def _seen_nodes(nodes: DataFrame, n: int, at_least: int) -> Seen:
    """Which of `n` nodes may occur so often; a bitmap, so rows are told apart without a shuffle."""
    bits = bits_for(n)
    return Seen(nodes.sparkSession, in_arrow(nodes.select("node"), _node_sketch(bits), PARTS), at_least, bits)


def _passing(*seen: Seen):
    """The rows whose node may occur often enough in one of the tables."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _node_keys(batch)
            passed = np.zeros(len(keys), bool)
            for one in seen:
                passed |= one.test(keys)
            yield batch.filter(pa.array(passed))

    return work


def _sampled(chars: int, apart: Seen | None = None):
    """Band keys and two bits of each MinHash sample for lines; not for those `apart` has seen."""
    a = permutations(BANDS * ROWS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if apart is not None:
                whole = whole.filter(pa.array(~apart.test(_node_keys(whole))))
            for batch in slices(whole, "text", 1 << 16, 1 << 17):
                samples = signature(*shingles(batch.column("text").to_pylist(), chars), a)
                yield pa.record_batch({
                    "node": batch.column("node"),
                    "bands": pa.array([x.tobytes() for x in band_keys(samples, ROWS)], pa.binary()),
                    "bits": pa.array([x.tobytes() for x in two_bits(samples)], pa.binary())})

    return work


def two_bits(samples: np.ndarray) -> np.ndarray:
    """(sets, samples / 4) bytes: two hashed bits of each MinHash sample."""
    v = ((samples * np.uint32(0x9E3779B1)) >> np.uint32(30)).astype(np.uint8)
    return v[:, 0::4] | v[:, 1::4] << 2 | v[:, 2::4] << 4 | v[:, 3::4] << 6


def agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarities estimated from rows of two bits a sample; different samples agree once in four."""
    differ = x ^ y
    differ = (differ | differ >> 1) & 0x55
    return (1 - np.bitwise_count(differ).sum(axis=1) / (4 * x.shape[1]) - 0.25) / 0.75


def _likely_bands(seen: Seen):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = fixed(batch.column("bands"), np.uint64)
            passed = seen.test(keys)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), BANDS)[passed])
            yield pa.record_batch({
                "band": as_long(keys[passed]), "node": batch.column("node").take(rows), "bits": batch.column("bits").take(rows)})

    return work


def _near_pairs(band: np.ndarray, node: np.ndarray, bits: np.ndarray, mine: np.ndarray, low: int, high: int, floor: float,
                union: Union) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs of rows of one band, of blocks `low` and `high`, that may be alike."""
    starts = np.flatnonzero(np.r_[True, band[1:] != band[:-1]])
    sizes = np.diff(np.r_[starts, len(band)])
    size = np.repeat(sizes, sizes)

    def joined(i: np.ndarray, j: np.ndarray) -> Iterator[tuple[int, int]]:
        ok = (node[i] != node[j]) & (((mine[i] == low) & (mine[j] == high)) | ((mine[i] == high) & (mine[j] == low)))
        i, j = i[ok], j[ok]
        for cut in range(0, len(i), 1 << 16):
            a, b = i[cut:cut + (1 << 16)], j[cut:cut + (1 << 16)]
            alike = agreement(bits[a], bits[b]) >= floor
            for u, v in zip(node[a[alike]].tolist(), node[b[alike]].tolist()):
                if union.join(u, v):
                    yield u, v

    for apart in range(1, SMALL):
        i = np.flatnonzero(size <= SMALL)
        i = i[i + apart < len(band)]
        i = i[band[i] == band[i + apart]]
        yield from joined(i, i + apart)
    for start, n in zip(starts.tolist(), sizes.tolist()):
        if n > SMALL:
            part = lambda: np.array([union.find(x) for x in node[start:start + n].tolist()])  # noqa: B023, E731
            roots = part()
            for i in range(n - 1):
                # rows joined already need no look
                others = i + 1 + np.flatnonzero(roots[i + 1:] != roots[i])
                if len(others):
                    found = list(joined(np.full(len(others), start + i), start + others))
                    yield from found
                    roots = part() if found else roots


def _numbers(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different digests in order, and which of them each row has."""
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    ordered = digests[order]
    new = np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], number


def _near(floor: float):
    def work(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = key[1].as_py(), key[2].as_py()
        table = pa.Table.from_batches(list(batches))
        band, mine = (table.column(c).to_numpy().astype(np.int64) for c in ("band", "mine"))
        names, number = _numbers(fixed(table.column("node"), np.uint64).reshape(-1, 2))
        order = np.lexsort((number, band))
        bits = fixed(table.column("bits"), np.uint8).reshape(len(band), -1)
        union = Union(len(names))
        links = [(names[a].tobytes(), names[b].tobytes()) for a, b in _near_pairs(
            band[order], number[order], bits[order], mine[order], low, high, floor, union)]
        yield link_batch(links, pa.binary())

    return work


def line_clusters(marked: DataFrame, floor: float) -> DataFrame:
    """(node, cluster, n_blocks) of every line that may be alike to another.

    `marked` has node, bands and bits; it comes from `kept` and is deleted once its likely bands stand.
    """
    spark = marked.sparkSession
    bits = bits_for(marked.count() * BANDS)
    seen = Seen(spark, in_arrow(marked.select("bands"), band_sketch(bits), PARTS), 2, bits)
    likely = kept(in_arrow(marked, _likely_bands(seen), "band long, node binary, bits binary"), "likely-bands")
    discard(marked)
    crowded = kept(likely.groupBy("band").agg(F.count("*").alias("n")).where(F.col("n") > BAND_BLOCK).select(
        "band", F.ceil(F.col("n") / BAND_BLOCK).cast("int").alias("n_blocks")), "crowded-bands")
    rows = likely.join(crowded, "band", "left").withColumn("n_blocks", F.coalesce("n_blocks", F.lit(1)))
    packs = likely.count() // PACKED + 1
    pack = F.when(F.col("n_blocks") == 1, F.pmod(F.xxhash64("band"), F.lit(packs))).otherwise(F.xxhash64("band"))
    near = kept(grouped(
        block_pairs(rows.withColumn("pack", pack)), ["pack", "low", "high"], _near(floor), "a binary, b binary"), "near-lines")
    discard(likely, crowded)
    found = kept(components(near), "clusters")
    sizes = kept(
        found.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_blocks")), "cluster-sizes")
    return found.join(sizes, "component").select("node", F.col("component").alias("cluster"), "n_blocks")


def _compare(chars: int, threshold: tuple[int, int]):
    def work(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = key[1].as_py(), key[2].as_py()
        table = pa.Table.from_batches(list(batches))
        node, mine = table.column("node").to_pylist(), np.array(table.column("mine").to_pylist())
        members, links = {}, []
        for i, cluster in enumerate(table.column("cluster").to_pylist()):
            members.setdefault(cluster, []).append(i)
        sets = _sets(table.column("text").to_pylist(), chars)
        for rows in members.values():
            links += [(node[rows[i]], node[rows[j]]) for i, j in _alike([sets[i] for i in rows], mine[rows], low, high, threshold)]
        yield link_batch(links, pa.binary())

    return work


def _sets(lines: list[str], chars: int) -> list[np.ndarray]:
    """Each line's different shingles, ascending."""
    values, starts = shingles(lines, chars)
    found = []
    for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(values)]):
        part = np.sort(values[low:high])
        found.append(part[np.r_[True, part[1:] != part[:-1]]])
    return found


def _alike(sets: list[np.ndarray], mine: np.ndarray, low: int, high: int, threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of one cluster's blocks `low` and `high` that reach the threshold."""
    num, den = threshold
    sizes = np.array([len(x) for x in sets])
    place = np.arange(len(sets))
    links, union, roots, table = [], Union(len(sets)), place, None
    for i in np.flatnonzero(mine == low).tolist():
        # lines that are joined already need no look, nor those that are too long or too short
        others = np.flatnonzero(
            (mine == high) & (place > (i if low == high else -1)) & (roots != roots[i])
            & (den * np.minimum(sizes, sizes[i]) >= num * np.maximum(sizes, sizes[i])))
        if len(others) == 0:
            continue
        if len(others) < 3:
            shared = np.array([_shared(sets[i], sets[j]) for j in others.tolist()])
        else:
            if table is None:
                # the shingles of all lines, numbered
                ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
                table, edges, n_ids = np.split(ids, np.cumsum(sizes)[:-1]), np.r_[0, np.cumsum(sizes)], int(ids.max()) + 1
            has = np.zeros(n_ids, bool)
            has[table[i]] = True
            if 2 * len(others) > len(sets):
                shared = np.add.reduceat(has[ids], edges[:-1], dtype=np.int64)[others]
            else:
                shared = np.array([np.count_nonzero(has[table[j]]) for j in others.tolist()])
        alike = others[den * shared >= num * (sizes[others] + sizes[i] - shared)]
        if len(alike):
            links += [(i, j) for j in alike.tolist() if union.join(i, j)]
            roots = np.array([union.find(j) for j in range(len(sets))])
    return links


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate((x, y))
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def line_classes(rows: DataFrame, chars: int, threshold: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Lines (place, text_key, line, node), from `kept`, and the (node, component) of the linked ones.

    All lines that occur twice or more or are linked are there; of the others, few.
    """
    made = kept(in_arrow(rows, _split, "place long, text_key long, line int, node binary, is_new boolean, text string"), "lines")
    texts = made.where("is_new").select("node", "text")
    # each different line is sampled once; only the texts of lines that may occur again are shuffled for it
    again = _seen_nodes(made, made.count(), 2)
    shared = in_arrow(texts, _passing(again), "node binary, text string").groupBy("node").agg(F.first("text").alias("text"))
    marks = "node binary, bands binary, bits binary"
    sampled = kept(
        in_arrow(texts, _sampled(chars, again), marks).unionByName(in_arrow(shared, _sampled(chars), marks)), "sampled-lines")
    found = kept(line_clusters(sampled, threshold[0] / threshold[1] - MARGIN), "line-clusters")
    n_found = found.count()
    # nor do texts of lines without a cluster move
    wanted = in_arrow(texts, _passing(_seen_nodes(found, n_found, 1)), "node binary, text string")
    members = found.join(wanted, "node").groupBy("node", "cluster", "n_blocks").agg(F.first("text").alias("text"))
    # clusters of one block share groups of about a block's size; a larger one has its own
    cluster = F.xxhash64("cluster")
    pack = F.when(F.col("n_blocks") == 1, F.pmod(cluster, F.lit(n_found // BLOCK + 1))).otherwise(cluster)
    links = grouped(
        block_pairs(members.withColumn("pack", pack)), ["pack", "low", "high"],
        _compare(chars, threshold), "a binary, b binary")
    linked = kept(components(kept(links, "line-links")), "line-components")
    # nor are lines grouped that stand alone
    places = made.select("place", "text_key", "line", "node")
    some = kept(in_arrow(
        places, _passing(again, _seen_nodes(linked, linked.count(), 1)), "place long, text_key long, line int, node binary"),
        "grouped-lines")
    discard(made)
    return some, linked


def unique_lines(docs: DataFrame, chars: int = CHARS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """All columns of `docs`, the text without lines that an earlier place has, and two counts.

    The counts are `n_lines` (lines with a word) and `n_removed`; columns of these names
    that `docs` brings along are replaced.
    """
    plain, at = numbered(docs)
    doc_id, text = F.col(at("doc_id")).cast("long"), F.col(at("text")).cast("string")
    keys = (F.coalesce(doc_id, F.lit(_LAST)).alias("place"), F.xxhash64(text).alias("text_key"))
    every, parts_ = line_classes(plain.select(*keys, text.alias("text")), chars, threshold)
    here = F.struct("place", "text_key", "line")
    classes = (
        every.groupBy("node").agg(F.min(here).alias("first"), F.count("*").alias("n"))
        .join(parts_, "node", "left").where("n > 1 or component is not null")
        .select("node", "first", F.coalesce("component", "node").alias("component")))
    classes = kept(classes, "line-classes")
    keepers = kept(classes.groupBy("component").agg(F.min("first").alias("keeper")), "line-keepers")
    class_keepers = kept(classes.join(keepers, "component").select("node", "keeper"), "class-keepers")
    # the lines and what was shuffled for them go before the documents are shuffled
    gone = kept(
        every.join(class_keepers, "node").where(here != F.col("keeper"))
        .groupBy("place", "text_key").agg(F.collect_set("line").alias("gone")), "gone-lines")
    discard(every, classes, keepers, class_keepers)
    names = [(f"c{i}", n) for i, n in enumerate(docs.columns) if n.lower() not in ("n_lines", "n_removed")]
    lines = F.split(text, "\n", -1)
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("all_lines") - 1), F.col("gone")),
                       lambda i: F.get("all_lines", i))
    return (
        plain.withColumns({"place": keys[0], "text_key": keys[1]}).join(gone, ["place", "text_key"], "left")
        .withColumn("all_lines", lines)
        .select(
            *[(F.when(F.col("gone").isNull(), text).otherwise(F.array_join(left, "\n")) if c == at("text")
               else F.col(c)).alias(n) for c, n in names],
            F.when(text.isNull(), 0).otherwise(
                F.size(F.filter("all_lines", lambda x: F.ltrim(x, F.lit(_ENDS.decode())) != ""))).cast("long").alias("n_lines"),
            F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed")))
