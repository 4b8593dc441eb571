"""Near-duplicate vectors: inverted lists, product-quantised residuals, exact cosine.

Vectors are scaled to length 1 and equal ones merged. Coarse centres and, for the
residuals, codebooks of 8 subspaces are fitted on a bounded sample; every vector is then
indexed under its nearest centre with its codes and its quantisation error. Two lists
matter to each other's vectors where their border lies within the reach of a link. That
is the distance which the threshold allows, times the part of it that can be expected to
point from one centre to the other: REACH standard deviations of the sample's residuals
in that direction, or of a direction drawn evenly if that is more, and all of it where
the data lie in few directions. Links in a random direction are missed less than once
in ten thousand times. Of two lists, one looks into the other, and a link between them
counts for both ends. In a list, distances to
the codes come from one table per query;
a vector whose distance exceeds the allowed one by more than its quantisation error
cannot be linked (triangle inequality), and the others are compared by exact cosine in
double precision. Lists and queries meet in chunks of bounded size; only counts and a
spanning forest of the links leave a chunk.

Rows: one for each vector. Vectors that are null, empty, zero or hold null or non-finite
numbers link with nothing, nor do rows without vec_id; vectors of different lengths are
never linked. Rows of one vec_id are one node, whatever their vectors; equal rows count
once, a node's different vectors each. A vector does not link with its own vec_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import grouped, in_arrow, kept, pick
from gazette.llm.graph import components
from gazette.llm.minhash import Union, link_batch

THRESHOLD = 0.95
#: Vectors the index is fitted on, vectors wanted in a list, most lists, codes of a subspace.
SAMPLE, LIST_SIZE, MOST_LISTS, SUBSPACES, CODES = 16_384, 512, 4096, 8, 64
CHUNK = 2048
#: How far along the line between two centres a link may reach, in standard deviations.
REACH = 4.0
_ROUNDS = 8
_PLACED_AT_ONCE = 1024


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x @ centres.T * 2 - (centres * centres).sum(axis=1)).argmax(axis=1)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of the rows of x to those of y."""
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * x @ y.T, 0))


def _centres(x: np.ndarray, n: int, draw: np.random.Generator) -> np.ndarray:
    """Means of `n` groups of the rows of x, at most as many as there are different rows."""
    centres = np.unique(x, axis=0)
    centres = centres[draw.permutation(len(centres))[:n]]
    for _ in range(_ROUNDS):
        own = _nearest(x, centres)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return np.unique(centres, axis=0)


class Index:
    """Centres and codebooks for vectors of one length."""

    def __init__(self, x: np.ndarray, n_lists: int, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.centres = _centres(x, n_lists, draw)
        residual = x - self.centres[_nearest(x, self.centres)]
        self.books = [_centres(part, CODES, draw) for part in self.parts(residual)]
        # distances between centres in units of the residuals' spread along the line between them
        share, axes = np.linalg.eigh(residual.T @ residual)
        total = max(float(share.sum()), 1e-300)
        self.spread = self.centres @ (axes * np.sqrt(np.maximum(share, 0) / total))

    @staticmethod
    def parts(x: np.ndarray) -> list[np.ndarray]:
        return np.array_split(x, min(SUBSPACES, x.shape[1]), axis=1)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and quantisation error of each vector."""
        own = _nearest(x, self.centres)
        residual = self.parts(x - self.centres[own])
        codes = [_nearest(part, book) for part, book in zip(residual, self.books)]
        errors = sum(((part - book[code]) ** 2).sum(axis=1) for part, book, code in zip(residual, self.books, codes))
        return own, np.stack(codes, axis=1).astype(np.uint8), np.sqrt(errors)

    def probes(self, x: np.ndarray, own: np.ndarray, within: float) -> np.ndarray:
        """Which lists each vector must look into: its own, and of each two lists the one asks the other."""
        far = (self.centres * self.centres).sum(axis=1) - 2 * x @ self.centres.T
        apart = _apart(self.centres[own], self.centres)
        likely = REACH * np.maximum(_apart(self.spread[own], self.spread), apart / np.sqrt(x.shape[1]))
        at, own = np.arange(len(self.centres)), own[:, None]
        asks = (at == own) | ((at > own) == ((at + own) % 2 == 0))
        return (far - np.take_along_axis(far, own, axis=1) <= 2 * within * np.minimum(apart, likely) + 1e-9) & asks

    def distances(self, queries: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Distances of queries to the coded vectors of one list, looked up in a table per query."""
        total = np.zeros((len(queries), len(codes)), np.float32)
        for m, (part, book) in enumerate(zip(self.parts(queries - self.centres[at]), self.books)):
            table = (part * part).sum(axis=1)[:, None] + (book * book).sum(axis=1) - 2 * part @ book.T
            total += np.maximum(table, 0).astype(np.float32)[:, codes[:, m]]
        return np.sqrt(total)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units, digests, sizes = [], [], []
        for value in batch.column("embedding"):
            x = value.as_py()
            ok = x is not None and len(x) > 0 and None not in x
            x = np.array(x, np.float64) if ok else np.empty(0)
            top = np.abs(x).max() if len(x) else 0.0
            if not np.isfinite(x).all() or top == 0:
                units.append(None)
                digests.append(None)
                sizes.append(0)
                continue
            x = x / top + 0.0
            units.append((x / np.linalg.norm(x)).tobytes())
            digests.append(xxhash.xxh3_128_digest(units[-1]))
            sizes.append(len(x))
        yield pa.record_batch({
            "vec_id": batch.column("vec_id"), "digest": pa.array(digests, pa.binary()),
            "dim": pa.array(sizes, pa.int32()), "unit": pa.array(units, pa.binary())})


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, row numbers, vectors) of a batch."""
    dims = np.array(batch.column("dim").to_pylist(), np.int64)
    units = batch.column("unit").to_pylist()
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        yield dim, rows, np.frombuffer(b"".join(units[i] for i in rows.tolist()), np.float64).reshape(len(rows), dim)


_PLACED = "node long, many long, dim int, list int, unit binary, codes binary, error double, probes array<int>"


def _place(shared, threshold: float):
    allowed = float(np.sqrt(2 - 2 * threshold))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = shared.value
        for batch in batches:
            pieces = ((dim, rows[at:at + _PLACED_AT_ONCE], x[at:at + _PLACED_AT_ONCE])
                      for dim, rows, x in _rows(batch) for at in range(0, len(rows), _PLACED_AT_ONCE))
            for dim, rows, x in pieces:
                own, codes, errors = indexes[dim].place(x)
                probes = indexes[dim].probes(x, own, allowed)
                at = pa.array(rows)
                yield pa.record_batch({
                    "node": batch.column("node").take(at), "many": batch.column("many").take(at),
                    "dim": batch.column("dim").take(at), "list": pa.array(own.astype(np.int32)),
                    "unit": batch.column("unit").take(at),
                    "codes": pa.array([c.tobytes() for c in codes], pa.binary()), "error": pa.array(errors),
                    "probes": pa.array([np.flatnonzero(p).astype(np.int32) for p in probes], pa.list_(pa.int32()))})

    return work


def _meet(shared, threshold: float):
    allowed = float(np.sqrt(2 - 2 * threshold))

    def work(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, at = key[0].as_py(), key[1].as_py()
        table = pa.Table.from_batches(list(batches))
        index, asks = shared.value[dim], np.array(table.column("asks").to_pylist(), bool)
        node = np.array(table.column("node").to_pylist(), np.int64)
        many = np.array(table.column("many").to_pylist(), np.int64)
        units = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(len(node), dim)
        home = np.array(table.column("home").to_pylist(), bool)
        q, y = np.flatnonzero(asks), np.flatnonzero(~asks)
        codes = np.frombuffer(
            b"".join(c for c, a in zip(table.column("codes").to_pylist(), asks) if not a), np.uint8).reshape(len(y), -1)
        reach = allowed + np.array(table.column("error").to_pylist(), np.float64)[y] + 1e-5
        counts, links, union = np.zeros(len(node), np.int64), [], Union(len(node))
        for lo in range(0, len(q), 256):
            own = q[lo:lo + 256]
            i, j = np.nonzero(index.distances(units[own], at, codes) <= reach)
            for cut in range(0, len(i), 1 << 15):
                a, b = own[i[cut:cut + (1 << 15)]], y[j[cut:cut + (1 << 15)]]
                linked = (np.einsum("ij,ij->i", units[a], units[b]) >= threshold) & (node[a] != node[b])
                a, b = a[linked], b[linked]
                np.add.at(counts, a, many[b])
                abroad = ~home[a]  # the vectors of this list do not ask back
                np.add.at(counts, b[abroad], many[a[abroad]])
                for u, v in zip(a.tolist(), b.tolist()):
                    if union.join(u, v):
                        links.append((int(node[u]), int(node[v])))
        found = np.flatnonzero(counts)
        forest = link_batch(links, pa.int64())
        yield pa.record_batch({
            "a": pa.concat_arrays([forest.column("a"), pa.array(node[found])]),
            "b": pa.concat_arrays([forest.column("b"), pa.nulls(len(found), pa.int64())]),
            "n": pa.concat_arrays([pa.nulls(len(links), pa.int64()), pa.array(counts[found])])})

    return work


def fitted(classes: DataFrame, sample: int = SAMPLE) -> dict[int, Index]:
    """An index for each length of vectors, fitted on at most `sample` vectors drawn by hash."""
    sizes = {r.dim: r.n for r in classes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(64).collect()}
    indexes = {}
    for dim, n in sizes.items():
        share = max(256, sample * n // sum(sizes.values()))
        drawn = classes.where(F.col("dim") == dim).orderBy(F.xxhash64("digest"), "digest").limit(share).select("unit").collect()
        x = np.frombuffer(b"".join(bytes(r.unit) for r in drawn), np.float64).reshape(len(drawn), dim)
        indexes[dim] = Index(x, int(np.clip(n // LIST_SIZE, 1, MOST_LISTS)))
    return indexes


class _Indexes(dict):
    """A length of which no vector was drawn has one list around the origin."""

    def __missing__(self, dim: int) -> Index:
        self[dim] = Index(np.zeros((1, dim)), 1)
        return self[dim]


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable) and kept, for each vector."""
    spark = vectors.sparkSession
    rows = pick(vectors, vec_id="long", embedding="array<double>")
    every = kept(in_arrow(rows, _units, "vec_id long, digest binary, dim int, unit binary"), "units")
    good = every.where("digest is not null and vec_id is not null")
    classes = kept(
        good.groupBy("digest", "dim").agg(F.min("vec_id").alias("node"), F.count_distinct("vec_id").alias("many"),
                                          F.first("unit").alias("unit")), "vector-classes")
    shared = spark.sparkContext.broadcast(_Indexes(fitted(classes)))
    placed = kept(in_arrow(classes.drop("digest"), _place(shared, threshold), _PLACED), "index")
    asked = placed.select(
        "dim", F.explode("probes").alias("list"), "node", "many", "unit", F.col("list").alias("own")).withColumn(
        "home", F.col("list") == F.col("own")).drop("own")
    chunks = lambda df, name: df.groupBy("dim", "list").agg(
        F.ceil(F.count("*") / CHUNK).cast("int").alias(name))
    lists = kept(chunks(asked, "n_asks").join(chunks(placed, "n_held"), ["dim", "list"]), "list-chunks")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    nothing = [F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error")]
    shown = ["dim", "list", "ask", "held", "node", "many", "unit"]
    asks = asked.join(lists, ["dim", "list"]).withColumn("ask", own("n_asks")).withColumn("held", all_of("n_held")).select(
        *shown, "home", F.lit(True).alias("asks"), *nothing)
    held = placed.join(lists, ["dim", "list"]).withColumn("held", own("n_held")).withColumn("ask", all_of("n_asks")).select(
        *shown, F.lit(True).alias("home"), F.lit(False).alias("asks"), "codes", "error")
    found = kept(grouped(
        asks.unionByName(held), ["dim", "list", "ask", "held"], _meet(shared, threshold), "a long, b long, n long"),
        "vector-links")
    parts = components(found.where("b is not null").select("a", "b"))
    counts = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "node")
    named = kept(
        classes.select("digest", "node", "many").join(parts, "node", "left").join(counts, "node", "left").select(
            "digest", F.coalesce("component", "node").alias("class_id"),
            (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("class_links")), "vector-names")
    none = F.col("digest").isNull() | F.col("vec_id").isNull()
    return every.join(named, "digest", "left").select(
        "vec_id", F.when(none, 0).otherwise(F.col("class_links")).cast("long").alias("n_links"),
        F.when(none, F.col("vec_id")).otherwise(F.col("class_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
