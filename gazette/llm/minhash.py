"""MinHash signatures, bands, and candidate clusters compared block by block.

Sets that share a band are linked to the least member of the band, unverified, and the
connected components of these links are the candidate clusters: every pair that shares
a band lies in one cluster. A cluster is cut into blocks of bounded size, and each pair
of blocks is one group for an exact comparison, so no pair of sets becomes a row and no
group is unbounded. Bands seen once are left out by a merged count-min sketch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import as_long, discard, fixed, in_arrow, kept, mix
from gazette.llm.graph import components
from gazette.llm.sketch import PARTS, Seen, bits_for, parts

#: Most members of a cluster in one block; two blocks meet in one group.
BLOCK = 256
_CACHED = 8192


def permutations(n: int) -> np.ndarray:
    """Odd multipliers: each orders the 32-bit numbers anew."""
    return np.random.default_rng(20241118).integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def signature(shingles: np.ndarray, starts: np.ndarray, a: np.ndarray) -> np.ndarray:
    """(sets, permutations): the least value of each permutation over each run of shingles.

    `starts` holds where each non-empty set begins; shingles may repeat in a set.
    """
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    out = np.empty((len(starts), len(a)), np.uint32)
    ends, wide = np.r_[starts[1:], len(x)], a[:, None]
    buffer = np.empty((len(a), min(_CACHED, len(x))), np.uint32)
    at = 0
    while at < len(starts):
        # sets are taken together as far as they fit into the processor's cache
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _CACHED, "right")))
        lo, hi = int(starts[at]), int(ends[to - 1])
        if to == at + 1:
            least = np.full(len(a), 0xFFFFFFFF, np.uint32)
            for cut in range(lo, hi, _CACHED):
                part = x[None, cut:min(hi, cut + _CACHED)]
                some = np.multiply(part, wide, out=buffer[:, :part.shape[1]])
                np.minimum(least, some.min(axis=1), out=least)
            out[at] = least
        else:
            some = np.multiply(x[None, lo:hi], wide, out=buffer[:, :hi - lo])
            out[at:to] = np.minimum.reduceat(some, starts[at:to] - lo, axis=1).T
        at = to
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """(sets, bands): one 64-bit key for each band of `rows` values."""
    n, k = signatures.shape
    key = np.broadcast_to(np.arange(1, k // rows + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95), (n, k // rows))
    for i in range(rows):
        odd = ((i + 1) * 0x632BE59BD9B4E019 | 1) % (1 << 64)
        key = key + signatures[:, i::rows] * np.uint64(odd)
    return mix(key)


def odd_sketches(signatures: np.ndarray, bits: int) -> np.ndarray:
    """(sets, bits / 8) parity bitmaps: each MinHash sample flips the bit it falls on."""
    n, k = signatures.shape
    place = mix(signatures.astype(np.uint64) + (np.arange(1, k + 1, dtype=np.uint64) << np.uint64(32)))
    place = (place % np.uint64(bits)).astype(np.int64)
    flips = np.bincount((place + np.arange(n)[:, None] * bits).ravel(), minlength=n * bits)
    return np.packbits((flips & 1).astype(np.uint8).reshape(n, bits), axis=1)


def odd_similarity(differing: np.ndarray, bits: int, samples: int) -> np.ndarray:
    """The similarity estimated from how many bits differ between two odd sketches."""
    odd = np.minimum(2.0 * differing / bits, 1 - 1e-9)
    return 1 + np.log1p(-odd) / np.log1p(-2.0 / bits) / (-2.0 * samples)


def band_sketch(bits: int):
    """The sketch of a task's band keys."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from parts((fixed(batch.column("bands"), np.uint64) for batch in batches), bits)

    return work


def _likely(node_type: pa.DataType, seen: Seen):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = batch.column("bands").to_pylist()
            keys = np.frombuffer(b"".join(bands), np.uint64)
            passed = seen.test(keys)
            rows = np.repeat(np.arange(len(bands)), [len(x) // 8 for x in bands])[passed]
            yield pa.record_batch({
                "node": batch.column("node").take(pa.array(rows)).cast(node_type), "band": as_long(keys[passed])})

    return work


def clusters(members: DataFrame, bands: int) -> DataFrame:
    """(node, cluster, n_blocks) of every member that shares a band with another one.

    `members` has a node, unique but for repeated rows, and its band keys as binary.
    """
    spark = members.sparkSession
    kind = dict(members.dtypes)["node"]
    node_type = pa.int64() if kind == "bigint" else pa.binary()
    bits = bits_for(members.count() * bands)
    seen = Seen(spark, in_arrow(members.select("bands"), band_sketch(bits), PARTS), 2, bits)
    likely = in_arrow(members, _likely(node_type, seen), f"node {kind}, band long")
    shared = kept(likely.distinct(), "likely-bands")
    leaders = kept(
        shared.groupBy("band").agg(F.min("node").alias("leader"), F.max("node").alias("other"))
        .where("leader < other").drop("other"), "band-leaders")
    links = shared.join(leaders, "band").select(F.col("leader").alias("a"), F.col("node").alias("b")).where("a < b")
    found = kept(components(links), "clusters")
    discard(shared, leaders)
    sizes = kept(
        found.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_blocks")), "cluster-sizes")
    return found.join(sizes, "component").select("node", F.col("component").alias("cluster"), "n_blocks")


def block_pairs(members: DataFrame) -> DataFrame:
    """Each member once for every block its own one meets: (cluster, low, high, mine, ...)."""
    mine = F.pmod(F.xxhash64("node"), F.col("n_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks").cast("long") - 1))
    return (
        members.withColumn("mine", mine).withColumn("other", other)
        .withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other"))
        .drop("other", "n_blocks"))


class Union:
    """Union-find over the members of one group."""

    def __init__(self, n: int):
        self.root = list(range(n))

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.root[max(x, y)] = min(x, y)
        return True


def links_of(node: list, sets: list[np.ndarray], pairs: np.ndarray, threshold: tuple[int, int]) -> list[tuple]:
    """A spanning forest of the pairs whose exact similarity reaches num/den, likeliest first.

    A pair already joined through others needs no check: it cannot change a component.
    """
    num, den = threshold
    found, union = [], Union(len(sets))
    for i, j in pairs.tolist():
        if union.find(i) == union.find(j):
            continue
        x, y = sets[i], sets[j]
        if den * min(len(x), len(y)) < num * max(len(x), len(y)):
            continue
        both = np.concatenate((x, y))
        both.sort()
        shared = int((both[1:] == both[:-1]).sum())
        if den * shared >= num * (len(x) + len(y) - shared):
            union.join(i, j)
            found.append((node[i], node[j]))
    return found


def link_batch(links: list[tuple], node_type: pa.DataType) -> pa.RecordBatch:
    return pa.record_batch({
        "a": pa.array([x for x, _ in links], node_type), "b": pa.array([y for _, y in links], node_type)})

