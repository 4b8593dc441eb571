r"""Merkle manifest of a dataset as an append log in postorder, with proofs read by position.

A tree of n leaves groups every FANOUT consecutive nodes of a level (the last run may be
shorter) until one is left. Its nodes are logged in the order in which they are completed:
a node follows its last child. So the position of the node over leaves a..e at level l is
known without any table: e leaves lie before leaf e, every run of FANOUT**k leaves that
ended before it has logged one node, and the node's own l predecessors end with leaf e:

    position = e + e // 8 + e // 64 + ... + l

Aligned builders work side by side, each on BLOCK = FANOUT**4 leaves in order; what one
logs is contiguous, one row of the log. The tops of the blocks are the leaves of the next
round of builders, so 4096 times the leaves cost one round more. A proof takes a leaf's
siblings level by level: up to the block's top from the block's own row, beyond it from
the log at their positions, one small list a block.

Places within a tree come from range partitions (see `order`), so a tree that holds most
of the rows is built by as many tasks as its blocks.

Rows: every row is a leaf, repeated rows and rows of null id too (nulls first; rows that
tie have equal leaves, or follow the leaf's hash). Null columns are marked, an empty text
is not a null one. An empty table gives no rows.
"""

from __future__ import annotations

import dataclasses
import functools
import hashlib
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import kept, pick, ship
from gazette.llm.order import placed

FANOUT = 8
_BITS = 3
_MOST = 20
#: Levels that one builder completes: its block has FANOUT**4 leaves, or tops of the round below.
LEVELS = 4

STEPS = "array<struct<before string, after string>>"


@dataclasses.dataclass
class Manifest:
    """Leaves by place, the log, and the root of each tree.

    `leaves`: the given columns with tree, at, n and h (the tree's leaves and height).
    `segments`: what the first builders logged: tree, block, first (position), nodes (digests).
    `upper`: the nodes above them and the blocks' tops: tree, position, hash.
    `roots`: tree, n, root.
    """

    leaves: DataFrame
    segments: DataFrame
    upper: DataFrame
    roots: DataFrame
    levels: int


def leaf_hash(*columns: Column) -> Column:
    """Hex digest of a row: each value as its byte count, a colon and the value; `-` for null."""
    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def _times(x: Column, level: Column) -> Column:
    """x * FANOUT**level."""
    return F.call_function("shiftleft", x, (level * _BITS).cast("int"))


def _part(x: Column, level: Column) -> Column:
    """x // FANOUT**level."""
    return F.call_function("shiftright", x, (level * _BITS).cast("int"))


def position(level: Column, index: Column, n: Column) -> Column:
    """Place in the log of node `index` of a level, in a tree of n leaves."""
    end = F.least(_times(index + 1, level), n) - 1
    return functools.reduce(Column.__add__, [F.shiftright(end, _BITS * k) for k in range(_MOST + 1)]) + level


def height(n: Column) -> Column:
    """Levels above the leaves."""
    return functools.reduce(Column.__add__, [(n > F.lit(FANOUT ** k)).cast("int") for k in range(_MOST + 1)])


def _digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _block(leaves: list[str], top: int) -> list[list[str]]:
    """All levels of a block, leaves first."""
    levels = [leaves]
    for _ in range(top):
        below = levels[-1]
        levels.append([_digest(below[a:a + FANOUT]) for a in range(0, len(below), FANOUT)])
    return levels


def completed(levels: list[list[str]]) -> Iterator[str]:
    """The nodes of a block in the order of completion."""
    n = len(levels[0])
    for i, leaf in enumerate(levels[0]):
        yield leaf
        for level in range(1, len(levels)):
            if (i + 1) % FANOUT ** level and i + 1 < n:
                break
            yield levels[level][i // FANOUT ** level]


def _leaves_of(table: pa.Table) -> list[str]:
    return table.sort_by("at").column("hash").to_pylist()


def _builder(levels: int):
    def build(key: tuple, table: pa.Table) -> pa.Table:
        tree, block, h = (k.as_py() for k in key)
        nodes = b"".join(map(bytes.fromhex, completed(_block(_leaves_of(table), min(levels, h)))))
        return pa.table({"tree": pa.array([tree], pa.string()), "block": pa.array([block], pa.int64()),
                         "nodes": pa.array([nodes], pa.binary())})

    return build


def _upper_builder(levels: int, below: int):
    def build(key: tuple, table: pa.Table) -> pa.Table:
        tree, block, h = (k.as_py() for k in key)
        made = _block(_leaves_of(table), min(levels, h - below))[1:]
        rows = [(below + k, block * FANOUT ** (levels - k) + j, x)
                for k, level in enumerate(made, 1) for j, x in enumerate(level)]
        level, at, hashes = zip(*rows)
        return pa.table({"tree": pa.array([tree] * len(rows), pa.string()), "level": pa.array(level, pa.int32()),
                         "at": pa.array(at, pa.int64()), "hash": pa.array(hashes, pa.string())})

    return build


def build(rows: DataFrame, by: list[str], levels: int = LEVELS) -> Manifest:
    """The log over `rows`: a tree for each value of `tree`, of the leaves `leaf` in the order `by`, then `leaf`."""
    ship(rows.sparkSession)
    ordered = placed(kept(rows, "rows"), ["tree"], [*by, "leaf"], "placed")
    sizes = kept(ordered.groupBy("tree").agg(F.count("*").alias("n")).withColumn("h", height(F.col("n"))), "sizes")
    most = sizes.agg(F.max("n")).head()[0] or 0
    leaves = ordered.join(sizes, "tree")
    block = FANOUT ** levels

    segments = kept(
        leaves.select("tree", F.floor(F.col("at") / block).alias("block"), "h", "at", F.col("leaf").alias("hash"))
        .groupBy("tree", "block", "h").applyInArrow(_builder(levels), "tree string, block bigint, nodes binary")
        .join(sizes, "tree").withColumn("first", position(F.lit(0), F.col("block") * block, F.col("n"))), "log")
    # the last node that a builder logs is the top of its block
    top = F.lower(F.hex(F.expr("substring(nodes, -32, 32)")))
    tops = segments.select("tree", "n", "h", F.col("block").alias("at"), top.alias("hash"))
    upper = [segments.select(
        "tree", (F.col("first") + F.octet_length("nodes") / 32 - 1).cast("long").alias("position"), top.alias("hash"))]
    below, done = levels, block
    roots = [tops.where(F.col("h") <= below)]
    while done < most:
        made = kept(
            tops.where(F.col("h") > below).withColumn("block", F.floor(F.col("at") / block))
            .groupBy("tree", "block", "h").applyInArrow(
                _upper_builder(levels, below), "tree string, level int, at bigint, hash string"), "log")
        made = made.join(sizes, "tree")
        upper.append(made.select("tree", position(F.col("level"), F.col("at"), F.col("n")).alias("position"), "hash"))
        tops = made.where(F.col("level") == below + levels).select("tree", "n", "h", "at", "hash")
        roots.append(made.where((F.col("level") == F.col("h"))).select("tree", "n", "h", "at", "hash"))
        below, done = below + levels, done * block
    roots = functools.reduce(DataFrame.unionByName, roots).select("tree", "n", F.col("hash").alias("root"))
    return Manifest(leaves, segments, functools.reduce(DataFrame.unionByName, upper), kept(roots, "roots"), levels)


def _above(log: Manifest) -> DataFrame:
    """(tree, block, above): the steps from each block's top to its root, siblings read from the log by position."""
    blocks = log.segments.where(F.col("h") > log.levels).select("tree", "block", "n", "h")
    level, at = F.col("level"), F.col("at")
    steps = (
        blocks.select("*", F.explode(F.sequence(F.lit(log.levels), F.col("h") - 1)).alias("level"))
        .withColumn("at", _part(F.col("block"), level - log.levels)))
    first = F.floor(at / FANOUT) * FANOUT
    count = F.ceil(F.col("n") / _times(F.lit(1).cast("long"), level))
    asked = steps.withColumn("other", F.explode(F.sequence(first, F.least(first + FANOUT, count) - 1))).select(
        "tree", "block", "level", "at", "other", position(level, F.col("other"), F.col("n")).alias("position"))
    found = asked.join(log.upper, ["tree", "position"])
    runs = found.groupBy("tree", "block", "level").agg(
        F.array_sort(F.collect_list(F.struct("other", "hash"))).alias("run"), F.first("at").alias("at"))
    join = lambda keep: F.array_join(F.transform(F.filter("run", keep), lambda x: x["hash"]), "")
    return runs.select("tree", "block", "level", F.struct(
        join(lambda x: x["other"] < F.col("at")).alias("before"), join(lambda x: x["other"] > F.col("at")).alias("after"),
    ).alias("step")).groupBy("tree", "block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("level", "step"))), lambda x: x["step"]).alias("above"))


def _within(levels: int, carried: list[str]):
    step = pa.struct([("before", pa.string()), ("after", pa.string())])

    def prove(key: tuple, leaves: pa.Table, segment: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("at")
        n, (log, h) = len(leaves), (segment.column(c)[0].as_py() for c in ("nodes", "h"))
        above = segment.column("above")[0].as_py() or []

        def node(level: int, index: int) -> str:
            # the same closed form, within the block
            end = min((index + 1) * FANOUT ** level, n) - 1
            at = 32 * (sum(end >> _BITS * k for k in range(levels + 1)) + level)
            return log[at:at + 32].hex()

        runs: dict[tuple[int, int], list[str]] = {}
        proofs = []
        for i in range(n):
            proof = []
            for level in range(min(levels, h)):
                at = i // FANOUT ** level
                run = at // FANOUT
                if (level, run) not in runs:
                    count = -(-n // FANOUT ** level)
                    runs[level, run] = [node(level, j) for j in range(run * FANOUT, min(run * FANOUT + FANOUT, count))]
                siblings, own = runs[level, run], at % FANOUT
                proof.append({"before": "".join(siblings[:own]), "after": "".join(siblings[own + 1:])})
            proofs.append(proof + above)
        return pa.table({**{c: leaves.column(c) for c in carried}, "proof": pa.array(proofs, pa.list_(step))})

    return prove


def prove(log: Manifest) -> DataFrame:
    """Each leaf's given columns, its tree, and `proof`: for each level the siblings left and right of its path."""
    carried = [c for c in log.leaves.columns if c not in ("at", "n", "h")]
    types = dict(log.leaves.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in carried) + f", proof {STEPS}"
    blocks = log.segments.select("tree", "block", "h", "nodes").join(_above(log), ["tree", "block"], "left")
    leaves = log.leaves.withColumn("block", F.floor(F.col("at") / FANOUT ** log.levels)).drop("n", "h")
    return leaves.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(
        _within(log.levels, carried), schema)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def tree_name(lang: Column) -> Column:
    """A name that orders as the language does, null first."""
    return F.when(lang.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), lang))


def documents(docs: DataFrame) -> DataFrame:
    """tree, doc_id, leaf, and `seen`: the leaf of the row as it was found after tampering.

    Tampering lower-cases A-Z in the texts of every third document by checksum of its id.
    """
    rows = pick(docs, doc_id="long", source="string", lang="string", n_chars="long", text="string")
    fields = lambda text: leaf_hash(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    leaf = fields(F.col("text"))
    touched = (F.crc32(F.col("doc_id").cast("string")) % 3 == 0) & F.col("text").rlike("[A-Z]")
    return rows.select(
        tree_name(F.col("lang")).alias("tree"), "doc_id", leaf.alias("leaf"),
        F.when(touched, fields(lower)).otherwise(leaf).alias("seen"))


def verify(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof, folded_root and verified of every document."""
    by_lang = build(documents(docs), ["doc_id"], levels)
    whole = build(by_lang.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("leaf")),
                  ["name"], levels)
    top = prove(whole).join(whole.roots.select("tree", "root"), "tree").select(
        F.col("name").alias("tree"), F.col("leaf").alias("subroot"), F.col("proof").alias("top"), "root")
    return prove(by_lang).join(kept(top, "top"), "tree").withColumn("proof", F.concat("proof", "top")).select(
        "doc_id", "leaf", "subroot", "root", "proof", fold(F.col("seen"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
