r"""Trie of conversation prefixes, its totals rolled up by centroid decomposition.

Every conversation is rebuilt: it takes its first turns from the first conversation of its
family, the rest from its own. A node is a distinct sequence of first turns. A prefix is
known by its exclusive-or of 128-bit hashes of (place, role, text), which combines over
range partitions, so a conversation that holds most turns is spread like any other. The
node's name is its smallest member and its depth: the path of that member holds all of the
node's ancestors, so what lies above a node is a look-up in the table of paths.

Totals of subtrees are added up over the forest of parent edges without walking it edge by
edge, however deep it is. Each component is split at its centroid, the deepest node that
still has more than half of the component's nodes below it; how many those are follows
from the paths of the members, since every node is counted with its smallest member. What
the centroid has below it within the component is one total, which is added to every node
on the way from the centroid to the component's top. Then the centroid is taken out; its
children's branches and what is above it are components of their own, none with more than
half of the nodes. Components of more than BOUND nodes are split so in Spark, all at once
each round; smaller ones are finished by one task each, by the same steps in memory.

The digest of a node's ends is one hash over an ordered list without a bound; its tasks
join ids into pieces, and the last one only feeds the pieces to the hash as they come.

Rows: turns without a conv_id belong to no conversation and are left out. Null role or
text is empty, and no other than an empty one. A null turn is the first; turns that tie
follow the digest of role and text, and repeated rows are turns of their own. An empty
table has no conversation and gives no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import in_arrow, kept, pick
from gazette.llm.order import placed

FAMILY = 100
HEADS = 6
#: Most nodes of a component that one task finishes.
BOUND = 1 << 16
_PIECE = 4096


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its family."""
    return F.crc32(conv_id.cast("string")) % HEADS


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, n_chars) of every rebuilt turn, and (conv_id, length) of every conversation."""
    rows = pick(conversations, conv_id="long", turn="long", role="string", text="string").where("conv_id is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = placed(kept(rows.select(
        "conv_id", "turn",
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.length(text).cast("long").alias("n_chars")), "turns"), ["conv_id"], ["turn", "digest"], "turns")
    turns = kept(turns.drop("turn"), "turns")
    counted = turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumns({
        "base": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": shared_turns(F.col("conv_id"))})
    counted = kept(counted, "conversations")
    bases = counted.where("conv_id = base").select("base", F.col("n").alias("n_base"))
    convs = kept(counted.join(bases, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("n_base", F.lit(0)))), "conversations")
    heads = turns.where((F.col("at") < HEADS) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    first = heads.join(convs.select("conv_id", "base", "h"), "base").where("at < h").select(
        "conv_id", (F.col("at") + 1).alias("depth"), "digest", "n_chars")
    own = turns.where(F.col("at") >= shared_turns(F.col("conv_id"))).join(
        convs.select("conv_id", "h", "taken"), "conv_id").select(
        "conv_id", (F.col("taken") + F.col("at") - F.col("h") + 1).alias("depth"), "digest", "n_chars")
    length = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return kept(first.unionByName(own), "rebuilt"), convs.select("conv_id", length.alias("length"))


def paths_of(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes, and (conv_id, depth, owner): every node on each conversation's path, root included.

    A node is (conv_id, depth) with its smallest member, parent_conv_id, n_convs and n_chars.
    """
    place = lambda seed: F.xxhash64(F.lit(seed), "digest", "depth")
    marked = placed(kept(turns.select("conv_id", "depth", "n_chars", place(1).alias("x"), place(2).alias("y")), "marked"),
                    ["conv_id"], ["depth"], "marked", ("x", "y"))
    prefixes = kept(marked.select("conv_id", "depth", "n_chars", F.col("x_upto").alias("x"), F.col("y_upto").alias("y")), "prefixes")
    met = kept(prefixes.groupBy("depth", "x", "y").agg(
        F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), F.max("n_chars").alias("n_chars")), "met")
    root = convs.agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs")).head()
    top = F.lit(root.owner).cast("long")
    paths = kept(
        prefixes.select("conv_id", "depth", "x", "y").join(met.select("depth", "x", "y", "owner"), ["depth", "x", "y"])
        .select("conv_id", "depth", "owner")
        .unionByName(convs.select("conv_id", F.lit(0).cast("long").alias("depth"), top.alias("owner"))), "paths")
    above = paths.select(F.col("conv_id").alias("owner"), (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent_conv_id"))
    nodes = met.join(above, ["owner", "depth"]).select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_chars")
    # the root is known by itself
    first = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        F.lit(0).cast("long").alias("n_chars"))
    return kept(nodes.unionByName(first), "nodes"), paths


def sizes_of(paths: DataFrame) -> DataFrame:
    """(conv_id, depth, size): how many nodes each node's subtree has.

    A conversation is the smallest member of the last nodes of its path, if of any; along the
    path it counts those of them that are not above.
    """
    spans = paths.groupBy("conv_id").agg(
        F.max("depth").alias("last"), F.min(F.when(F.col("owner") == F.col("conv_id"), F.col("depth"))).alias("since"))
    below = F.coalesce(F.col("last") - F.greatest("since", "depth") + 1, F.lit(0))
    return (
        paths.join(spans, "conv_id").groupBy("owner", "depth").agg(
            F.sum(F.when(F.col("since").isNotNull(), below).otherwise(0)).alias("size"))
        .withColumnRenamed("owner", "conv_id"))


def _split(state: DataFrame, paths: DataFrame, bound: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round: the split components, the centroids taken out, and components within the bound."""
    comp = ["top_id", "top_depth"]
    totals = kept(state.groupBy(*comp).agg(F.max("size").alias("total")), "totals")
    sized = state.join(totals, comp)
    small = sized.where(F.col("total") <= bound).drop("total")
    big = kept(sized.where(F.col("total") > bound), "components")
    # the nodes with more than half below them are a path; its last one is the centroid
    centres = kept(big.where("2 * size > total").groupBy(*comp).agg(
        F.max(F.struct("depth", "conv_id", "size")).alias("c")).select(
        *comp, F.col("c.conv_id").alias("c_id"), F.col("c.depth").alias("c_depth"), F.col("c.size").alias("c_size")), "centroids")
    at = lambda depth, name: paths.select("conv_id", F.col("depth").alias(depth), F.col("owner").alias(name))
    rows = (
        big.drop("total").join(centres, comp).withColumn("next", F.col("c_depth") + 1)
        .join(at("c_depth", "here"), ["conv_id", "c_depth"], "left")
        .join(at("next", "child"), ["conv_id", "next"], "left"))
    rows = kept(rows.withColumn("below", F.coalesce(
        (F.col("here") == F.col("c_id")) & (F.col("depth") >= F.col("c_depth")), F.lit(False))), "marked")
    sums = kept(rows.where("below").groupBy(*comp).agg(F.sum("leaf").alias("add_leaf"), F.sum("saved").alias("add_saved")), "sums")
    way = centres.join(sums, comp).join(
        paths.select(F.col("conv_id").alias("c_id"), "depth", F.col("owner").alias("conv_id")), "c_id").where(
        "depth between top_depth and c_depth").select("conv_id", "depth", "add_leaf", "add_saved", F.col("c_size").alias("less"))
    add = lambda name: F.coalesce(name, F.lit(0).cast("long"))
    taken = (F.col("conv_id") == F.col("c_id")) & (F.col("depth") == F.col("c_depth"))
    after = kept(rows.join(way, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "leaf", "saved", (F.col("size") - add("less")).alias("size"),
        (F.col("n_leaves") + add("add_leaf")).alias("n_leaves"),
        (F.col("saved_tokens") + add("add_saved")).alias("saved_tokens"),
        F.when(F.col("below") & ~taken, F.col("child")).otherwise(F.col("top_id")).alias("top_id"),
        F.when(F.col("below") & ~taken, F.col("next")).otherwise(F.col("top_depth")).alias("top_depth"),
        taken.alias("taken")), "split")
    return after.where("not taken").drop("taken"), after.where("taken").drop("taken"), small


def decompose(parent: list[int], leaf: list[int], saved: list[int]) -> tuple[list[int], list[int]]:
    """Subtree totals of a component whose nodes come parents first; the first one's parent is -1."""
    n = len(parent)
    leaves, tokens = [0] * n, [0] * n
    size, branch = [0] * n, [-1] * n
    open_ = [list(range(n))]
    while open_:
        nodes = open_.pop()
        top, total = nodes[0], len(nodes)
        for v in nodes:
            size[v], branch[v] = 1, -1
        for v in reversed(nodes):
            if v != top:
                size[parent[v]] += size[v]
        centre = next(v for v in reversed(nodes) if 2 * size[v] > total)
        rest, parts, add_leaf, add_saved = [], {}, leaf[centre], saved[centre]
        branch[centre] = centre
        for v in nodes:
            if v == centre:
                continue
            up = branch[parent[v]] if v != top else -1
            if up < 0:
                rest.append(v)
                continue
            branch[v] = v if up == centre else up
            parts.setdefault(branch[v], []).append(v)
            add_leaf += leaf[v]
            add_saved += saved[v]
        v = centre
        while True:
            leaves[v] += add_leaf
            tokens[v] += add_saved
            if v == top:
                break
            v = parent[v]
        if rest:
            open_.append(rest)
        open_.extend(parts.values())
    return leaves, tokens


_ROLLED = "conv_id bigint, depth bigint, n_leaves bigint, saved_tokens bigint"


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of whole components, which come one after another, parents first."""
    key, held = None, []

    def out(rows: list[tuple]) -> pa.RecordBatch:
        place = {(r[0], r[1]): i for i, r in enumerate(rows)}
        parent = [-1] + [place[r[2], r[1] - 1] for r in rows[1:]]
        leaves, tokens = decompose(parent, [r[3] for r in rows], [r[4] for r in rows])
        return pa.record_batch({
            "conv_id": pa.array([r[0] for r in rows], pa.int64()), "depth": pa.array([r[1] for r in rows], pa.int64()),
            "n_leaves": pa.array([r[5] + x for r, x in zip(rows, leaves)], pa.int64()),
            "saved_tokens": pa.array([r[6] + x for r, x in zip(rows, tokens)], pa.int64())})

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (
            "conv_id", "depth", "parent_conv_id", "leaf", "saved", "n_leaves", "saved_tokens", "top_id", "top_depth")]
        for *row, top_id, top_depth in zip(*columns):
            if (top_id, top_depth) != key:
                if held:
                    yield out(held)
                key, held = (top_id, top_depth), []
            held.append(tuple(row))
    if held:
        yield out(held)


def roll_up(nodes: DataFrame, paths: DataFrame, bound: int = BOUND) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens): totals of `leaf` and `saved` over each node's subtree.

    `nodes` has conv_id, depth, parent_conv_id, leaf and saved; `paths` is that of `paths_of`.
    """
    owners = nodes.select("conv_id").distinct()
    paths = kept(paths.join(owners, "conv_id", "left_semi"), "paths")
    zero = F.lit(0).cast("long")
    root = nodes.where("depth = 0").select("conv_id").head()
    state = kept(nodes.select("conv_id", "depth", "parent_conv_id", "leaf", "saved").withColumns({
        "n_leaves": zero, "saved_tokens": zero, "top_id": F.lit(root and root[0]).cast("long"), "top_depth": zero,
    }).join(sizes_of(paths), ["conv_id", "depth"]), "state")
    done, small = [], []
    while not state.isEmpty():
        state, taken, within = _split(state, paths, bound)
        done.append(taken.select("conv_id", "depth", "n_leaves", "saved_tokens"))
        small.append(within)
    for part in small:
        done.append(in_arrow(
            part.repartition("top_id", "top_depth").sortWithinPartitions("top_id", "top_depth", "depth"), _finish, _ROLLED))
    if not done:
        return state.select("conv_id", "depth", "n_leaves", "saved_tokens")
    rolled = done[0]
    for more in done[1:]:
        rolled = rolled.unionByName(more)
    return rolled


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a node's ids, joined; at most _PIECE ids a run."""
    key, held = None, []

    def out() -> pa.RecordBatch:
        return pa.record_batch({
            "conv_id": pa.array([key[0]], pa.int64()), "depth": pa.array([key[1]], pa.int64()),
            "first": pa.array([held[0]], pa.int64()), "ids": pa.array([",".join(map(str, held))], pa.string())})

    for batch in batches:
        for node, depth, member in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "member"))):
            if (node, depth) != key or len(held) == _PIECE:
                if held:
                    yield out()
                key, held = (node, depth), []
            held.append(member)
    if held:
        yield out()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each node over its pieces, which come in order."""
    key, digest, done = None, None, []

    def out() -> pa.RecordBatch:
        node, depth, found = zip(*done)
        return pa.record_batch({
            "conv_id": pa.array(node, pa.int64()), "depth": pa.array(depth, pa.int64()),
            "ends_sha256": pa.array(found, pa.string())})

    for batch in batches:
        for node, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))):
            if (node, depth) != key:
                if key:
                    done.append((*key, digest.hexdigest()))
                key, digest = (node, depth), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield out()
            done = []
    if key:
        done.append((*key, digest.hexdigest()))
        yield out()


def ends_of(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, member): the node at which each conversation ends."""
    return convs.select("conv_id", F.col("length").alias("depth")).join(paths, ["conv_id", "depth"]).select(
        F.col("owner").alias("conv_id"), "depth", F.col("conv_id").alias("member"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes at which conversations end."""
    ordered = kept(ends, "ends").repartitionByRange("conv_id", "depth", "member").sortWithinPartitions("conv_id", "depth", "member")
    pieces = in_arrow(ordered, _pieces, "conv_id bigint, depth bigint, first bigint, ids string")
    return in_arrow(
        pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first"), _hashed,
        "conv_id bigint, depth bigint, ends_sha256 string")


def trie(conversations: DataFrame, bound: int = BOUND) -> DataFrame:
    """Every node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuild(conversations)
    nodes, paths = paths_of(turns, convs)
    children = nodes.where("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    place = ["conv_id", "depth"]
    nodes = kept(nodes.join(children, place, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
        "leaf": F.col("n_children").isNull().cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("n_chars")}), "nodes")
    return (
        nodes.drop("leaf", "saved", "n_chars").join(roll_up(nodes, paths, bound), place)
        .join(end_digests(ends_of(paths, convs)), place, "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))
