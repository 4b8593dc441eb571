"""Mixing sources to target weights: equal blocks of words by highest quotients.

Every source's words, its documents in a seeded order, are cut into equal blocks. The
targets share out what is wanted by weight, a source's excess over twice its size going
to the others. The seats of the mix, one block each, go to the sources by the
Sainte-Lague rule (the next seat to the highest target / (2 k + 1)), shard after shard,
so each shard has integer quotas. Sources whose target is below FINE blocks share seats
of one word among themselves instead, so that no source is a block off a target of a few
words. A source then takes whole passes over its blocks and,
for the rest, a seeded selection by a permutation of its block numbers (a rotation where
blocks are single words, which keeps them in a run), so nothing is drawn or ranked.

Sums run first per bucket of a source, so a source that holds most rows is spread over
many tasks. One row for each source is all that is ranked as a whole.

Rows: one for each document. Null text has size 0. A null source is a source of its
own, the last. Rows that repeat all of doc_id, source and text are told apart only by
their place in the order. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import kept, numbered, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 64
#: A source wanted for fewer blocks than this is counted in words.
FINE = 64
SHARDS = 8
SEED = 20241118
#: Blocks are made larger beyond so many, so that block arithmetic fits 64 bits.
_MOST_BLOCKS = 1 << 30
_ROWS_A_BUCKET = 512
_PRIMES = (1_000_000_007, 998_244_353)


def _ranked(table: DataFrame) -> DataFrame:
    """Each source's place (from 0) by code point, null last, without a single task for all."""
    ordered = kept(
        table.sort(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()), "sources")
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    parts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = parts.withColumn("before", F.sum("n").over(Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)))
    return (
        ordered.withColumn("part", part).join(before.select("part", "before"), "part")
        .withColumn("place", inside + F.coalesce("before", F.lit(0))).drop("part", "before", "at"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, grp, source_size, place, weight, target from one row for each source.

    The level (words for a unit of weight) rises from round to round as sources reach
    their limit; each round is one sum over the sources.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = kept(_ranked(sizes).withColumn("weight", weight), "weights")
    limit = most * F.col("source_size")
    wanted, free = table.agg(share * F.sum("source_size"), F.sum(F.when(F.col("source_size") > 0, F.col("weight")))).first()
    level, last = (wanted or 0) / (free or 1), -1.0
    while level != last:
        full = F.col("weight") * F.lit(level) >= limit
        held, free = table.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        last, level = level, (wanted - (held or 0)) / free if free else level
    return table.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), limit.cast("double")))


def quotas(table: DataFrame, block: int, shards: int = SHARDS) -> DataFrame:
    """grp, shard and blocks: the seats of each source in each shard.

    After h seats a source has about h times its share; with s sources the quotient rule
    departs from that by no more than share * s / 2 + 1 seats. Seats below that range are
    certain, those within it are ranked by quotient for each shard's last seat.
    """
    n, total = table.agg(F.count("*"), F.sum("target")).first()
    seats = int((total or 0) / block + 0.5)
    ends = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(seats * (i + 1) // shards).cast("long").alias("seats"))
                     for i in range(shards)])
    share = F.col("target") / F.lit(max(total or 0, 1e-9))
    around = share * F.lit(n / 2) + 1
    spread = table.where("target > 0").select("grp", "place", "target", F.explode(ends).alias("end")).select(
        "grp", "place", "target", "end.shard", "end.seats", (share * F.col("end.seats")).alias("even"), around.alias("around"))
    spread = spread.withColumn("sure", F.greatest(F.lit(0), F.floor(F.col("even") - F.col("around")))).withColumn(
        "likely", F.ceil(F.col("even") + F.col("around")))
    open_ = spread.groupBy("shard").agg((F.first("seats") - F.sum("sure")).alias("open"))
    seat = spread.withColumn("k", F.explode(F.sequence("sure", "likely"))).withColumn(
        "nth", F.row_number().over(Window.partitionBy("shard").orderBy(
            (F.col("target") / (2 * F.col("k") + 1)).desc(), "place", "k")))
    won = seat.join(open_, "shard").where("nth <= open").groupBy("grp", "shard").agg(F.count("*").alias("won"))
    reached = spread.join(won, ["grp", "shard"], "left").select(
        "grp", "shard", (F.col("sure") + F.coalesce("won", F.lit(0))).alias("reached"))
    so_far = Window.partitionBy("grp").orderBy("shard")
    return reached.select(
        "grp", "shard", (F.col("reached") - F.coalesce(F.lag("reached").over(so_far), F.lit(0))).alias("blocks"))


def _times(j: Column) -> Column:
    """How often block j of a source is taken."""
    p = F.when(F.col("block") == 1, F.lit(1)).when(
        F.col("n_blocks") % _PRIMES[0] != 0, F.lit(_PRIMES[0])).otherwise(F.lit(_PRIMES[1]))
    moved = (j * (p % F.col("n_blocks")) + F.col("shift")) % F.col("n_blocks")
    return F.floor(F.col("quota") / F.col("n_blocks")) + F.when(
        moved < F.col("quota") % F.col("n_blocks"), 1).otherwise(0)


def _blocks_of() -> Column:
    return F.sequence(F.expr("start div block"), F.expr("(start + size - 1) div block"))


def planned(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block_words: int = BLOCK_WORDS,
    shards: int = SHARDS, seed: int = SEED,
) -> DataFrame:
    """All columns of `docs` as c0, c1, ... with size, source_size, target, start, block, quota, n_blocks, shift."""
    plain, at = numbered(docs)
    source = F.col(at("source")).cast("string") if at("source") else F.lit(None).cast("string")
    n_rows = plain.count()
    rows = plain.withColumns({
        "text": F.col(at("text")).cast("string"), "source": source,
        "grp": F.coalesce(F.concat(F.lit("="), source), F.lit("")),
        "drawn": F.xxhash64(F.col(at("doc_id")).cast("long"), F.col(at("text")).cast("string"), F.lit(seed)),
    }).withColumn("size", F.size(words()).cast("long")).withColumn(
        "bucket", F.pmod("drawn", F.lit(n_rows // _ROWS_A_BUCKET + 1)))
    buckets = kept(rows.groupBy("source", "grp", "bucket").agg(F.sum("size").alias("n")), "buckets")
    table = targets(buckets.groupBy("source", "grp").agg(F.sum("n").alias("source_size")), weights, share)
    table = kept(table, "targets")
    block = max(block_words, (table.agg(F.sum("target")).first()[0] or 0) // _MOST_BLOCKS + 1)
    block = int(block)
    fine = F.col("target") < FINE * block
    seats = quotas(table.where(~fine), block, shards).unionByName(quotas(table.where(fine), 1, shards))
    seats = seats.groupBy("grp").agg(F.sum("blocks").alias("quota"))
    table = table.withColumn("block", F.when(fine, 1).otherwise(block).cast("long"))
    n_blocks = F.ceil(F.col("source_size") / F.col("block"))
    table = kept(
        table.join(seats, "grp", "left").withColumn("n_blocks", n_blocks)
        .withColumn("quota", F.least(F.coalesce("quota", F.lit(0)), MOST * n_blocks))
        .withColumn("shift", F.when(n_blocks > 0, F.pmod(F.xxhash64("grp", F.lit(seed)), n_blocks)).otherwise(0)),
        "quotas")
    ahead = Window.partitionBy("grp").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    places = kept(
        buckets.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
        .join(table.select("grp", "source_size", "target", "block", "quota", "n_blocks", "shift"), "grp")
        .drop("source", "n"), "places")
    inside = Window.partitionBy("grp", "bucket").orderBy("drawn", at("doc_id")).rowsBetween(
        Window.unboundedPreceding, -1)
    return rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        places, ["grp", "bucket"]).withColumn("start", F.col("ahead") + F.col("inside"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted), for each document."""
    _, at = numbered(docs)
    names = [n for n in (at("doc_id"), at("text"), at("source")) if n]
    lean = numbered(docs)[0].select(*[F.col(n).alias(k) for n, k in zip(names, ("doc_id", "text", "source"))])
    rows = planned(lean, **how)
    overlap = lambda j: (F.least(F.col("start") + F.col("size"), (j + 1) * F.col("block"))
                         - F.greatest(F.col("start"), j * F.col("block")))
    taken = F.when(F.col("size") > 0, F.aggregate(
        _blocks_of(), F.lit(0).cast("long"), lambda a, j: a + overlap(j) * _times(j))).otherwise(0)
    return rows.select(
        F.col("c0").cast("long").alias("doc_id"), "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix as rows of `docs`: a document once for each pass that takes words of it.

    A pass that takes all words has the text as it is; one that takes some has these
    words joined by one space. Documents of which nothing is taken are left out.
    """
    rows = planned(docs, **how)
    _, at = numbered(docs)
    ws = words()
    turn = lambda i: F.get("turns", F.floor((F.col("start") + i) / F.col("block")) - F.floor(F.col("start") / F.col("block")))
    rows = rows.where("size > 0").withColumn("turns", F.transform(_blocks_of(), _times))
    passes = rows.withColumn("pass", F.explode(F.expr(
        "case when array_max(turns) > 0 then sequence(1L, array_max(turns)) end")))
    whole = F.array_min("turns") >= F.col("pass")
    some = F.array_join(F.filter(ws, lambda w, i: turn(i) >= F.col("pass")), " ")
    return passes.select(*[
        (F.when(whole, F.col("text")).otherwise(some) if c == at("text") else F.col(c)).alias(n)
        for c, n in ((f"c{i}", n) for i, n in enumerate(docs.columns))])
