"""Joins with a table of one row per key, safe where one key holds much of the other side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# A lookup table of at most this many rows and bytes is sent to every task.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20
# A key with more rows than this is not left to one task.
HOT_ROWS = 1_000_000
# Such keys taken out of a join at most; any other holds less than each of them.
MAX_HOT_KEYS = 100


def lookup(df: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """`df` joined with a table that has one row per key.

    The table is counted, in rows and in bytes written as text. A small one is
    broadcast, so crowded keys of `df` do not matter; beyond that see `split_join`.
    """
    if _small(table):
        return df.join(F.broadcast(table), key, how)
    return split_join(df, table, key, how)


def _small(table: DataFrame) -> bool:
    few = table.limit(MAX_BROADCAST_ROWS + 1).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*table.columns)))), F.lit(0)).alias("size")).first()
    return few["n"] <= MAX_BROADCAST_ROWS and few["size"] <= MAX_BROADCAST_BYTES


def split_join(df: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """A join by shuffle, but for the most crowded keys of `df`.

    Their few rows of the table are broadcast instead, if these are small, so no task
    gets all rows of such a key. Counting the keys combines before it shuffles. Rows
    without a key match nothing and are not shuffled either.
    """
    if how == "left":
        # a row without a key meets an empty table, which is broadcast
        alone = df.filter(F.col(key).isNull()).join(F.broadcast(table.limit(0)), key, "left")
        return _split(df.filter(F.col(key).isNotNull()), table, key, how).unionByName(alone)
    return _split(df, table, key, how)


def _split(df: DataFrame, table: DataFrame, key: str, how: str) -> DataFrame:
    crowded = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_ROWS)
    hot = [r[key] for r in crowded.orderBy(F.desc("n")).limit(MAX_HOT_KEYS).collect() if r[key] is not None]
    if not hot:
        return df.join(table, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    few = table.filter(F.col(key).isin(hot))
    if not _small(few):
        return df.join(table, key, how)
    return df.filter(~is_hot).join(table, key, how).unionByName(
        df.filter(is_hot).join(F.broadcast(few), key, how)
    )
