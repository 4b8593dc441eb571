"""Tables whose files are dealt by key, so that keys meet without moving the rows.

A table's rows lie in a fixed number of buckets by the hash of a key, below its partition
folders. Whoever needs one key's rows together, the last write of each article or a join
of pages with links, finds them in one bucket: the scan is read by bucket and text, html
and vectors are not shuffled. They are shuffled once, when they are written, so each
bucket of a write is one file.

The table is its folder: the session's catalog only learns about it, so any session can.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Bucketed:
    """A folder of rows of a schema, bucketed by `key`, in folders by `partitions`."""

    path: str
    schema: str
    key: str
    buckets: int
    partitions: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return "gazette_" + hashlib.sha256(f"{self.path} {self.key} {self.buckets}".encode()).hexdigest()[:24]


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def known(spark: SparkSession, table: Bucketed) -> str:
    """The name under which the session's catalog has the table."""
    if not spark.catalog.tableExists(table.name):
        folders = f"PARTITIONED BY ({', '.join(table.partitions)})" if table.partitions else ""
        # folders are found by listing: other sessions add some without telling this catalog
        with _setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false"):
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {table.name} ({table.schema}) USING parquet {folders} "
                f"CLUSTERED BY ({table.key}) SORTED BY ({table.key}) INTO {table.buckets} BUCKETS "
                f"LOCATION '{table.path}'")
    return table.name


def write_bucketed(rows: DataFrame, table: Bucketed) -> None:
    """Replace the partition folders that `rows` touch, or the whole table where it has none."""
    spark = rows.sparkSession
    name = known(spark, table)
    columns = spark.table(name).columns
    dealt = rows.select(*columns).repartition(table.buckets, table.key)
    # an insert takes the mode from the session only
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        dealt.write.insertInto(name, overwrite=True)
    spark.catalog.refreshTable(name)


def read_bucketed(spark: SparkSession, table: Bucketed) -> DataFrame:
    name = known(spark, table)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def bucketed_pages(pages: DataFrame, path: str, buckets: int) -> Bucketed:
    """Fetched pages stored by their url."""
    table = Bucketed(path, "url string, html string", "url", buckets)
    write_bucketed(pages.select("url", F.col("html")), table)
    return table
