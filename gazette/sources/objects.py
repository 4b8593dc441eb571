"""Stored article objects and exported files."""

from __future__ import annotations

import contextlib
import logging
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gazette.functions.dates import utc_day
from gazette.functions.text import na_strings_to_null
from gazette.functions.bodies import body_rows
from gazette.operators.filters import in_range, split_by
from gazette.schemas import ARTICLE, ARTICLE_CSV
from gazette.session import shared_dir
from gazette.sources.files import none_if_missing

logger = logging.getLogger(__name__)

#: Objects listed and read at once: a driver holds the listing of so many, however many there are.
PASS = 20_000

# Settings for reading so many small files: a task takes more than a few of them, explicit
# paths are looked up by no more tasks than run at once, and listings are not kept.
_SMALL_FILES = {
    "spark.sql.files.openCostInBytes": "16k",
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
}
_LOOKUPS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# Names that Spark leaves out of a folder, and what is special in a path.
_HIDDEN = re.compile(r"\.|_(?!metadata|common_metadata)[^=]*$|.*\._COPYING_$")
_GLOB = re.compile(r"([{}\[\]*?\\])")


def list_objects(spark: SparkSession, path: str) -> DataFrame:
    """`Key` and `LastModified` of every file below `path` (S7); no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("Key"), F.col("modificationTime").alias("LastModified"))


def object_days(spark: SparkSession, path: str) -> DataFrame:
    """`Key` and the UTC day it was stored."""
    return list_objects(spark, path).select("Key", utc_day(F.col("LastModified")).alias("date"))


def read_objects(
    spark: SparkSession,
    path: str,
    schema: str = ARTICLE,
    start_date: str | None = None,
    end_date: str | None = None,
    whole_end_day: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON objects stored in a date range, and rejects.

    An object file gives one row, a list file one row per element; a file that is
    neither is a reject with its text in `_corrupt_record`. `Key` and
    `LastModified` come along. Files outside the range are left out before any
    is opened. The others are read now, `PASS` at a time, into a table in the shared folder.
    """
    files = _object_files(spark, path, start_date, end_date, whole_end_day)
    rows = files.withColumn("rows", body_rows(F.col("_corrupt_record"), schema))
    good, bad = split_by(rows, F.col("rows").isNotNull())
    return good.select("Key", "LastModified", F.inline("rows")), bad.drop("rows")


def _object_files(spark: SparkSession, path: str, *days) -> DataFrame:
    """`Key`, `LastModified` and text of a range's objects, gathered in a table pass by pass."""
    gathered = shared_dir(spark, "object-files")
    for paths in _passes(spark, path):
        with _small_files(spark):
            files = spark.read.text(paths, wholetext=True, recursiveFileLookup=True).select(
                F.col("_metadata.file_path").alias("Key"),
                F.col("_metadata.file_modification_time").alias("LastModified"),
                F.col("value").alias("_corrupt_record"),
            )
            in_range(files, "LastModified", *days).write.mode("append").parquet(gathered)
    return spark.read.schema(files.schema).parquet(gathered)


def _passes(spark: SparkSession, path: str) -> Iterator[list[str]]:
    """All below `path` in lists of files and of folders to read whole, at most `PASS` files to a list.

    Folders are counted, and opened only where they hold more. A missing path is left for
    the reader to refuse.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    held, n = [], 0
    for root in fs.globStatus(pattern) or ():
        for count, found in _parts(fs, root):
            if held and n + count > PASS:
                yield held
                held, n = [], 0
            held.append(_GLOB.sub(r"\\\1", found))
            n += count
    yield held or [path]


def _parts(fs, status) -> Iterator[tuple[int, str]]:
    """A file or folder and its number of files, or the parts of a folder that holds more than `PASS`."""
    at = status.getPath()
    if not status.isDirectory():
        yield 1, at.toString()
        return
    n = fs.getContentSummary(at).getFileCount()
    if n <= PASS:
        yield n, at.toString()
        return
    inside = fs.listStatusIterator(at)
    while inside.hasNext():
        one = inside.next()
        if not _HIDDEN.match(one.getPath().getName()):
            yield from _parts(fs, one)


@contextlib.contextmanager
def _small_files(spark: SparkSession) -> Iterator[None]:
    settings = _SMALL_FILES | {_LOOKUPS: str(max(2, spark.sparkContext.defaultParallelism))}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def further_keys(
    spark: SparkSession, path: str, schema: str = ARTICLE, start_date: str | None = None,
    end_date: str | None = None, whole_end_day: bool = False,
) -> list[str]:
    """Keys that objects of a date range have beyond `schema`, in order: one pass, one name each."""
    body = F.col("_corrupt_record")
    several = F.coalesce(F.from_json(body, "array<string>"), F.array())
    parts = F.when(body.rlike(r"^\s*\["), several).otherwise(F.array(body))
    names = (
        _object_files(spark, path, start_date, end_date, whole_end_day)
        .select(F.explode(parts).alias("part")).select(F.explode(F.json_object_keys("part")).alias("name")).distinct()
    )
    known = [f.name for f in T.StructType.fromDDL(schema).fields]
    return sorted(r.name for r in names.where(~F.col("name").isin(known)).collect())


def read_json_lines(spark: SparkSession, path: str, schema: str = ARTICLE) -> DataFrame:
    """Rows of a JSON-lines export, blank lines left out, unreadable lines in `_corrupt_record` (split by `split_corrupt`)."""
    row = F.from_json(
        "value", f"{schema}, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"}
    )
    return spark.read.text(path).where(F.trim("value", F.lit(" \t\r")) != "").select(row.alias("row")).select("row.*")


def read_export(spark: SparkSession, path: str, schema: str = ARTICLE_CSV) -> DataFrame | None:
    """One exported CSV by its header, or None where it does not exist.

    Every cell is read as text, missing-value tokens become null, then columns
    named in `schema` get their type; no pass over the file is spent on guessing.
    """
    raw = none_if_missing(
        lambda: spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    )
    if raw is None:
        logger.warning("no export at %s, skipped", path)
        return None
    types = {f.name: f.dataType for f in T.StructType.fromDDL(schema).fields}
    cells = na_strings_to_null(raw)
    return cells.select(*[_typed(F.col(f"`{c}`"), types.get(c, T.StringType())).alias(c) for c in cells.columns])


def _typed(cell: Column, kind: T.DataType) -> Column:
    """A cell in its column's type; a whole number may be written as `1731924672.0`, as where a column has gaps."""
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return cell.try_cast(kind)
    number = cell.try_cast("decimal(38,6)")
    return F.coalesce(cell.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))


def read_exports(spark: SparkSession, paths: list[str], schema: str = ARTICLE_CSV) -> list[DataFrame]:
    """The exports among `paths` that exist."""
    found = [read_export(spark, p, schema) for p in paths]
    return [df for df in found if df is not None]
