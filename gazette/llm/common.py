"""What the operators share: picking columns, words as numbers, passes over Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import pathlib
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.session import shared_dir

#: A word, and what stands between words, for Spark's regular expressions.
WORD_GAP = r"[\x20\x09-\x0D]+"

_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast to the given types, whatever else the table holds.

    A name is matched exactly first and then without regard to case; of several
    columns with one name the first counts. A column that is missing is null.
    """
    plain, at = numbered(df)
    return plain.select(*[
        (F.lit(None) if at(name) is None else F.col(at(name))).cast(kind).alias(name)
        for name, kind in columns.items()])


def numbered(df: DataFrame) -> tuple[DataFrame, Callable[[str], str | None]]:
    """The table with its columns named c0, c1, ..., and where a name went (see `pick`)."""
    names = df.columns

    def at(name: str) -> str | None:
        if name in names:
            return f"c{names.index(name)}"
        return next((f"c{i}" for i, other in enumerate(names) if other.lower() == name.lower()), None)

    return df.toDF(*[f"c{i}" for i in range(len(names))]), at


def words(text: str = "text"):
    """The words of a text column as an array; none for null."""
    parts = F.split(F.coalesce(F.col(text), F.lit("")), WORD_GAP)
    return F.filter(parts, lambda w: w != F.lit(""))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for a session, so that tasks can import it.

    The archive is made beside the driver and fetched by executors through Spark.
    """
    context = spark.sparkContext
    if getattr(context, "_llm_shipped", False):
        return
    package = pathlib.Path(__file__).resolve().parent.parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._llm_shipped = True


def trim() -> None:
    """Hand freed memory back: workers are used again, and a cluster counts what they hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: nothing to trim


def _tidy(work: Callable) -> Callable:
    def and_trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        trim()

    return and_trim


def in_arrow(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str,
) -> DataFrame:
    """`work` over the Arrow batches of each task."""
    ship(df.sparkSession)
    return df.mapInArrow(_tidy(work), schema)


def grouped(df: DataFrame, keys: list[str], work: Callable, schema: str) -> DataFrame:
    """`work` over the Arrow batches of each group."""
    ship(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(work, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """The texts of a batch as UTF-8, one at a time; null is empty."""
    for value in batch.column(column).cast(pa.binary()):
        yield value.as_py() or b""


def fixed(column: pa.Array | pa.ChunkedArray, dtype: str | type) -> np.ndarray:
    """Binary values without nulls, one after another, as numbers."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    parts = []
    for chunk in chunks:
        chunk = chunk.cast(pa.large_binary())
        if len(chunk):
            ends = np.frombuffer(chunk.buffers()[1], np.int64)[chunk.offset:chunk.offset + len(chunk) + 1]
            parts.append(np.frombuffer(chunk.buffers()[2], np.uint8)[ends[0]:ends[-1]])
    return np.concatenate(parts).view(dtype) if parts else np.empty(0, dtype)


def slices(batch: pa.RecordBatch, column: str, rows: int, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most `rows` rows and about `size` bytes of text, at least a row each."""
    held = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).cumsum()
    at = 0
    while at < batch.num_rows:
        before = held[at - 1] if at else 0
        to = min(at + rows, max(at + 1, int(np.searchsorted(held, before + size, "right"))), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


class Pool:
    """Rows added at the end of an array that doubles when it is full."""

    def __init__(self, first: np.ndarray):
        self.held, self.n = first, len(first)

    @property
    def rows(self) -> np.ndarray:
        return self.held[:self.n]

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.held):
            wider = np.empty((max(1024, 2 * len(self.held), self.n + len(more)), *self.held.shape[1:]), self.held.dtype)
            wider[:self.n] = self.rows
            self.held = wider
        self.held[self.n:self.n + len(more)] = more
        self.n += len(more)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash for each word; `bytes.split` parts at exactly the six gaps."""
    found = text.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        known = np.ones(size, np.uint64)
        np.cumprod(np.full(size - 1, base, np.uint64), out=known[1:])
        _powers[base] = known
    return known[:n]


def window_hashes(h: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of `width` numbers: polynomials from one running sum."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base, back = (_BASE, _UNBASE)
    if salt:
        base = (_BASE * (2 * salt + 1)) & ((1 << 64) - 1)
        back = pow(base, -1, 1 << 64)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _power(base, len(h)), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * _power(back, n))


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


#: Spark's setting by which shuffle files go when a query ends, not when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run meanwhile are deleted once each has ended."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def kept(df: DataFrame, name: str) -> DataFrame:
    """The same rows read back from a compressed table in the shared folder."""
    path = shared_dir(df.sparkSession, name)
    with shuffles_deleted(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._kept_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables that `kept` wrote, once nothing will read them again."""
    for table in tables:
        delete(table.sparkSession, table._kept_at)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder of this run below the shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lists(values: pa.Array, sizes) -> pa.ListArray:
    """A list column: the values one after another, so many to a row."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
