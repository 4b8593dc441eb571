"""A queue of messages in a shared folder that offers failed ones again.

    queue/sent/delivery=0000000007/      one message a line, as it was sent
    queue/returned/batch_id=12/          messages that batch 12 could not handle, with their attempts

A delivery counts once it is whole, which its `_SUCCESS` file tells, and once all
before it are. The stream's offset is how many of either kind it has offered, so
it is two numbers however long the queue gets, and a batch that is planned again
gets the same messages.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

# The tasks that read a queue get this module's classes with the plan: they need not import the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "message_id string, value string, attempts int"
KINDS = {"sent": "delivery", "returned": "batch_id"}


def _open(path: str):
    """File system and plain path of a folder: local ones and those that Arrow knows."""
    from pyarrow import fs

    if "://" not in path:
        path = path.removeprefix("file:")
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class Part(InputPartition):
    """One file of a delivery."""

    def __init__(self, kind: str, path: str):
        self.kind, self.path = kind, path


class QueueReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _folder(self, kind: str, number: int) -> str:
        return f"{kind}/{KINDS[kind]}={number:010d}" if kind == "sent" else f"{kind}/{KINDS[kind]}={number}"

    def initialOffset(self) -> dict:
        return {kind: 0 for kind in KINDS}

    def latestOffset(self) -> dict:
        system, root = _open(self.path)
        upto = {}
        for kind in KINDS:
            whole = 0
            while system.get_file_info(f"{root}/{self._folder(kind, whole)}/_SUCCESS").is_file:
                whole += 1
            upto[kind] = whole
        return upto

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        from pyarrow import fs

        system, root = _open(self.path)
        parts = []
        for kind in KINDS:
            for number in range(start[kind], end[kind]):
                folder = fs.FileSelector(f"{root}/{self._folder(kind, number)}")
                names = sorted(f.path for f in system.get_file_info(folder) if f.is_file and f.size)
                parts += [Part(kind, name) for name in names if not name.rsplit("/", 1)[1].startswith(("_", "."))]
        return parts

    def read(self, partition: Part) -> Iterator[tuple]:
        import io

        system, _ = _open(self.path)
        with system.open_input_stream(partition.path) as file:
            place = "/".join(partition.path.rsplit("/", 2)[-2:])
            for number, line in enumerate(io.TextIOWrapper(file, "utf-8", newline="\n")):
                line = line.rstrip("\n")
                if partition.kind == "sent":
                    yield f"{place}#{number}", line, 0
                else:
                    again = json.loads(line)
                    yield again["message_id"], again["value"], again["attempts"]

    def commit(self, end: dict) -> None:
        """Nothing to do: deliveries stay until somebody clears the queue."""


class MessageQueue(DataSource):
    """`spark.readStream.format("message_queue").load(path)`."""

    @classmethod
    def name(cls) -> str:
        return "message_queue"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> QueueReader:
        return QueueReader(self.options["path"])


def queue_stream(spark: SparkSession, path: str) -> DataFrame:
    """A queue as a stream of `message_id`, `value` and `attempts`."""
    spark.dataSource.register(MessageQueue)
    return spark.readStream.format("message_queue").option("path", path).load()


def deliver(messages: DataFrame, path: str) -> int:
    """Add the texts of `value` to a queue as its next delivery; returns its number.

    Of two senders that take one number the later one fails and takes the next.
    """
    number = QueueReader(path).latestOffset()["sent"]
    while True:
        try:
            messages.select("value").write.mode("errorifexists").text(f"{path}/sent/delivery={number:010d}")
            return number
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            number += 1


def return_messages(failed: DataFrame, path: str, batch_id: int) -> None:
    """Put a batch's failed messages back; none is written down too, so that later ones count."""
    rows = failed.select("message_id", "value", F.col("attempts").cast("int").alias("attempts"))
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/returned/batch_id={batch_id}")
