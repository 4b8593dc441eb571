"""Places within groups of any size, by range partitions and what went before each of them.

A window over a group puts the group in one task. Here the rows are range-partitioned and
sorted, so that a crowded group spreads over neighbouring partitions; each task numbers
what it holds, and the rows of a group that began in an earlier partition are shifted by
what those hold. Only a partition's first and last groups can be shared, so the shifts
are one row a partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import in_arrow, kept


def _starts(batch: pa.RecordBatch, group: list[str], last: list | None) -> np.ndarray:
    """True where a row's group is not that of the row before; `last` is the row before the first."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = last is None or any(batch.column(g)[0].as_py() != v for g, v in zip(group, last))
    for g in group:
        column = batch.column(g)
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return new


def _numbering(group: list[str], sums: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held, before = TaskContext.get().partitionId(), None, 0, dict.fromkeys(sums, 0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = _starts(batch, group, last)
            # where each row's group starts in the batch; -1: before it
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            nth = np.where(start < 0, held + np.arange(n), np.arange(n) - start)
            out = {name: batch.column(name) for name in batch.schema.names}
            for name in sums:
                values = batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
                total = np.concatenate([[0], np.bitwise_xor.accumulate(values)])
                running = total[1:] ^ np.where(start < 0, before[name], total[np.maximum(start, 0)])
                before[name] = int(running[-1])
                out[f"{name}_upto"] = pa.array(running, pa.int64())
            held, last = int(nth[-1]) + 1, [batch.column(g)[n - 1].as_py() for g in group]
            yield pa.record_batch({
                **out, "part": pa.array(np.full(n, part, np.int32)), "nth": pa.array(nth.astype(np.int64))})

    return work


def placed(rows: DataFrame, group: list[str], by: list[str], name: str, xors: tuple[str, ...] = ()) -> DataFrame:
    """The rows with `at`, their place from 0 within the group in the order `by`.

    For each long column of `xors`, `<column>_upto` is the exclusive-or of its values in the
    group up to and with the row. Group columns and `xors` have no nulls. Rows that tie in
    `by` follow each other as they were read. The table is written to the shared folder.
    """
    order = [*group, *by]
    spread = (
        rows.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*order, "tie").sortWithinPartitions(*order, "tie").drop("tie"))
    more = "".join(f", {x}_upto bigint" for x in xors)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    numbered = kept(
        in_arrow(spread, _numbering(group, list(xors)), f"{schema}{more}, part int, nth bigint"), name)
    # the groups at the edges of partitions, and what each partition holds of them
    ends = numbered.groupBy("part").agg(
        F.min(F.struct(*group)).alias("low"), F.max(F.struct(*group)).alias("high"))
    edges = ends.select("part", F.explode(F.array_distinct(F.array("low", "high"))).alias("edge")).select(
        "part", *[F.col(f"edge.{g}").alias(g) for g in group])
    shares = numbered.join(edges, ["part", *group], "left_semi").groupBy("part", *group).agg(
        F.count("*").alias("n"), *[F.bit_xor(x).alias(x) for x in xors])
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = kept(shares.select(
        "part", *group, F.sum("n").over(earlier).alias("n_before"),
        *[F.bit_xor(x).over(earlier).alias(f"{x}_before") for x in xors]).where("n_before is not null"), "shifts")
    at = F.col("nth") + F.coalesce("n_before", F.lit(0))
    return numbered.join(shifts, ["part", *group], "left").select(
        *rows.columns, at.alias("at"),
        *[F.col(f"{x}_upto").bitwiseXOR(F.coalesce(f"{x}_before", F.lit(0).cast("long"))).alias(f"{x}_upto") for x in xors])
