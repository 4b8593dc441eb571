"""Count-min sketches merged from sketches of partitions, as bitmaps of cells seen often enough.

Each task counts its keys per cell, saturated at two, and hands on its cells block by
block; the blocks are added up in Spark. What reaches the driver and the tasks is one
bit a cell: at most ROWS * 2**MAX_BITS / 8 bytes (64 MB), whatever the input. Once
the cells are crowded more keys pass; none that occurs often enough ever fails.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gazette.llm.common import grouped, mix, shuffles_deleted

ROWS = 2
MIN_BITS, MAX_BITS = 20, 28
_BLOCK_BITS = 16
_COUNTED = 1 << 18
_ODD = [np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)]

PARTS = "sketch_row int, sketch_block int, sketch_cells binary"


def bits_for(keys: int) -> int:
    """Cells for about eight times the keys, within the bounds."""
    return int(min(MAX_BITS, max(MIN_BITS, (8 * max(1, keys)).bit_length())))


def _cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(keys * _ODD[row]) >> np.uint64(64 - bits)).astype(np.uint32)


def parts(keys: Iterable[np.ndarray], bits: int, flush: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The sketch of a task's keys as rows of PARTS, handed on every `flush` keys."""
    held, n = [], 0

    def out():
        every = np.concatenate(held)
        for row in range(ROWS):
            cells = np.sort(_cells(every, row, bits))
            # a third and further occurrence in a cell adds nothing
            cells = cells[np.r_[True, True, cells[2:] != cells[:-2]]] if len(cells) > 2 else cells
            block = cells >> np.uint32(_BLOCK_BITS)
            starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            low = (cells & np.uint32((1 << _BLOCK_BITS) - 1)).astype("<u2")
            yield pa.record_batch({
                "sketch_row": pa.array(np.full(len(starts), row, np.int32)),
                "sketch_block": pa.array(block[starts].astype(np.int32)),
                "sketch_cells": pa.array(
                    [low[a:b].tobytes() for a, b in zip(starts, np.r_[starts[1:], len(low)])], pa.binary()),
            })

    for some in keys:
        if len(some):
            held.append(some)
            n += len(some)
        if n >= flush:
            yield from out()
            held, n = [], 0
    if n:
        yield from out()


def _merged(at_least: int):
    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, n = np.zeros(1 << _BLOCK_BITS, np.uint8), [], 0

        def added() -> np.ndarray:
            counts = np.bincount(np.concatenate(held), minlength=1 << _BLOCK_BITS)
            return np.minimum(seen + counts, 2).astype(np.uint8)

        for batch in batches:
            for cells in batch.column("sketch_cells"):
                held.append(np.frombuffer(cells.as_py(), "<u2"))
                n += len(held[-1])
                # many short parts are counted at a time
                if n >= _COUNTED:
                    seen, held, n = added(), [], 0
        if held:
            seen = added()
        yield pa.record_batch({
            "sketch_row": pa.array([key[0].as_py()], pa.int32()),
            "sketch_block": pa.array([key[1].as_py()], pa.int32()),
            "sketch_cells": pa.array([np.packbits(seen >= at_least).tobytes()], pa.binary()),
        })

    return merge


class Seen:
    """Which keys may occur often enough; travels to the tasks as a broadcast."""

    def __init__(self, spark: SparkSession, merged_parts: DataFrame, at_least: int, bits: int):
        bitmaps = np.zeros((ROWS, 1 << max(bits, _BLOCK_BITS) - 3), np.uint8)
        size = 1 << (_BLOCK_BITS - 3)
        # one job; the blocks are at most the bitmap's size
        with shuffles_deleted(spark):
            rows = grouped(merged_parts, ["sketch_row", "sketch_block"], _merged(at_least), PARTS).collect()
        for row in rows:
            at = row.sketch_block * size
            bitmaps[row.sketch_row, at:at + size] = np.frombuffer(bytes(row.sketch_cells), np.uint8)
        self.bits = bits
        self.shared = spark.sparkContext.broadcast(bitmaps)

    def test(self, keys: np.ndarray) -> np.ndarray:
        """True where a key may occur often enough; never false for one that does."""
        bitmaps, passed = self.shared.value, np.ones(len(keys), bool)
        for row in range(ROWS):
            cells = _cells(keys, row, self.bits)
            passed &= (bitmaps[row][cells >> np.uint32(3)] >> (7 - (cells & np.uint32(7))).astype(np.uint8)) & 1 == 1
        return passed
