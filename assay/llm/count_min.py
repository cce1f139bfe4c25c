"""Count-min sketches merged by Spark: which keys may occur more than once.

Every key falls into one cell of each of ``DEPTH`` rows. Partitions count their
cells, a shuffle adds the counts up, and a key's estimate, the least count of its
cells, is never below its true count. What a second pass has to know is only
whether the estimate exceeds one, so the merged sketch travels as one bit a cell.

The bits are the only thing sent to the driver and broadcast. ``MOST_CELLS``
bounds them: ``DEPTH * MOST_CELLS / 8`` bytes, 128 MiB at any input size. Beyond
about a billion keys the sketch screens less and less; results stay the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.common import ready

DEPTH = 2
#: Cells of a row: at least, and at most.
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 29
SLAB = 4096             # words of 64 cells handed to the driver in one row


def cells_for(keys: int) -> int:
    """Cells of a row: eight a key, a power of two within the bounds."""
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << (max(1, 8 * keys) - 1).bit_length()))


def cell(row: int, width: int, *key: str) -> Column:
    """The cell of a key given by long columns, numbered through all rows."""
    return F.lit(row * width) + F.xxhash64(F.lit(101 + row), *key).bitwiseAND(F.lit(width - 1))


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, bits) rows of whole slabs -> (slab, bits of all its words)."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        word, bits = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for slab in np.unique(word // SLAB).tolist():
            own = word // SLAB == slab
            held.setdefault(slab, np.zeros(SLAB, np.int64))[word[own] % SLAB] = bits[own]
    for slab, bits in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int64()), pa.array([bits.tobytes()], pa.binary())], names=["slab", "bits"])


def repeated_cells(cells: DataFrame, width: int) -> np.ndarray:
    """One bit for each cell of the merged sketch, set where the count exceeds
    one. ``cells`` has a row (cell: long) for every key that was met."""
    ready(cells.sparkSession)
    words = (cells.groupBy("cell").count().where("count > 1")
             .select(F.shiftright("cell", 6).alias("word"),
                     F.expr("shiftleft(1L, cast(cell & 63 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")))
    rows = words.repartition(F.expr(f"word div {SLAB}")).mapInArrow(_slabs, "slab long, bits binary").collect()
    out = np.zeros(-(-DEPTH * width // 64 // SLAB) * SLAB, np.int64)
    for r in rows:
        out[r.slab * SLAB:(r.slab + 1) * SLAB] = np.frombuffer(r.bits, np.int64)
    return out.view(np.uint64)


def is_set(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """For every cell whether its bit is set."""
    return (bits[cells >> 6] >> (cells & 63).astype(np.uint64)) & np.uint64(1) == 1
