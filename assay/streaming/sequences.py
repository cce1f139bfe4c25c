"""Finished sequences of a stream (SS4), in the two ways a sequence can end.

Files: a test bench writes one file per test, and a file is read whole by one
micro-batch. Its features are complete within the batch; no state is kept.

Bus: a unit's sequence ends when nothing arrives for a gap. Append mode emits a
sequence once, when the watermark has passed its end, and drops its state, so
the state holds open sequences only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay import constants as K
from assay.operators.clean import clean_measurements
from assay.operators.features import sequence_features
from assay.sources.delimited import SOURCE_FILE
from assay.streaming.continuous import completed_sequences
from assay.streaming.runs import read_batches, run_batches, write_batch


def file_features(rows: DataFrame, sensors: Sequence[str], scope: str = "name") -> DataFrame:
    """Features of every test file among raw text rows, one row a (serial, file).
    Files without a serial give none; the silver stream sets their rows apart."""
    clean = clean_measurements(rows, sensors=sensors, scope=scope, keep_arrival=True)
    return sequence_features(clean.where(F.col(K.SERIAL).isNotNull()), sensors=sensors, by=[F.col(SOURCE_FILE)])


def run_file_sequences(raw: DataFrame, root: str, checkpoint: str, sensors: Sequence[str], scope: str = "name") -> list[dict]:
    """One row per test file, written with the batch that read the file."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(file_features(batch, sensors, scope), batch_id, root)
    return run_batches(raw, sink, checkpoint)


def run_bus_sequences(series: DataFrame, root: str, checkpoint: str, sensors: Sequence[str],
                      gap: str = "30 minutes", watermark: str | None = None) -> list[dict]:
    """One row per finished sequence of the typed readings ``series``."""
    closed = completed_sequences(series, sensors, gap=gap, watermark=watermark)

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, root)
    return run_batches(closed, sink, checkpoint, mode="append")


def sequence_schema(sensors: Sequence[str], ends: str = "file", serial: T.DataType | None = None) -> T.StructType:
    """Columns of finished sequences: ``ends`` is "file" or "gap"."""
    tell = ([T.StructField(SOURCE_FILE, T.StringType())] if ends == "file"
            else [T.StructField(c, T.TimestampType()) for c in ("session_start", "session_end")])
    return T.StructType([T.StructField(K.SERIAL, serial or T.StringType()), *tell,
                         *[T.StructField(f"{s}_{st}", T.DoubleType()) for s in sensors for st in K.STATS],
                         *[T.StructField(c, T.LongType()) for c in K.LEAK_COLUMNS]])


def read_sequences(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All finished sequences with the number of the batch that finished them."""
    return read_batches(spark, root, schema)
