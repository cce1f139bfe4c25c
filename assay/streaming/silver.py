"""Continuous silver (SS2): text rows of a stream -> typed readings, with the
rows of files that carry no serial set apart.

The transforms are the batch ones (serial from the path, date and time parsing,
``try_cast``), applied to every micro-batch. A batch is parsed once: one write,
partitioned by the quarantine flag, fills both layers, and its counts (rows,
quarantined rows, values that did not parse) are observed in the same job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay import constants as K
from assay.functions.scalar import parse_timestamp, serial_from_path, to_double
from assay.operators.clean import clean_measurements
from assay.sources.delimited import SOURCE_FILE
from assay.streaming.runs import BATCH_ID, read_batches, run_batches, write_batch

QUARANTINED = "_quarantined"


def silver_schema(sensors: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(K.SERIAL, T.StringType()), T.StructField(K.TS, T.TimestampType()),
                         T.StructField(K.PHASE, T.StringType()), *[T.StructField(s, T.DoubleType()) for s in sensors]])


def write_silver_batch(batch: DataFrame, batch_id: int, root: str, sensors: Sequence[str], scope: str = "name") -> None:
    """One micro-batch of raw text rows into both layers."""
    clean = clean_measurements(batch, sensors=sensors, scope=scope)
    write_batch(clean.withColumn(QUARANTINED, F.when(F.col(K.SERIAL).isNull(), F.lit(1)).otherwise(F.lit(0))),
                batch_id, root, partition_by=[QUARANTINED])


def silver_counts(sensors: Sequence[str], scope: str = "name") -> list:
    """Aggregates over raw rows: rows, rows without a serial, and for the time and
    every sensor the texts that do not parse."""
    lost = {"bad_time": F.coalesce(F.col(K.DATE), F.col(K.TIME)).isNotNull() & parse_timestamp(K.DATE, K.TIME).isNull(),
            **{f"bad_{s}": F.col(s).isNotNull() & to_double(s).isNull() for s in sensors}}
    return [F.count(F.lit(1)).alias("rows"), F.count_if(serial_from_path(SOURCE_FILE, scope).isNull()).alias("quarantined"),
            *[F.count_if(c).alias(n) for n, c in lost.items()]]


def run_silver(raw: DataFrame, root: str, checkpoint: str, sensors: Sequence[str] = K.SENSORS, scope: str = "name") -> list[dict]:
    """Runs the silver stream over everything available now. ``raw``: a stream of
    text rows with lineage (files, bus records, or the bronze folder). The counts
    are in each batch's ``observed["silver"]``."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        write_silver_batch(batch, batch_id, root, sensors, scope)
    return run_batches(raw.observe("silver", *silver_counts(sensors, scope)), sink, checkpoint)


def read_silver(spark: SparkSession, root: str, sensors: Sequence[str] = K.SENSORS) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) of all finished batches; the flag is a
    partition, so each side reads its own files only."""
    schema = T.StructType([*silver_schema(sensors), T.StructField(QUARANTINED, T.IntegerType())])
    rows = read_batches(spark, root, schema)
    good, bad = (rows.where(F.col(QUARANTINED) == n).drop(QUARANTINED, BATCH_ID) for n in (0, 1))
    return good, bad
