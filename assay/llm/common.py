"""Helpers shared by the operators: words, row identity, running totals over
hash-ordered chunks, written intermediate tables, single evaluation of a
sub-expression inside a row."""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assay.session import scratch_path

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_RUN = "[ \\t-\\r]+"
#: Spark's setting that removes a finished execution's shuffle files.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder: lineage is cut
    there, so a lost executor never re-runs what came before. The shuffle files
    behind it are no longer needed and go at once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``written`` that nothing reads any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row: a lambda variable
    holds it, where a plain column reference could be inlined and re-evaluated
    for every element of an inner lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hex_fraction(hex_text: Column, parts: int) -> Column:
    """The first 8 hex digits read as a fraction of 1, scaled to 0..parts-1."""
    head = F.conv(F.substring(hex_text, 1, 8), 16, 10).cast("long")
    return F.shiftright(head * F.lit(int(parts)), 32).cast("long")


def running(df: DataFrame, group: list[str], key: str, ties: list[str], measure: str,
            before: str, rows: int) -> DataFrame:
    """Adds ``before``: the sum of ``measure`` over the rows of the same group
    that precede a row in the order (key, ties); ``key`` is an md5 hex text.

    No group is handled whole: the key space is cut into ceil(sqrt(rows))
    chunks of equal width, chunk totals are summed up per group (a table of at
    most sqrt(rows) rows a group) and running sums are taken per chunk.
    """
    chunks = max(1, math.isqrt(max(0, rows - 1)) + 1)
    cut = df.withColumn("_chunk", hex_fraction(F.col(key), chunks))
    totals = cut.groupBy(*group, "_chunk").agg(F.sum(measure).alias("_chunk_sum"))
    ahead = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(g).alias(f"_o_{g}") for g in group], F.col("_chunk").alias("_o_chunk"),
                            F.coalesce(F.sum("_chunk_sum").over(ahead), F.lit(0)).alias("_offset"))
    match = F.col("_chunk") == F.col("_o_chunk")
    for g in group:
        match = match & (F.col(g) == F.col(f"_o_{g}"))
    inside = (Window.partitionBy(*group, "_chunk").orderBy(key, *ties)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (cut.join(offsets, match)
            .withColumn(before, F.col("_offset") + F.coalesce(F.sum(measure).over(inside), F.lit(0)))
            .drop("_chunk", "_offset", "_o_chunk", *[f"_o_{g}" for g in group]))


def least_hashed(df: DataFrame, rows: int, count: int, *key: str | Column) -> DataFrame:
    """The ``rows`` rows of ``df`` (``count`` rows) whose key has the least hash.
    Rows far above the place where the last one lies are left out first, so that
    all tasks together hand on about twice the number wanted, at any size."""
    h = F.xxhash64(*key)
    if count > 4 * rows:
        df = df.where(h < F.lit(int(-(1 << 63) + (1 << 64) * (2 * rows / count))))
    return df.orderBy(h, *[k for k in key if isinstance(k, str)]).limit(rows)


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Groups row tuples into record batches of ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def ready(spark: SparkSession, rows: int = 512) -> None:
    """Before Python runs in tasks: workers look for this package where the
    driver found it (on a cluster without shared folders, pass it with
    ``--py-files``), and Arrow batches hold at most ``rows`` whole texts."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
