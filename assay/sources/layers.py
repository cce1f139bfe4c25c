"""Layer sinks and scans (IO7-IO13).

Layers are whole-table overwrites, written by the executors in parallel;
nothing is pulled to the driver (the reference's flat export goes through
``toPandas``; here it is two distributed writes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, **options) -> str:
    w = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """A layer table, or None where its folder is absent. Any other fault (an
    unreadable folder, a broken file) is raised."""
    try:
        return read_layer(spark, path, fmt)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def drop_layer(spark: SparkSession, path: str) -> None:
    """Removes a layer table whose source is gone, so that no later step takes it
    for a current one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def export_dataset(df: DataFrame, path: str, sep: str = ",") -> dict[str, str]:
    """IO12: flat dataset as parquet (fast path) and CSV with header (fallback)."""
    pq = write_layer(df, f"{path}/parquet")
    csv = write_layer(df, f"{path}/csv", fmt="csv", header=True, sep=sep)
    return {"parquet": pq, "csv": csv}


def save_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
               path: str | None = None) -> str:
    """IO13: managed (or, with ``path``, external) table in the catalog.
    The reference writes Delta; any installed table format can be named."""
    w = df.write.format(fmt).mode(mode)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int,
                  fmt: str = "parquet", mode: str = "overwrite") -> str:
    """A catalog table hash-bucketed and sorted on ``key``: later joins and
    aggregations on ``key`` between tables with the same bucket count read
    co-located buckets and skip the shuffle (and the sort, for merge joins).
    Pick ``buckets`` so a bucket file is 128 MB - 1 GB at the target scale."""
    (df.write.format(fmt).mode(mode).bucketBy(buckets, key).sortBy(key)
     .saveAsTable(name))
    return name
