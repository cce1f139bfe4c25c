"""Keyed results of an update-mode stream (SS3): only rows that changed are
written, readers take each key's newest row.

A batch writes the changed rows to its own folder, dealt out by a hash bucket of
the key. Now and then the buckets that changed are merged: their newest rows go
to a new version of the base, untouched buckets stay as they are. The newest row
of a key wins wherever it lies, so a replayed batch, or a merge broken off before
the files it replaces are deleted, changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.streaming.runs import finished, run_batches

BUCKET, VERSION = "_bucket", "_version"


def _delete(spark: SparkSession, path: str) -> None:
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    top.getFileSystem(spark._jsc.hadoopConfiguration()).delete(top, True)


def write_changes(batch: DataFrame, batch_id: int, root: str, key: Sequence[str], buckets: int) -> None:
    """The changed rows of a batch; a replayed batch replaces its folder."""
    dealt = batch.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    dealt.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{root}/changes/{VERSION}={batch_id}")


def _all_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Base and changes with the version of each row: a base version stands for
    the batches up to it, so it comes after the changes of that batch."""
    full = T.StructType([*schema, T.StructField(BUCKET, T.IntegerType()), T.StructField(VERSION, T.LongType())])
    parts = []
    for place, number in (("base", F.col(VERSION) * 2 + 1), ("changes", F.col(VERSION) * 2)):
        done = [f"{root}/{place}/{VERSION}={n}" for n in finished(spark, f"{root}/{place}", VERSION)]
        if done:
            parts.append(spark.read.schema(full).option("basePath", f"{root}/{place}").parquet(*done).withColumn(VERSION, number))
    if not parts:
        return spark.createDataFrame([], full)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _newest(rows: DataFrame, key: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """Each key's newest row; combines map-side, one row a key is shuffled a task."""
    rest = [c for c in carried if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(VERSION)).alias("_row"))
    return best.select(*[F.col("_row")[c].alias(c) if c in rest else F.col(c) for c in carried])


def current(spark: SparkSession, root: str, key: Sequence[str], schema: T.StructType) -> DataFrame:
    """The newest row of every key."""
    return _newest(_all_rows(spark, root, schema), key, schema.names)


def merge(spark: SparkSession, root: str, key: Sequence[str], schema: T.StructType) -> list[int]:
    """Merges all changes into the base. Only buckets that changed are read and
    rewritten; returns their numbers. Changes and base files that the new version
    replaces are deleted last."""
    batches = finished(spark, f"{root}/changes", VERSION)
    if not batches:
        return []
    version = batches[-1]
    rows = _all_rows(spark, root, schema)
    changed = spark.read.schema(T.StructType([T.StructField(BUCKET, T.IntegerType()), T.StructField(VERSION, T.LongType())])).parquet(f"{root}/changes")
    touched = sorted(r[BUCKET] for r in changed.select(BUCKET).distinct().collect())      # at most the number of buckets
    if touched:
        newest = _newest(rows.where(F.col(BUCKET).isin(touched)), key, [*schema.names, BUCKET])
        newest.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{root}/base/{VERSION}={version}")
        for old in finished(spark, f"{root}/base", VERSION):
            if old < version:
                for bucket in touched:
                    _delete(spark, f"{root}/base/{VERSION}={old}/{BUCKET}={bucket}")
    for n in batches:
        _delete(spark, f"{root}/changes/{VERSION}={n}")
    return touched


def run_upserts(df: DataFrame, root: str, checkpoint: str, key: Sequence[str], buckets: int = 16, merge_every: int = 20) -> list[dict]:
    """Runs an update-mode stream into the keyed table at ``root``."""
    schema = df.schema

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_changes(batch, batch_id, root, key, buckets)
        if merge_every and batch_id % merge_every == merge_every - 1:
            merge(batch.sparkSession, root, key, schema)
    return run_batches(df, sink, checkpoint, mode="update")
