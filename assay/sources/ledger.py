"""File ledger of the bronze layer (IO1-IO7): which source files were read.

A row per file and load: path, size, modification time, header, rows and
malformed rows. The ledger decides which files a later load reads, so day two
opens new and changed files only. A file that changed after its load is read
again as a whole; the rows of its newest load count.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator, Sequence
from fnmatch import fnmatchcase
from itertools import chain, islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.session import scratch_path
from assay.sources.delimited import SOURCE_FILE
from assay.sources.layers import read_layer, read_optional, write_layer

SIZE, MODIFIED, LOADED = "_size", "_modified", "_ingest_date"
MALFORMED = "_malformed_line"
GROUP = 10_000      # files that are listed, planned and read at a time


def list_files(spark: SparkSession, path: str, files: str = "*.csv") -> DataFrame | None:
    """(path, _source_file, _size, _modified) of a folder's files, or None where
    there are none. Only the listing is read, no content.

    Spark lists on the driver and holds every file's status there, about a kilobyte
    each. A local folder of more than ``GROUP`` files is walked instead and listed a
    group at a time into a scratch table, so that the driver never holds them all."""
    local = local_folder(spark, path)
    groups = in_groups(walked(local, files), GROUP) if local else iter(())
    head = list(islice(groups, 2))
    if len(head) < 2:
        found = _listed(spark, path, files)
        return None if found is None or found.isEmpty() else found
    out = scratch_path(spark, "listing")
    for group in chain(head, groups):
        write_layer(_listed(spark, group, files), out, mode="append")
    return read_layer(spark, out)


def _listed(spark: SparkSession, path: str | list[str], files: str) -> DataFrame | None:
    try:
        return (spark.read.format("binaryFile").option("pathGlobFilter", files).option("recursiveFileLookup", True).load(path)
                .select("path", F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_size").alias(SIZE),
                        F.col("_metadata.file_modification_time").alias(MODIFIED)))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder's name on the driver's file system; None where ``path`` lies
    elsewhere or is no folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() != "file":
        return None
    name = where.toUri().getPath()
    return name if os.path.isdir(name) else None


def walked(folder: str, files: str) -> Iterator[str]:
    """The files named like ``files`` below a local folder. Names that Spark passes
    over, and what lies in such folders, are left out."""
    def hidden(name: str) -> bool:
        return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")
    for top, below, names in os.walk(folder, followlinks=True):
        below[:] = sorted(b for b in below if not hidden(b))
        yield from (f"file:{top}/{n}" for n in sorted(names) if not hidden(n) and fnmatchcase(n, files))


def in_groups(items: Iterable[str], size: int) -> Iterator[list[str]]:
    rest = iter(items)
    while group := list(islice(rest, size)):
        yield group


def file_groups(listed: DataFrame) -> Iterator[list[str]]:
    """The paths of the listed files in their order, up to ``GROUP`` at a time: a
    reader is given its files' names, and the driver plans what it is given."""
    return in_groups((r["path"] for r in listed.select("path").orderBy("path").toLocalIterator()), GROUP)


def unread(listed: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """The listed files that no load before today has read as they are now. An
    entry without a size stands for the file in any form."""
    if ledger is None:
        return listed
    earlier = ledger.where(F.col(LOADED) < F.current_date()).select(
        F.col(SOURCE_FILE).alias("_file"), F.col(SIZE).alias("_old_size"), F.col(MODIFIED).alias("_old_modified")).distinct()
    same = (F.col("_old_size") == F.col(SIZE)) & (F.col("_old_modified") == F.col(MODIFIED))
    return listed.join(earlier, (F.col(SOURCE_FILE) == F.col("_file")) & (F.col("_old_size").isNull() | same), "left_anti")


def entries_of_table(rows: DataFrame) -> DataFrame:
    """Ledger rows for a dated table written before there was a ledger."""
    return rows.groupBy(SOURCE_FILE, LOADED).agg(F.count(F.lit(1)).alias("rows")).select(
        SOURCE_FILE, F.lit(None).cast("long").alias(SIZE), F.lit(None).cast("timestamp").alias(MODIFIED),
        F.lit(None).cast("string").alias("header"), "rows", F.lit(0).cast("long").alias("malformed"), LOADED)


def entries(listed: DataFrame, rows: DataFrame, header: Sequence[str], sep: str) -> DataFrame:
    """Ledger rows of one load. ``rows``: the loaded rows as written; only the
    file name and the malformed mark are read. Files without a row are entered too."""
    counted = rows.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("rows"), F.count(MALFORMED).alias("malformed"))
    return listed.join(counted, SOURCE_FILE, "left").select(
        SOURCE_FILE, SIZE, MODIFIED, F.lit(sep.join(header)).alias("header"), F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("malformed", F.lit(0)).alias("malformed"), F.current_date().alias(LOADED))


def newest_loads(rows: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """``rows`` of a dated bronze table without those of files that were loaded
    again later."""
    if ledger is None:
        return rows
    loads = ledger.groupBy(SOURCE_FILE).agg(F.max(LOADED).alias("_last"), F.count_distinct(LOADED).alias("_loads")).where("_loads > 1")
    if loads.isEmpty():
        return rows
    again = loads.select(F.col(SOURCE_FILE).alias("_file"), "_last")
    return rows.join(again, (F.col(SOURCE_FILE) == F.col("_file")) & (F.col(LOADED) < F.col("_last")), "left_anti")


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    return read_optional(spark, path)
