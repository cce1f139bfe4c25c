"""Delimited-file sources with lineage (IO1-IO6).

The reference's sources are folders of ';'-separated files with a header,
read as all-string columns (no type inference: typing is the silver layer's
job). Files are split and read by the executors; the driver only lists them.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from assay.session import small_files
from assay.sources.layers import drop_layer

SOURCE_FILE = "_source_file"
SOURCE_NAME = "_source_name"
INGESTED_AT = "_ingested_at"
BLOCK_START = "_block_start"
ROW_ID = "_row_id"
# arrival order of a row in its source: file, split offset, position in the split
ARRIVAL = [SOURCE_FILE, BLOCK_START, ROW_ID]


def all_string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_delimited(spark: SparkSession, path: str | Sequence[str],
                   columns: Sequence[str] | None = None, sep: str = ";",
                   header: bool = True, recursive: bool = False,
                   lineage: bool = True, encoding: str = "UTF-8",
                   files: str | None = "*.csv", malformed: str | None = None) -> DataFrame:
    """Read a folder / glob of delimited files as all-string columns.

    Only files named like ``files`` are read (``None``: all). With ``columns``
    the schema is fixed and a file whose header names other columns, or the
    same ones in another order, is an error; without it the header names the
    columns and every column is a string. A line with too few or too many values
    is padded or cut; with ``malformed`` its whole text is kept in a column of that
    name (NULL for a well-formed line).
    Lineage: ``_source_file`` (full path, from the hidden ``_metadata``
    column, which -- unlike ``input_file_name()`` -- also works in streaming),
    ``_source_name`` (file name) and ``_ingested_at``.
    """
    reader = (spark.read.option("header", header).option("sep", sep)
              .option("encoding", encoding).option("mode", "PERMISSIVE")
              .option("inferSchema", False)
              # raw text: blanks are the silver layer's business (trim)
              .option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False))
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if columns is not None:
        fields = [*columns, malformed] if malformed else columns
        reader = reader.schema(all_string_schema(fields)).option("enforceSchema", False)
        if malformed:
            reader = reader.option("columnNameOfCorruptRecord", malformed)
    df = reader.csv(path if isinstance(path, str) else list(path))
    return with_lineage(df) if lineage else df


def write_folders(df: DataFrame, path: str, folder: str, sep: str = ";") -> str:
    """Text columns of ``df`` as delimited files with header, a folder
    ``<folder>=<value>`` for every value of the column ``folder``; overwrites
    ``path``. The rows of ``df`` are written as they lie: sorted by ``folder``
    inside its partitions, a partition gives a folder one file.

    A unit of a few dozen rows is a file, so the price of a file is the price of
    the write. Hadoop's local file system starts two ``chmod`` processes a file, so
    on a local (or locally mounted) ``path`` the tasks write the lines themselves,
    under names that a repeated task finds again. Elsewhere Spark's writer does it."""
    spark = df.sparkSession
    text = {"sep": sep, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() != "file":
        df.write.mode("overwrite").partitionBy(folder).option("header", True).options(**text).csv(path)
        return path
    columns = [c for c in df.columns if c != folder]
    top, head, load = where.toUri().getPath(), sep.join(columns), str(uuid.uuid4())
    # the folder of a null, as Spark names it
    value = F.coalesce(F.nullif(F.col(folder), F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__"))
    lines = df.select(F.concat(F.lit(f"{folder}="), value).alias("folder"),
                      F.to_csv(F.struct(*columns), {k: str(v).lower() for k, v in text.items()}).alias("line"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"part-{TaskContext.get().partitionId():05d}-{load}.csv"
        rows = ((f, t) for b in batches for f, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        files = 0
        for place, group in groupby(rows, key=lambda r: r[0]):
            os.makedirs(f"{top}/{place}", exist_ok=True)
            with open(f"{top}/{place}/{name}", "w", encoding="utf-8", newline="") as out:
                out.write(f"{head}\n")
                out.writelines(f"{t}\n" for _, t in group)
            files += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    drop_layer(spark, path)
    os.makedirs(top)
    lines.mapInArrow(put, "files long").agg(F.sum("files")).collect()      # one row
    return path


def header_of(spark: SparkSession, file: str, sep: str = ";", encoding: str = "UTF-8") -> list[str]:
    """Column names in a file's header line."""
    return spark.read.option("header", True).option("sep", sep).option("encoding", encoding).csv(file).columns


def with_lineage(df: DataFrame, arrival: bool = True) -> DataFrame:
    """Source file, file name, ingestion time and (batch only) the arrival
    order: the split's start offset plus ``monotonically_increasing_id``,
    which grows in read order inside a split. Re-reading the same files gives
    the same splits, so the order is stable; bronze persists it."""
    out = (df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
             .withColumn(SOURCE_NAME, F.col("_metadata.file_name"))
             .withColumn(INGESTED_AT, F.current_timestamp()))
    if arrival and not df.isStreaming:
        out = (out.withColumn(BLOCK_START, F.col("_metadata.file_block_start"))
                  .withColumn(ROW_ID, F.monotonically_increasing_id()))
    return out


def read_delimited_stream(spark: SparkSession, path: str, columns: Sequence[str],
                          sep: str = ";", header: bool = True,
                          max_files_per_trigger: int | None = None,
                          files: str | None = "*.csv") -> DataFrame:
    """Streaming twin of ``read_delimited`` (file source; new files only)."""
    r = (spark.readStream.option("header", header).option("sep", sep).option("enforceSchema", False)
         .option("recursiveFileLookup", True).schema(all_string_schema(columns)))
    if files:
        r = r.option("pathGlobFilter", files)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    with small_files(spark):
        return with_lineage(r.csv(path))
