"""End-to-end layer jobs: sources -> bronze -> silver -> gold.

``bronze``, ``silver`` and ``gold`` each read the previous layer from storage
and overwrite theirs, as the reference's three scripts do; counts come back
as one small DataFrame per layer (bronze: from the file ledger).

``write_sources`` is test-data binding D: it writes the events / orders
tables as the reference's source folders (';' CSV with header, one folder per
time-series file whose name carries a 32-hex serial).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay import constants as K
from assay.operators import audit as AU
from assay.operators import clean as CL
from assay.operators import features as FE
from assay.operators import label as LB
from assay.operators import star as ST
from assay.plans import bindings as B
from assay.session import scratch_path, small_files
from assay.sources import ledger as LD
from assay.sources.delimited import SOURCE_FILE, header_of, read_delimited, write_folders
from assay.sources.layers import (drop_layer, export_dataset, read_layer, read_optional, save_bucketed,
                                  save_table, write_layer)

# --- fixed values: binding D layout ------------------------------------------
TS_COLUMNS_D = [K.DATE, K.TIME, K.PHASE, "VALUE", "K"]
RESULT_COLUMNS_D = [K.SERIAL, K.RESULT, K.STAND, "TEST_DATE", "TEST_ID"]
SENSORS_D = ["VALUE", "K"]
# --- end of fixed values ----------------------------------------------------
QUARANTINED = "_quarantined"
PARTS = {"timeseries_clean": f"timeseries/{QUARANTINED}=0", "timeseries_quarantine": f"timeseries/{QUARANTINED}=1"}


@dataclass
class Lake:
    root: str

    def path(self, layer: str, table: str) -> str:
        """Folder of a layer's table. The clean series and its quarantine are the
        two partitions of one table."""
        return f"{self.root}/{layer}/{PARTS.get(table, table)}"


# ------------------------------------------------------------ binding D
def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events in the source shape: DATE, HEURE, PHASE and sensors as text,
    plus the per-test folder name carrying the serial."""
    ev = B.table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("TimeSeries_"), F.md5(F.col("user_id").cast("string"))).alias("_test"),
        F.date_format("ts", "dd/MM/yyyy").alias(K.DATE),
        F.date_format("ts", "HH:mm:ss").alias(K.TIME),
        F.col("event_type").alias(K.PHASE),
        F.col("value").cast("string").alias("VALUE"),
        F.get_json_object("props", "$.k").alias("K"))


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source_events`` with the faults that test benches make: files without a
    serial, impossible or missing dates, decimal commas, text for numbers."""
    ev = B.table(spark, sf_dir, "events")
    every = lambda n: F.col("event_id") % n == 0
    value = F.col("value").cast("string")
    return ev.select(
        F.when(F.col("event_type") == "error", F.lit("TimeSeries_unknown"))
        .otherwise(F.concat(F.lit("TimeSeries_"), F.md5(F.col("user_id").cast("string")))).alias("_test"),
        F.when(every(13), F.lit("31/02/2024")).when(~every(17), F.date_format("ts", "dd/MM/yyyy")).alias(K.DATE),
        F.date_format("ts", "HH:mm:ss").alias(K.TIME),
        F.col("event_type").alias(K.PHASE),
        F.when(every(7), F.regexp_replace(value, r"\.", ",")).otherwise(value).alias("VALUE"),
        F.when(every(11), F.lit("n/a")).otherwise(F.get_json_object("props", "$.k")).alias("K"))


def write_test_files(events: DataFrame, path: str) -> str:
    """One file per test: all rows of a folder are written by one task, in time
    order (``events`` as from ``source_events``, a test per folder)."""
    n = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return write_folders(events.repartition(n, "_test").sortWithinPartitions("_test", K.DATE, K.TIME), path, "_test")


def source_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a results source file. Orders in status 'P' carry the
    verdict as badly typed text (' W', 'g'): the label rule keeps them 0 and
    the unknown-verdict audit must report them."""
    o = B.table(spark, sf_dir, "orders")
    odd = F.col("o_orderstatus") == F.lit("P")
    w = F.when(odd, F.lit(" " + K.ANOMALY_VERDICT)).otherwise(F.lit(K.ANOMALY_VERDICT))
    g = F.when(odd, F.lit(K.GOOD_VERDICT.lower())).otherwise(F.lit(K.GOOD_VERDICT))
    # the serial is the unit's 32-hex id (as in the time-series file names),
    # padded with blanks on every 5th test: trimming must make them join
    hexid = F.md5(F.col("o_custkey").cast("string"))
    serial = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit(" "), hexid, F.lit(" "))) \
        .otherwise(hexid)
    return o.select(
        serial.alias(K.SERIAL),
        F.when(F.col("o_totalprice") >= F.lit(B.W_PRICE), w).otherwise(g).alias(K.RESULT),
        F.col("o_orderpriority").alias(K.STAND),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("TEST_DATE"),
        F.col("o_orderkey").cast("string").alias("TEST_ID"))


def write_sources(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """Write binding D's source folders under ``root`` (a fresh folder)."""
    return {"timeseries": write_time_series(spark, sf_dir, root), "results": write_results(spark, sf_dir, root)}


def write_time_series(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Time series: one folder per unit, the serial in the folder name. The
    rows are range-partitioned on (folder, time, date) first: each task holds
    a contiguous run of units, so a folder gets few files, and a unit with a
    third of all rows is spread over many tasks instead of one (a hash
    repartition on the folder would give it one)."""
    ev = source_events(spark, sf_dir)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # arrival order inside a unit's files: HEURE text, then DATE text (a
    # deliberately scrambled order, so the files carry genuine time
    # inversions); range partitions and in-file sort use the same keys, so the
    # order across a unit's files is the same global order
    rows = ev.repartitionByRange(n, "_test", K.TIME, K.DATE).sortWithinPartitions("_test", K.TIME, K.DATE)
    return write_folders(rows, f"{root}/TimeSeries", "_test")


def write_results(spark: SparkSession, sf_dir: str, root: str) -> str:
    # the CSV writer trims leading / trailing blanks by default: keep text as is
    (source_results(spark, sf_dir).write.mode("overwrite")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("header", True).option("sep", ";").csv(f"{root}/Results"))
    return f"{root}/Results"


def read_bronze_measurements(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, columns=TS_COLUMNS_D, recursive=True)


def read_bronze_results(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, columns=RESULT_COLUMNS_D, recursive=True)


# ------------------------------------------------------------ layer jobs
INGEST_DATE = LD.LOADED
REQUIRED = ("timeseries", "results")


def ledger_path(lake: Lake, name: str) -> str:
    return lake.path("bronze", f"{name}_files")


def bronze(spark: SparkSession, sources: dict[str, str], lake: Lake,
           columns: dict[str, list[str] | None] | None = None,
           by_ingest_date: bool = False) -> DataFrame:
    """IO1-IO7: each source folder -> bronze parquet, all strings + lineage.

    All files of a source must have the columns given, or else those of its first
    file, in that order: any other header is an error. Lines with too few or too
    many values are kept padded or cut, as the reader does, with their whole text
    beside them, and counted per file in the source's ledger.

    A load overwrites its tables; an optional source (warranty, catalogue) that is
    absent leaves none. With ``by_ingest_date`` bronze is partitioned by ingestion
    day: a daily run replaces its day and reads only files that the ledger has not
    entered as they are now on an earlier day.

    Files are listed and read ``ledger.GROUP`` at a time, many to a task: the driver
    never holds or plans a source with a file per unit whole.

    Returns (table, rows, files, malformed) of this load."""
    with small_files(spark):
        return _load(spark, sources, lake, columns or {}, by_ingest_date)


def _load(spark: SparkSession, sources: dict[str, str], lake: Lake, columns: dict[str, list[str] | None],
          by_ingest_date: bool) -> DataFrame:
    today = F.current_date()
    out = None
    for name, path in sources.items():
        listed = LD.list_files(spark, path)
        if listed is None:
            if name in REQUIRED:
                raise FileNotFoundError(f"no source files for {name} in {path}")
            if not by_ingest_date:
                drop_layer(spark, lake.path("bronze", name))
                drop_layer(spark, ledger_path(lake, name))
            continue
        if by_ingest_date:
            listed = LD.unread(listed, _known_files(spark, lake, name))
        groups = LD.file_groups(listed)
        first = next(groups, None)
        if first:
            cols = columns.get(name) or header_of(spark, first[0])
            df, staged = _read_groups(spark, first, groups, cols, name)
            if by_ingest_date:
                write_layer(df.withColumn(INGEST_DATE, today), lake.path("bronze", name), partition_by=[INGEST_DATE],
                            partitionOverwriteMode="dynamic")
                rows = read_layer(spark, lake.path("bronze", name)).where(F.col(INGEST_DATE) == today)
            else:
                write_layer(df, lake.path("bronze", name))
                rows = read_layer(spark, lake.path("bronze", name))
            write_layer(LD.entries(listed, rows, cols, ";"), ledger_path(lake, name), partition_by=[INGEST_DATE],
                        **({"partitionOverwriteMode": "dynamic"} if by_ingest_date else {}))
            if staged:
                drop_layer(spark, staged)
        ledger = LD.read_ledger(spark, ledger_path(lake, name))
        if ledger is None:
            continue
        one = ledger.where(F.col(INGEST_DATE) == today).agg(
            F.lit(name).alias("table"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("malformed"), F.lit(0)).alias("malformed"))
        out = one if out is None else out.unionByName(one)
    return out


def _read_groups(spark: SparkSession, first: list[str], others: Iterator[list[str]], cols: list[str],
                 name: str) -> tuple[DataFrame, str | None]:
    """The files' rows. Of several groups each is read into one scratch table (its
    path comes along), so that bronze still takes all of a load in one write, or none."""
    def read(found: list[str]) -> DataFrame:
        return read_delimited(spark, found, columns=cols, recursive=True, malformed=LD.MALFORMED)
    second = next(others, None)
    if second is None:
        return read(first), None
    staged = scratch_path(spark, f"bronze-{name}")
    for found in chain([first, second], others):
        write_layer(read(found), staged, mode="append")
    return read_layer(spark, staged), staged


def _known_files(spark: SparkSession, lake: Lake, name: str) -> DataFrame | None:
    """The source's ledger. A dated table without one (written by an earlier
    version) is entered first, from its file names."""
    ledger = LD.read_ledger(spark, ledger_path(lake, name))
    if ledger is not None:
        return ledger
    rows = read_optional(spark, lake.path("bronze", name))
    if rows is None or INGEST_DATE not in rows.columns:
        return None
    write_layer(LD.entries_of_table(rows), ledger_path(lake, name), partition_by=[INGEST_DATE])
    return LD.read_ledger(spark, ledger_path(lake, name))


def read_bronze(spark: SparkSession, lake: Lake, name: str) -> DataFrame | None:
    """A bronze table (None where absent); of a file that was loaded again after
    it had changed, only the newest load."""
    rows = read_optional(spark, lake.path("bronze", name))
    if rows is None or INGEST_DATE not in rows.columns:
        return rows
    return LD.newest_loads(rows, LD.read_ledger(spark, ledger_path(lake, name)))


def silver(spark: SparkSession, lake: Lake, sensors=K.SENSORS, scope: str = "name",
           result_order: list[str] | None = None, sort: bool = True) -> DataFrame:
    """IO8: typed series (sorted by unit, time), worst-verdict labels,
    trimmed product classification and warranty. ``result_order`` is the total
    order of a unit's tests that picks its representative product / stand
    (the reference's ``first()`` has none).

    ``sort`` (the reference's behaviour) range-sorts the series on (unit,
    time): a full shuffle of every reading, paid once, after which parquet
    min/max statistics on the unit let per-unit reads skip files. The gold
    aggregation re-groups by unit anyway, so ``sort=False`` writes the rows in
    arrival order with no shuffle at all."""
    ts = read_bronze(spark, lake, "timeseries")
    clean = CL.clean_measurements(ts, sensors=sensors, scope=scope, keep_arrival=True)
    flagged = clean.withColumn(QUARANTINED, F.col(K.SERIAL).isNull().cast("int"))
    # both tables in one write: the flag leads the sort, so no other one is needed
    write_layer(flagged.orderBy(QUARANTINED, K.SERIAL, K.TS) if sort else flagged,
                lake.path("silver", "timeseries"), partition_by=[QUARANTINED])
    lines = CL.clean_results(read_bronze(spark, lake, "results").drop(LD.MALFORMED))
    attrs = [c for c in (K.PRODUCT, K.STAND) if c in lines.columns]
    write_layer(LB.worst_label(lines, attributes=attrs, order=result_order),
                lake.path("silver", "results_dedup"))
    written = {"results_dedup": lake.path("silver", "results_dedup")}
    for name, fn in [("itemclassification", CL.trim_all), ("warranty", CL.clean_warranty)]:
        src = read_bronze(spark, lake, name)
        if src is None:
            drop_layer(spark, lake.path("silver", f"{name}_clean"))
            continue
        write_layer(fn(src.drop(LD.MALFORMED)), lake.path("silver", f"{name}_clean"))
        written[f"{name}_clean"] = lake.path("silver", f"{name}_clean")
    good, bad = read_series(spark, lake)
    counts = {"timeseries_clean": good, "timeseries_quarantine": bad} | {k: read_layer(spark, v) for k, v in written.items()}
    return AU.layer_counts(counts, key=K.SERIAL)


def read_series(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    """(clean series, rows without a serial) of the silver layer: partitions of
    one table, each read alone."""
    rows = read_layer(spark, lake.path("silver", "timeseries"))
    good, bad = (rows.where(F.col(QUARANTINED) == n).drop(QUARANTINED) for n in (0, 1))
    return good, bad


def gold(spark: SparkSession, lake: Lake, sensors=K.SENSORS,
         exact_median: bool = False) -> DataFrame:
    """IO9 + IO12: fact (features ⋈ labels), product dimension, flat dataset."""
    ts = read_series(spark, lake)[0]
    res = read_layer(spark, lake.path("silver", "results_dedup"))
    fact = ST.fact_table(FE.sequence_features(ts, sensors=sensors, exact_median=exact_median),
                         res)
    write_layer(fact, lake.path("gold", "fait_test_moteur"))
    fact = read_layer(spark, lake.path("gold", "fait_test_moteur"))
    out = {"fait_test_moteur": fact}
    ic = read_optional(spark, lake.path("silver", "itemclassification_clean"))
    if ic is None:  # no catalogue: fact only
        for name in ("dim_produit", "dataset_ml"):
            drop_layer(spark, lake.path("gold", name))
        return AU.layer_counts(out, key=K.SERIAL)
    write_layer(ST.dim_product(ic), lake.path("gold", "dim_produit"))
    dim = read_layer(spark, lake.path("gold", "dim_produit"))
    paths = export_dataset(ST.dataset_ml(fact, dim), lake.path("gold", "dataset_ml"))
    out["dim_produit"] = dim
    out["dataset_ml"] = read_layer(spark, paths["parquet"])
    return AU.layer_counts(out, key=K.SERIAL)


def publish_bucketed(df: DataFrame, table: str, buckets: int, key: str = K.SERIAL) -> str:
    """The fact (or scored units) as a table bucketed on the unit key, so the
    report joins fact ⟕ predictions run without a shuffle."""
    return save_bucketed(df, table, key, buckets)


def publish_scores(scored: DataFrame, table: str, fmt: str = "parquet") -> str:
    """IO13: the scored units as a catalog table (the reference uses Delta;
    any installed table format can be named)."""
    return save_table(scored, table, fmt=fmt)
