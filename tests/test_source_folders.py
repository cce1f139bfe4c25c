"""Binding D's source folders: as many files as units, so the write of a file
has to be cheap, and a query writes and reads only the sources it names."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001

from assay.plans import medallion as M
from assay.plans import queries_io as Q
from assay.plans.queries_io import q_bronze_results, q_file_time_inversions
from assay.session import scratch_path
from assay.sources import delimited as D

ROWS = [("b", "1", " padded "), ("a", None, "semi;colon"), ("a", "2", 'quo"te'), (None, "3", "x"), ("a", "", "é"),
        ("c", None, None), ("", "4", "back\\slash"), ("b", "5", "\\")]


def local(path):
    return path.removeprefix("file:")


def test_folders_hold_what_the_csv_writer_writes(spark):
    df = spark.createDataFrame(ROWS, "f string, a string, b string").repartitionByRange(3, "f").sortWithinPartitions("f", "a")
    mine, theirs = (scratch_path(spark, n) for n in ("folders", "folders-spark"))
    D.write_folders(df, mine, "f")
    (df.write.partitionBy("f").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("header", True).option("sep", ";").csv(theirs))
    got, want = ([tuple(r) for r in D.read_delimited(spark, p, columns=["a", "b"], recursive=True)
                  .select(F.regexp_extract(D.SOURCE_FILE, r"/f=([^/]*)/", 1), "a", "b").collect()] for p in (mine, theirs))
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == len(ROWS)
    assert sorted(f for f in os.listdir(local(mine))) == sorted(f for f in os.listdir(local(theirs)) if f.startswith("f="))


def test_a_unit_costs_one_file_and_no_checksum_file(spark):
    root = M.write_time_series(spark, SF001, scratch_path(spark, "sources"))
    units = [f for f in os.listdir(local(root)) if f.startswith("_test=")]
    files = [f for u in units for f in os.listdir(f"{local(root)}/{u}")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(units) == M.source_events(spark, SF001).select("_test").distinct().count()
    assert len(units) <= len(files) < len(units) + n and all(f.endswith(".csv") and f[0] != "." for f in files)


def test_folders_are_written_anew(spark):
    path = scratch_path(spark, "folders")
    for key in ("old", "new"):
        D.write_folders(spark.createDataFrame([(key, "1")], "f string, a string"), path, "f")
    assert os.listdir(local(path)) == ["f=new"]


def test_results_come_without_the_time_series(spark, monkeypatch):
    monkeypatch.setattr(M, "source_events", lambda *_: pytest.fail("bronze_results reads no time series"))
    assert q_bronze_results(spark, SF001).count() == spark.read.parquet(f"{SF001}/orders.parquet").count()


def test_time_inversions_read_the_files_once(spark, monkeypatch):
    opened = spark.sparkContext.accumulator(0)
    read = M.read_bronze_measurements

    def counted(spark, path):
        df = read(spark, path)
        mark = F.udf(lambda v: (opened.add(1), v)[1])
        return df.withColumn("VALUE", mark("VALUE")).withColumn("HEURE", mark("HEURE"))
    monkeypatch.setattr(Q.M, "read_bronze_measurements", counted)
    q_file_time_inversions(spark, SF001).collect()
    assert opened.value == 2 * spark.read.parquet(f"{SF001}/events.parquet").count()


def test_a_stream_task_reads_many_small_files(spark):
    """A file is not reckoned at 4 MB: at the default 31 of these files, whatever
    their size, fill a task, and of larger sources four or so."""
    from assay.streaming.runs import run_batches
    rows = spark.range(600).select(F.concat(F.lit("f"), F.col("id")).alias("f"), F.col("id").cast("string").alias("a"))
    path, seen = D.write_folders(rows.repartition(4).sortWithinPartitions("f"), scratch_path(spark, "many"), "f"), []
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes", "spark.sql.sources.parallelPartitionDiscovery.parallelism")}

    def sink(batch, batch_id):
        seen.append((batch.rdd.getNumPartitions(), sorted(r.a for r in batch.select("a").collect())))
    run_batches(D.read_delimited_stream(spark, path, ["a"]), sink, scratch_path(spark, "many-ckpt"))
    (tasks, found), = seen
    assert found == sorted(map(str, range(600))) and tasks <= spark.sparkContext.defaultParallelism + 1
    assert {k: spark.conf.get(k) for k in before} == before


@pytest.mark.parametrize("dated", [False, True])
def test_bronze_takes_a_source_in_groups(spark, monkeypatch, dated):
    """No reader is given all files of a source with a file per unit, and the load
    is the same as from one read."""
    from assay.sources import ledger as LD
    rows = spark.range(300).select(F.concat(F.lit("u "), F.col("id") % 40).alias("f"), F.col("id").cast("string").alias("a"),
                                   F.lit("x").alias("b")).repartition(3, "f").sortWithinPartitions("f")
    src = D.write_folders(rows, scratch_path(spark, "grouped"), "f")
    results = scratch_path(spark, "grouped-results")
    spark.createDataFrame([("s", "G")], "a string, b string").write.option("header", True).option("sep", ";").csv(results)
    given, found = [], {}
    plain = D.read_delimited
    monkeypatch.setattr(M, "read_delimited", lambda spark, paths, **kw: given.append(len(paths)) or plain(spark, paths, **kw))
    for group in (10_000, 7):
        monkeypatch.setattr(LD, "GROUP", group, raising=False)
        given.clear()
        lake = M.Lake(scratch_path(spark, "grouped-lake"))
        M.bronze(spark, {"timeseries": src, "results": results}, lake, by_ingest_date=dated)
        bronze, ledger = M.read_bronze(spark, lake, "timeseries"), LD.read_ledger(spark, M.ledger_path(lake, "timeseries"))
        order = bronze.orderBy(*D.ARRIVAL).groupBy(D.SOURCE_FILE).agg(F.collect_list("a").alias("a"))
        found[group] = (sorted(map(tuple, order.collect())), sorted(map(tuple, ledger.collect())), bronze.columns)
    assert found[7] == found[10_000] and len(found[7][1]) == 40
    assert max(given) <= 7 and len(given) == 7          # 40 files and the one of results
