"""Streaming layers SS2-SS5: stream = batch, replays, state, versions."""

import os

import pytest
from pyspark.sql import functions as F

from assay import constants as K
from assay.operators import clean as CL
from assay.operators import features as FE
from assay.operators import label as LB
from assay.operators import model as MD
from assay.plans import bindings as B
from assay.plans import medallion as M
from assay.session import scratch_path
from assay.sources.delimited import read_delimited_stream
from assay.streaming import scoring, sequences, silver, upsert
from assay.streaming.continuous import completed_sequences
from assay.streaming.runs import finished, read_ledger
from tests.conftest import SF001

NAME = "TimeSeries_{:032x}.csv"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def write_files(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, lines in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write("\n".join(["DATE;HEURE;PHASE;VALUE;K", *lines]) + "\n")


GOOD = ["01/02/2024;10:00:00;A;1.5;2", "01/02/2024;10:00:05;B;2,5;x", "31/02/2024;10:00:06;B;;3"]


def test_silver_stream_writes_both_layers_once(spark, tmp_path):
    folder, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    write_files(folder, {NAME.format(1): GOOD, "no_serial.csv": GOOD[:1]})
    raw = lambda: read_delimited_stream(spark, folder, M.TS_COLUMNS_D, max_files_per_trigger=1)
    runs = silver.run_silver(raw(), out, ckpt, M.SENSORS_D)
    assert len([p for p in runs if p["rows"]]) == 2
    good, bad = silver.read_silver(spark, out, M.SENSORS_D)
    assert good.count() == 3 and bad.count() == 1 and bad.where(f"{K.SERIAL} is not null").count() == 0
    assert sorted(r["VALUE"] for r in good.collect() if r["VALUE"] is not None) == [1.5]
    names = ("rows", "quarantined", "bad_time", "bad_VALUE", "bad_K")
    counted = {c: sum(r["observed"]["silver"][c] for r in runs if "silver" in r["observed"]) for c in names}
    assert read_ledger(spark, out).count() == 2 and counted == {"rows": 4, "quarantined": 1, "bad_time": 1, "bad_VALUE": 1, "bad_K": 1}
    # a second run reads new files only
    write_files(folder, {NAME.format(2): GOOD[:2]})
    silver.run_silver(raw(), out, ckpt, M.SENSORS_D)
    before = rows_of(silver.read_silver(spark, out, M.SENSORS_D)[0])
    assert len(before) == 5
    # a replayed batch changes nothing, and a batch broken off before its ledger row is not read
    batch = spark.read.option("header", True).option("sep", ";").csv(f"{folder}/{NAME.format(2)}").withColumn("_source_file", F.lit(f"/x/{NAME.format(2)}"))
    silver.write_silver_batch(batch, 2, out, M.SENSORS_D)
    assert rows_of(silver.read_silver(spark, out, M.SENSORS_D)[0]) == before
    batch.write.parquet(f"{out}/rows/batch_id=99/_quarantined=0")
    assert rows_of(silver.read_silver(spark, out, M.SENSORS_D)[0]) == before


def test_silver_stream_parses_once_and_prunes(spark, tmp_path):
    folder, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    write_files(folder, {NAME.format(1): GOOD})
    silver.run_silver(read_delimited_stream(spark, folder, M.TS_COLUMNS_D), out, ckpt, M.SENSORS_D)
    bad = silver.read_silver(spark, out, M.SENSORS_D)[1]
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_quarantined" in plan.split("PartitionFilters")[1][:200]
    assert bad.count() == 0


def test_silver_stream_without_rows(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    write_files(str(tmp_path / "in"), {NAME.format(1): []})
    out = str(tmp_path / "out")
    silver.run_silver(read_delimited_stream(spark, str(tmp_path / "in"), M.TS_COLUMNS_D), out, str(tmp_path / "ckpt"), M.SENSORS_D)
    if os.path.exists(f"{out}/ledger"):
        assert [d.count() for d in silver.read_silver(spark, out, M.SENSORS_D)] == [0, 0]


LINES = "SERIAL_NUMBER string, LAB int, TEST_STAND string, TEST_ID long"


def label_stream(spark, folder):
    r = spark.readStream.schema(LINES).option("maxFilesPerTrigger", 1).parquet(folder)
    return LB.worst_label(r, attributes=[K.STAND], order=["TEST_ID"])


def add_lines(spark, folder, rows):
    spark.createDataFrame(rows, LINES).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("merge_every", [0, 2])
def test_running_labels_upsert(spark, tmp_path, merge_every):
    folder, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    everything = []
    for n in range(5):
        rows = [(f"u{(n * 7 + k) % 30}", (n + k) % 9 == 0, f"s{k % 3}", 100 * n + k) for k in range(8)]
        rows = [(u, int(y), s, i) for u, y, s, i in rows] + ([(None, 1, None, 900 + n)] if n == 2 else [])
        everything += rows
        add_lines(spark, folder, rows)
        agg = label_stream(spark, folder)
        upsert.run_upserts(agg, out, ckpt, [K.SERIAL], buckets=4, merge_every=merge_every)
        want = rows_of(LB.worst_label(spark.createDataFrame(everything, LINES), attributes=[K.STAND], order=["TEST_ID"]))
        assert rows_of(upsert.current(spark, out, [K.SERIAL], agg.schema).select(*agg.columns)) == want
    # batches hold the units that changed, not all of them
    numbers = finished(spark, f"{out}/changes", upsert.VERSION)
    assert len(numbers) == (5 if not merge_every else 1)
    for n in numbers:
        assert spark.read.parquet(f"{out}/changes/{upsert.VERSION}={n}").count() <= 9
    # a replayed batch, and a merge broken off before it deletes, change nothing
    agg = label_stream(spark, folder)
    last = spark.read.parquet(f"{out}/changes/{upsert.VERSION}={numbers[-1]}").drop("_bucket")
    upsert.write_changes(last.cache(), numbers[-1], out, [K.SERIAL], 4)
    assert rows_of(upsert.current(spark, out, [K.SERIAL], agg.schema).select(*agg.columns)) == want
    kept = upsert._delete
    try:
        upsert._delete = lambda *a: None
        upsert.merge(spark, out, [K.SERIAL], agg.schema)
    finally:
        upsert._delete = kept
    assert rows_of(upsert.current(spark, out, [K.SERIAL], agg.schema).select(*agg.columns)) == want
    upsert.merge(spark, out, [K.SERIAL], agg.schema)
    assert rows_of(upsert.current(spark, out, [K.SERIAL], agg.schema).select(*agg.columns)) == want
    assert finished(spark, f"{out}/changes", upsert.VERSION) == []


def test_merge_leaves_untouched_buckets(spark, tmp_path):
    out = str(tmp_path / "t")
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    upsert.write_changes(rows, 0, out, ["k"], 8)
    assert len(upsert.merge(spark, out, ["k"], rows.schema)) == 8
    one = rows.where("k = 5").withColumn("v", F.lit("new"))
    upsert.write_changes(one, 1, out, ["k"], 8)
    assert len(upsert.merge(spark, out, ["k"], rows.schema)) == 1
    got = {r.k: r.v for r in upsert.current(spark, out, ["k"], rows.schema).collect()}
    assert len(got) == 100 and got[5] == "new" and sum(v == "new" for v in got.values()) == 1
    rewritten = spark.read.parquet(f"{out}/base/{upsert.VERSION}=1")
    assert rewritten.select("_bucket").distinct().count() == 1
    assert upsert.current(spark, str(tmp_path / "none"), ["k"], rows.schema).count() == 0


def test_file_sequences_are_stateless_and_equal_batch(spark, tmp_path):
    folder, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    write_files(folder, {NAME.format(i): GOOD[:1 + i % 3] for i in range(6)} | {"no_serial.csv": GOOD})
    raw = lambda: read_delimited_stream(spark, folder, M.TS_COLUMNS_D, max_files_per_trigger=2)
    runs = sequences.run_file_sequences(raw(), out, ckpt, M.SENSORS_D)
    assert all(r["state_rows"] == 0 for r in runs) and len([r for r in runs if r["rows"]]) == 4
    write_files(folder, {NAME.format(9): GOOD})
    sequences.run_file_sequences(raw(), out, ckpt, M.SENSORS_D)
    got = sequences.read_sequences(spark, out, sequences.sequence_schema(M.SENSORS_D)).drop("_source_file", "batch_id")
    clean = CL.clean_measurements(M.read_bronze_measurements(spark, folder), sensors=M.SENSORS_D)
    want = FE.sequence_features(clean.where(f"{K.SERIAL} is not null"), sensors=M.SENSORS_D)
    assert got.count() == 7 and rows_of(got.select(*want.columns)) == rows_of(want)


READINGS = f"{K.SERIAL} string, {K.TS} timestamp, {K.PHASE} string, VALUE double"


def test_bus_sequences_come_once_and_state_stays_flat(spark, tmp_path):
    """Ten batches of equal size, a unit's sequence per batch, then a late reading."""
    import datetime as dt
    folder, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    start = dt.datetime(2024, 3, 1)
    rows = lambda n: [(f"u{k}", start + dt.timedelta(hours=2 * n, minutes=m), "A", float(n + k + m)) for k in range(5) for m in (0, 5, 9)]
    every, runs = [], []
    stream = lambda: spark.readStream.schema(READINGS).parquet(folder)
    for n in range(10):
        every += rows(n)
        spark.createDataFrame(rows(n), READINGS).coalesce(1).write.mode("append").parquet(folder)
        runs += sequences.run_bus_sequences(stream(), out, ckpt, ["VALUE"], gap="30 minutes")
    late = [("u0", start, "A", 99.0)]
    spark.createDataFrame(late, READINGS).coalesce(1).write.mode("append").parquet(folder)
    runs += sequences.run_bus_sequences(stream(), out, ckpt, ["VALUE"], gap="30 minutes")
    schema = sequences.sequence_schema(["VALUE"], ends="gap")
    got = sequences.read_sequences(spark, out, schema).drop("batch_id")
    want = completed_sequences(spark.createDataFrame(every, READINGS), ["VALUE"], gap="30 minutes").where(
        F.col("session_end") <= F.lit(start + dt.timedelta(hours=18, minutes=9 - 30)))
    assert got.count() == 45 and got.groupBy(K.SERIAL, "session_start").count().where("count > 1").count() == 0
    assert rows_of(got.select(*want.columns)) == rows_of(want)
    state = [r["state_rows"] for r in runs]
    assert max(state) <= 10 and state[-1] <= 10
    assert sum(r["late_rows"] for r in runs) >= 1


def test_scoring_chain_scores_each_sequence_once(spark, tmp_path):
    """Files -> finished sequences -> scores, with a new model between two runs."""
    folder, seq, out, models, ckpt = (str(tmp_path / x) for x in ("in", "seq", "out", "models", "ckpt"))
    sensors = ["VALUE", "K"]
    lines = lambda i: [f"01/02/2024;10:00:{s:02d};A;{(i * 7 + s * 3) % 11}.5;{i % 4}" for s in range(1 + i % 5)]
    write_files(folder, {NAME.format(i): lines(i) for i in range(20)})
    raw = lambda: read_delimited_stream(spark, folder, M.TS_COLUMNS_D, max_files_per_trigger=8)
    batch = sequences.file_features(M.read_bronze_measurements(spark, folder), sensors)
    names = FE.feature_names(sensors)
    frame = FE.fill_missing_features(batch, names).withColumn(K.LABEL, (F.col("K_mean") > 1).cast("int")).withColumn("classWeight", F.lit(1.0))
    with pytest.raises(ValueError, match="no model"):
        scoring.newest_version(spark, models)
    first, second = (MD.pipeline("lr", names).fit(frame.where(c)) for c in ("true", "VALUE_mean < 8"))
    scoring.register_model(first, models, 1)
    run = lambda: scoring.run_scoring(raw(), models, out, ckpt, sensors, threshold=0.5,
                                      features=lambda b: sequences.file_features(b, sensors))
    assert len([r for r in run() if r["rows"]]) == 3
    scoring.register_model(second, models, 2)
    write_files(folder, {NAME.format(i): lines(i) for i in range(20, 25)})
    run()
    got = scoring.read_scores(spark, out)
    assert got.count() == 25 and got.select(K.SERIAL).distinct().count() == 25
    by_version = {r[0]: r[1] for r in got.groupBy("model_version").count().collect()}
    assert by_version == {1: 20, 2: 5}
    for version, model in ((1, first), (2, second)):
        mine = got.where(F.col("model_version") == version)
        every = sequences.file_features(M.read_bronze_measurements(spark, folder), sensors)
        want = {r[K.SERIAL]: r[K.PROBABILITY] for r in scoring.score_sequences(every, model, sensors, 0.5).collect()}
        assert all(r[K.PROBABILITY] == pytest.approx(want[r[K.SERIAL]]) and r[K.FINAL_PREDICTION] == int(want[r[K.SERIAL]] >= 0.5)
                   for r in mine.collect())
    # a replayed batch keeps the version it was noted with, though a newer one exists
    before = rows_of(got)
    one = got.where("batch_id = 0").select(K.SERIAL)
    again = sequences.file_features(M.read_bronze_measurements(spark, folder), sensors).join(one, K.SERIAL)
    scoring.score_batch(again.cache(), 0, models, out, sensors, 0.5)
    assert rows_of(scoring.read_scores(spark, out)) == before


def test_stream_scores_equal_the_batch_scoring(spark):
    from assay.plans.queries_ml import fit_fact_forest
    from assay.plans.queries_stream import stream_scores
    model, test = fit_fact_forest(spark, SF001)
    streamed = {r[K.SERIAL]: r for r in stream_scores(spark, SF001, model).collect()}
    scored = MD.score_units(model, test).collect()
    assert scored and len(streamed) >= len(scored)
    for r in scored:
        assert streamed[r[K.SERIAL]][K.PROBABILITY] == pytest.approx(r[K.PROBABILITY], abs=1e-9)
        assert streamed[r[K.SERIAL]][K.FINAL_PREDICTION] == r[K.FINAL_PREDICTION]
