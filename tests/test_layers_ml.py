"""Layer jobs end to end on the fixtures, streaming ingest = batch, and the
model layer on a small binding."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES, SF001

from assay import constants as K
from assay.operators import model as MD
from assay.operators import split as SP
from assay.plans import bindings as B
from assay.plans import medallion as M
from assay.session import scratch_path
from assay.sources.delimited import read_delimited, read_delimited_stream
from assay.streaming.continuous import ingest_bronze

TS_COLS = [K.DATE, K.TIME, K.PHASE, *K.SENSORS[:10], "SENSOR_3", *K.SENSORS[10:]]


def test_bronze_silver_gold(spark):
    lake = M.Lake(scratch_path(spark, "lake"))
    src = {"timeseries": os.path.join(FIXTURES, "timeseries"),
           "results": os.path.join(FIXTURES, "results"),
           "warranty": os.path.join(FIXTURES, "warranty"),
           "itemclassification": os.path.join(FIXTURES, "items_dup")}
    b = {r["table"]: r["rows"] for r in
         M.bronze(spark, src, lake, columns={"timeseries": TS_COLS}).collect()}
    assert b == {"timeseries": 34, "results": 16, "warranty": 3, "itemclassification": 4}
    s = {r["table"]: r for r in M.silver(spark, lake).collect()}
    assert s["timeseries_clean"]["rows"] == 31 and s["timeseries_quarantine"]["rows"] == 3
    assert s["results_dedup"]["units"] == 12
    g = {r["table"]: r for r in M.gold(spark, lake).collect()}
    assert g["fait_test_moteur"]["rows"] == 2 and g["dim_produit"]["rows"] == 3
    csv = spark.read.option("header", True).csv(lake.path("gold", "dataset_ml") + "/csv")
    assert csv.count() == g["dataset_ml"]["rows"] == 2      # flat export: parquet + CSV
    fact = spark.read.parquet(lake.path("gold", "fait_test_moteur"))
    assert len([c for c in fact.columns if c.endswith(tuple("_" + s for s in K.STATS))]) == 60
    assert [c for c in fact.columns if c.startswith("_leak_")] == K.LEAK_COLUMNS
    # silver series is written sorted by (serial, time) within and across files
    ts = spark.read.parquet(lake.path("silver", "timeseries_clean")).toPandas()
    assert ts[[K.SERIAL, K.TS]].equals(ts[[K.SERIAL, K.TS]].sort_values(
        [K.SERIAL, K.TS], na_position="first").reset_index(drop=True))


def test_stream_ingest_equals_batch(spark):
    path = os.path.join(FIXTURES, "timeseries")
    out = scratch_path(spark, "stream-bronze")
    ingest_bronze(read_delimited_stream(spark, path, TS_COLS), out,
                  scratch_path(spark, "stream-bronze-ckpt"))
    cols = [*TS_COLS, "_source_name"]
    key = repr
    got = sorted((tuple(r) for r in spark.read.parquet(out).select(cols).collect()), key=key)
    want = sorted((tuple(r) for r in
                   read_delimited(spark, path, columns=TS_COLS, recursive=True)
                   .select(cols).collect()), key=key)
    assert got == want


def test_models_small(spark):
    df = B.vectors_c(spark, SF001)
    train, test = SP.train_test(df)
    w = SP.class_weights(train)
    SP.require_both_classes(w)
    n = {r[K.LABEL]: r for r in w.collect()}
    total = n[0]["count"] + n[1]["count"]
    assert n[1]["weight"] == pytest.approx(total / (2 * n[1]["count"]))
    train = SP.with_class_weight(train).cache()
    preds = {}
    for kind in ("lr", "svm", "rf"):
        m = MD.fit(kind, train, B.C_FEATURES)
        preds[kind] = MD.predict(m, test)
        assert preds[kind].count() == test.count()
        if kind == "rf":
            imp = MD.feature_importance(m, B.C_FEATURES, spark, top=None)
            assert imp.count() == 64
            assert imp.agg(F.sum("Importance")).first()[0] == pytest.approx(1.0)
            scored = MD.score_units(m, test)
            assert set(scored.columns) == {K.SERIAL, K.LABEL, K.PROBABILITY,
                                           K.FINAL_PREDICTION, K.OUTCOME}
    lb = MD.leaderboard(preds).collect()
    assert len(lb) == 3 and all(0 <= r["ROC_AUC"] <= 1 for r in lb)


def test_missing_class_raises(spark):
    df = B.vectors_c(spark, SF001).where(F.col(K.LABEL) == 0)
    with pytest.raises(ValueError):
        SP.require_both_classes(SP.class_weights(df))


def test_publish_scores_table(spark):
    df = B.scores_e(spark, SF001)
    name = "assay_test_scores"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    M.publish_scores(df, name)
    assert spark.table(name).count() == df.count()
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_stream_scoring_batches(spark):
    from assay.streaming.continuous import score_batches, stream_table
    df = B.vectors_c(spark, SF001)
    train, _ = SP.train_test(df)
    m = MD.fit("lr", SP.with_class_weight(train), B.C_FEATURES)
    stream = stream_table(spark, SF001, "embeddings")
    feats = stream.select(
        F.col("vec_id").alias(K.SERIAL), (F.col("label") == 0).cast("int").alias(K.LABEL),
        *[F.col("embedding")[i].cast("double").alias(f"e_{i}") for i in range(64)])
    out = score_batches(feats, lambda b: MD.score_units(m, b),
                        scratch_path(spark, "scores"), scratch_path(spark, "scores-ckpt"))
    got = spark.read.parquet(out).drop("batch_id")
    assert got.count() == df.count()
    batch = MD.score_units(m, df)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_replayed_batch_leaves_no_duplicates(spark):
    from assay.streaming.continuous import write_batch
    out = scratch_path(spark, "replayed")
    for batch_id in (0, 1, 1):
        write_batch(spark.range(batch_id * 5, batch_id * 5 + 5), batch_id, out)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(10))


def _text_files(folder, files):
    os.makedirs(folder)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(text)
    return str(folder)


def test_only_csv_files_are_read(spark, tmp_path):
    path = _text_files(tmp_path / "in", {"a.csv": "X;Y\n1;2\n", "notes.txt": "X;Y\n8;9\n"})
    got = read_delimited(spark, path, columns=["X", "Y"], recursive=True, lineage=False)
    assert [tuple(r) for r in got.collect()] == [("1", "2")]
    assert read_delimited(spark, path, columns=["X", "Y"], lineage=False, files=None).count() == 2


def test_swapped_header_is_an_error(spark, tmp_path):
    path = _text_files(tmp_path / "in", {"a.csv": "X;Y\n1;2\n", "b.csv": "Y;X\n2;1\n"})
    with pytest.raises(Exception, match="header"):
        read_delimited(spark, path, columns=["X", "Y"], lineage=False).collect()


def test_choose_final_and_best_threshold(spark):
    from assay.operators import evaluate as EV
    sw = EV.threshold_sweep(B.scores_e(spark, SF001))
    best = MD.best_threshold(sw).first()
    assert best["F1"] == max(r["F1"] for r in sw.collect())


def test_session_sequences_append_emits_closed_ones(spark):
    from assay.streaming.continuous import completed_sequences, materialize, stream_table
    ev = stream_table(spark, SF001, "events").select(
        F.col("user_id").alias(K.SERIAL), F.col("ts").alias(K.TS),
        F.col("event_type").alias(K.PHASE), F.col("value").alias("VALUE"))
    seq = completed_sequences(ev, ["VALUE"], gap="6 hours")
    closed = materialize(spark, seq, "closed", mode="append")
    every = materialize(spark, completed_sequences(ev, ["VALUE"], gap="6 hours"), "all")
    key = [K.SERIAL, "session_start"]
    c, a = closed.count(), every.count()
    assert 0 < c < a
    # each closed sequence is final: equal to its complete-mode row
    assert closed.exceptAll(every.select(closed.columns)).count() == 0   # NULL-safe
    # open = not yet passed by the (global) watermark: max event time - 6 h
    wm = every.agg(F.max(F.col("session_end") - F.expr("INTERVAL 12 HOURS"))).first()[0]
    open_ = every.join(closed, key, "left_anti")
    assert open_.where(F.col("session_end") <= F.lit(wm)).count() == 0
    assert closed.where(F.col("session_end") > F.lit(wm)).count() == 0


def test_bucketed_fact_join_has_no_exchange(spark):
    from assay.plans.queries_core import fact_a
    from assay.plans.queries_eval import predictions_e
    spark.sql("DROP TABLE IF EXISTS assay_fact_b8")
    spark.sql("DROP TABLE IF EXISTS assay_pred_b8")
    M.publish_bucketed(fact_a(spark, SF001), "assay_fact_b8", 8)
    M.publish_bucketed(predictions_e(spark, SF001), "assay_pred_b8", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force a shuffle join
    try:
        j = spark.table("assay_fact_b8").join(spark.table("assay_pred_b8").select(
            K.SERIAL, K.PROBABILITY), K.SERIAL, "left")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == spark.table("assay_fact_b8").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS assay_fact_b8")
        spark.sql("DROP TABLE IF EXISTS assay_pred_b8")


def test_medallion_fact_equals_sql(spark):
    import math
    import __spark_entry__ as E
    from oracle_compare import duck
    from conftest import SF01
    from assay.plans.queries_io import medallion_fact_sql
    got = E.queries()["medallion_fact"](spark, SF01)
    g = {r[K.SERIAL]: r.asDict() for r in got.collect()}
    con = duck(SF01)
    rel = con.execute(medallion_fact_sql())
    cols = [c[0] for c in rel.description]
    want = {r[0]: dict(zip(cols, r)) for r in rel.fetchall()}
    assert set(g) == set(want) and len(g) > 100
    assert sorted(got.columns) == sorted(cols)
    for k, w in want.items():
        for c, v in w.items():
            a = g[k][c]
            if isinstance(v, float) and v is not None and a is not None:
                assert math.isclose(a, v, rel_tol=1e-6, abs_tol=1e-6), (k, c, a, v)
            else:
                assert a == v, (k, c, a, v)


def test_jobs_whole_workflow(spark):
    """bronze -> silver -> gold -> model on source folders written from the
    test tables (reference folder layout), as the command-line jobs run it."""
    from assay.plans import jobs as J
    from conftest import SF01
    root = scratch_path(spark, "jobs-src")
    M.write_sources(spark, SF01, root)
    lake = M.Lake(scratch_path(spark, "jobs-lake"))
    b = {r["table"]: r["rows"] for r in M.bronze(spark, J.source_paths(root), lake).collect()}
    assert b["timeseries"] == 10000 and b["results"] == 15000
    M.silver(spark, lake, sensors=M.SENSORS_D, scope="path", result_order=["TEST_DATE", "TEST_ID"],
             sort=False)
    g = {r["table"]: r["rows"] for r in M.gold(spark, lake, sensors=M.SENSORS_D).collect()}
    assert g["fait_test_moteur"] > 100
    J.main(["gold", "--lake", lake.root, "--sensors", ",".join(M.SENSORS_D)])   # CLI path
    audits = {r["table"]: r["rows"] for r in J.run_audits(spark, lake, M.SENSORS_D).collect()}
    assert audits["grain"] == 1 and audits["time_inversions"] == 1
    assert audits["unknown_verdicts"] == 2          # ' W' and 'g' texts of the binding
    inv = spark.read.parquet(lake.path("audit", "time_inversions")).first()
    assert inv["pairs"] == 10000 - spark.read.parquet(lake.path("silver", "timeseries_clean")) \
        .select(K.SERIAL).distinct().count()
    out = J.run_model(spark, lake, sensors=M.SENSORS_D, models=("lr", "rf"))
    assert out["leaderboard"].count() == 2
    split = spark.read.parquet(lake.path("ml", "split"))
    assert out["scored"].count() == split.where("split = 'test'").count()


def test_sensor_pairs_from_importances(spark):
    from assay.operators import kpi as KP
    imp = spark.createDataFrame([("Random Forest", "e_3", 0.5), ("Random Forest", "e_7", 0.3),
                                 ("Random Forest", "e_1", 0.2)],
                                "Model string, Feature string, Importance double")
    df = B.vectors_c(spark, SF001)
    pairs = KP.sensor_pairs_by_importance(df, imp, k=2)
    assert pairs.columns == [K.SERIAL, K.LABEL, "e_3", "e_7"]
    assert pairs.count() == df.count()


def test_bronze_partitioned_by_ingest_date_prunes(spark):
    import datetime as dt
    lake = M.Lake(scratch_path(spark, "lake-dated"))
    src = {"timeseries": os.path.join(FIXTURES, "timeseries"),
           "results": os.path.join(FIXTURES, "results")}
    M.bronze(spark, src, lake, columns={"timeseries": TS_COLS}, by_ingest_date=True)
    ts = spark.read.parquet(lake.path("bronze", "timeseries"))
    today = ts.select(F.max(M.INGEST_DATE)).first()[0]
    q = ts.where(F.col(M.INGEST_DATE) == F.lit(today))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingest_date" in plan
    assert q.count() == 34
    assert ts.where(F.col(M.INGEST_DATE) == F.lit(today - dt.timedelta(days=1))).count() == 0
    # a re-run of the same day replaces it (dynamic partition overwrite), no duplicates
    M.bronze(spark, src, lake, columns={"timeseries": TS_COLS}, by_ingest_date=True)
    assert spark.read.parquet(lake.path("bronze", "timeseries")).count() == 34


def test_second_ingestion_day_adds_new_files_only(spark, tmp_path):
    path = _text_files(tmp_path / "in", {"a.csv": "X;Y\n1;2\n"})
    first, second = (M.Lake(scratch_path(spark, f"lake-day{i}")) for i in (1, 2))
    columns = {"results": ["X", "Y"]}
    M.bronze(spark, {"results": path}, first, columns=columns, by_ingest_date=True)
    # the first load as if made a day ago
    (spark.read.parquet(first.path("bronze", "results"))
     .withColumn(M.INGEST_DATE, F.date_sub(M.INGEST_DATE, 1))
     .write.partitionBy(M.INGEST_DATE).parquet(second.path("bronze", "results")))
    with open(os.path.join(path, "b.csv"), "w", encoding="utf-8") as f:
        f.write("X;Y\n3;4\n")
    for _ in range(2):                  # a re-run of the second day changes nothing
        M.bronze(spark, {"results": path}, second, columns=columns, by_ingest_date=True)
        got = spark.read.parquet(second.path("bronze", "results"))
        assert sorted((r["X"], r["Y"]) for r in got.collect()) == [("1", "2"), ("3", "4")]
        assert got.select(M.INGEST_DATE).distinct().count() == 2


def test_command_line_bronze_checks_every_header(spark, tmp_path):
    """Columns come from the first file; another file with swapped ones is an error."""
    from assay.plans import jobs as J
    src = str(tmp_path / "src")
    _text_files(os.path.join(src, "TimeSeries"), {"a.csv": "DATE;HEURE\n1;2\n"})
    _text_files(os.path.join(src, "Results"), {"a.csv": "SERIAL_NUMBER;RESULT\ns1;G\n", "b.csv": "RESULT;SERIAL_NUMBER\nG;s2\n"})
    with pytest.raises(Exception, match="(?i)header"):
        J.main(["bronze", "--sources", src, "--lake", str(tmp_path / "lake")])


def test_malformed_lines_are_counted_per_file(spark, tmp_path):
    path = _text_files(tmp_path / "in", {"a.csv": "X;Y\n1;2\n3\n4;5;6\n", "b.csv": "X;Y\n7;8\n", "empty.csv": "X;Y\n"})
    lake = M.Lake(scratch_path(spark, "lake-malformed"))
    got = {r["table"]: r for r in M.bronze(spark, {"results": path}, lake).collect()}
    assert (got["results"]["rows"], got["results"]["files"], got["results"]["malformed"]) == (4, 3, 2)
    ledger = {os.path.basename(r["_source_file"]): (r["rows"], r["malformed"], r["header"])
              for r in spark.read.parquet(M.ledger_path(lake, "results")).collect()}
    assert ledger == {"a.csv": (3, 2, "X;Y"), "b.csv": (1, 0, "X;Y"), "empty.csv": (0, 0, "X;Y")}
    kept = spark.read.parquet(lake.path("bronze", "results"))
    assert sorted((r["X"], r["Y"], r["_malformed_line"]) for r in kept.collect() if r["_malformed_line"]) == [("3", None, "3"), ("4", "5", "4;5;6")]


def test_absent_optional_source_leaves_no_table(spark, tmp_path):
    src = {n: _text_files(tmp_path / n, {"a.csv": t}) for n, t in (
        ("timeseries", "X\n1\n"), ("results", "X\n1\n"), ("warranty", "SERIAL_NUMBER\ns1\n"))}
    lake = M.Lake(scratch_path(spark, "lake-optional"))
    assert len(M.bronze(spark, src, lake).collect()) == 3 and M.read_bronze(spark, lake, "warranty").count() == 1
    src["warranty"] = str(tmp_path / "gone")
    assert len(M.bronze(spark, src, lake).collect()) == 2 and M.read_bronze(spark, lake, "warranty") is None
    with pytest.raises(FileNotFoundError):
        M.bronze(spark, {"results": str(tmp_path / "gone")}, lake)


def _as_yesterday(spark, lake, name):
    for path in (lake.path("bronze", name), M.ledger_path(lake, name)):
        moved = spark.read.parquet(path).withColumn(M.INGEST_DATE, F.date_sub(M.INGEST_DATE, 1)).toArrow()
        spark.createDataFrame(moved).write.mode("overwrite").partitionBy(M.INGEST_DATE).parquet(path)


def test_ledger_drives_the_second_day(spark, tmp_path):
    """Day two opens new and changed files only; a changed file's newest rows count."""
    path = _text_files(tmp_path / "in", {"a.csv": "X;Y\n1;2\n", "b.csv": "X;Y\n3;4\n"})
    lake = M.Lake(scratch_path(spark, "lake-ledger"))
    load = lambda: {r["table"]: r for r in M.bronze(spark, {"results": path}, lake, by_ingest_date=True).collect()}["results"]
    assert (load()["rows"], load()["files"]) == (2, 2)
    _as_yesterday(spark, lake, "results")
    assert load()["rows"] == 0                              # nothing new
    for name, text in (("c.csv", "X;Y\n5;6\n"), ("b.csv", "X;Y\n3;4\n33;44\n")):
        with open(os.path.join(path, name), "w", encoding="utf-8") as f:
            f.write(text)
    for _ in range(2):                                      # a re-run of the day changes nothing
        got = load()
        assert (got["rows"], got["files"]) == (3, 2)
        rows = M.read_bronze(spark, lake, "results")
        assert sorted((r["X"], r["Y"]) for r in rows.collect()) == [("1", "2"), ("3", "4"), ("33", "44"), ("5", "6")]


def test_silver_is_one_write(spark):
    src = {"timeseries": os.path.join(FIXTURES, "timeseries"), "results": os.path.join(FIXTURES, "results")}
    lake = M.Lake(scratch_path(spark, "lake-one-write"))
    M.bronze(spark, src, lake, columns={"timeseries": TS_COLS})
    M.silver(spark, lake, sort=False)
    good, bad = M.read_series(spark, lake)
    assert good.count() == 31 and bad.count() == 3 and bad.where(f"{K.SERIAL} is not null").count() == 0
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_quarantined" in plan


def test_leaderboard_orders(spark):
    rows = [("a", 0.9, 0.1, 0.5), ("b", 0.8, 0.3, 0.4), ("c", 0.7, 0.2, 0.6)]
    board = spark.createDataFrame(rows, "Model string, PR_AUC double, ROC_AUC double, F1_anomaly double")
    first = lambda by: MD.choose_final(board, by).first()["Model"]
    assert [first(by) for by in MD.RANKINGS] == ["a", "b", "c"]
    with pytest.raises(ValueError):
        MD.ranked(board, "Model")


def test_overview_counts_a_unit_once_and_sweep_leaves_unscored_out(spark):
    from assay.operators import evaluate as EV
    from assay.operators import kpi as KP
    fact = spark.createDataFrame([("u", 1), ("v", 0)], f"{K.SERIAL} string, {K.LABEL} int")
    pred = spark.createDataFrame([("u", 0), ("u", 1)], f"{K.SERIAL} string, {K.FINAL_PREDICTION} int")
    r = KP.kpi_overview(fact, pred).first()
    assert (r["units_tested"], r["units_scored"], r["anomaly_rate"], r["predicted_rate"]) == (2, 1, 50.0, 100.0)
    scored = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (0, None)], f"{K.LABEL} int, {K.PROBABILITY} double")
    assert all(x["TP"] + x["FP"] + x["TN"] + x["FN"] == 2 for x in EV.threshold_sweep(scored).collect())
    assert tuple(EV.curve_areas(scored).first()) == (1.0, 1.0)


def test_exact_median_of_readings_without_a_unit(spark):
    from assay.operators import features as FE
    rows = [(None, 1.0), (None, 2.0), (None, 7.0), ("u", 5.0)]
    d = spark.createDataFrame(rows, f"{K.SERIAL} string, V double").withColumn(K.TS, F.current_timestamp()).withColumn(K.PHASE, F.lit("A"))
    got = {r[K.SERIAL]: r["V_med"] for r in FE.sequence_features(d, sensors=["V"], exact_median=True).collect()}
    assert got == {None: 2.0, "u": 5.0}


def test_forest_classes_are_counted_on_persisted_rows(spark, tmp_path, monkeypatch):
    from assay.plans import queries_ml as Q
    n = F.col("id")
    spark.range(400).select(
        n.alias("o_orderkey"), F.when(n % 4 == 0, F.lit(B.W_PRICE)).otherwise(F.lit(1.0)).alias("o_totalprice"),
        F.lit("1-URGENT").alias("o_orderpriority"), F.timestamp_seconds(n * 86400).alias("o_orderdate"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(800).select(
        (n % 400).alias("l_orderkey"), (n % 7).alias("l_partkey"), F.floor(n / 400).cast("int").alias("l_linenumber"),
        F.timestamp_seconds(n * 86400).alias("l_shipdate"), F.lit("A").alias("l_returnflag"),
        *[(n * i % 11).cast("double").alias(c) for i, c in enumerate(B.SENSORS_B, 1)],
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(K, "RF_NUM_TREES", 3)
    counted, kept = [], SP.class_weights
    monkeypatch.setattr(SP, "class_weights", lambda df, *a: counted.append((df, df.storageLevel.useMemory)) or kept(df, *a))
    model, test = Q.fit_fact_forest(spark, str(tmp_path))
    # neither count joins the tables anew, and nothing stays persisted
    assert [memory for _, memory in counted] == [True, True]
    assert not any(df.storageLevel.useMemory for df, _ in counted)
    assert model.stages[-1].getNumTrees == 3
    assert counted[0][0].count() + test.count() == 400
    # nor when a class is missing
    counted.clear()
    monkeypatch.setattr(B, "W_PRICE", 1e9)
    with pytest.raises(ValueError, match="lacks a class"):
        Q.fit_fact_forest(spark, str(tmp_path))
    assert not any(df.storageLevel.useMemory for df, _ in counted)
