"""Golden tests on the hand-made source folders (FIXTURES.md §2): one per
trap of the reference's semantics."""

import math
import os

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES

from assay import constants as K
from assay.functions.scalar import to_double
from assay.operators import audit as AU
from assay.operators import clean as CL
from assay.operators import evaluate as EV
from assay.operators import features as FE
from assay.operators import label as LB
from assay.operators import star as ST
from assay.sources.delimited import SOURCE_FILE, SOURCE_NAME, read_delimited

TS_COLS = [K.DATE, K.TIME, K.PHASE, *K.SENSORS[:10], "SENSOR_3", *K.SENSORS[10:]]
HEX_NORMAL = "0123456789abcdef0123456789abcdef"
HEX_SINGLE = "1" * 32


@pytest.fixture(scope="module")
def bronze_ts(spark):
    return read_delimited(spark, os.path.join(FIXTURES, "timeseries"), columns=TS_COLS,
                          recursive=True)


@pytest.fixture(scope="module")
def silver_ts(bronze_ts):
    return CL.clean_measurements(bronze_ts)


@pytest.fixture(scope="module")
def results(spark):
    return read_delimited(spark, os.path.join(FIXTURES, "results"), recursive=True)


def by_serial(df, key=K.SERIAL):
    return {r[key]: r for r in df.collect()}


def test_bronze_all_strings_with_lineage(bronze_ts):
    assert all(f.dataType.simpleString() == "string" for f in bronze_ts.schema.fields
               if not f.name.startswith("_"))
    names = {r[SOURCE_NAME] for r in bronze_ts.select(SOURCE_NAME).distinct().collect()}
    assert len(names) == 9
    assert bronze_ts.count() == 5 + 1 + 3 + 3 + 3 + 6 + 5 + 4 + 4


def test_serial_from_file_name_not_folder(silver_ts):
    serials = {r[K.SERIAL] for r in silver_ts.select(K.SERIAL).distinct().collect()}
    assert "b" * 32 in serials            # file inside a 32-hex folder
    assert "f" * 32 not in serials        # ... the folder does not leak in
    assert "c" * 32 in serials            # folder name with a space
    assert None in serials                # file without a serial


def test_whole_path_scope_takes_first_hex(spark):
    from assay.functions.scalar import serial_from_path
    df = spark.createDataFrame([("/x/" + "f" * 32 + "/TimeSeries_1_" + "b" * 32 + ".csv",),
                                ("/x/TimeSeries_nohex.csv",)], ["p"])
    got = df.select(serial_from_path("p", "path").alias("w"),
                    serial_from_path("p", "name").alias("n")).collect()
    assert got[0]["w"] == "f" * 32 and got[0]["n"] == "b" * 32
    assert got[1]["w"] is None and got[1]["n"] is None   # '' becomes NULL


def test_quarantine_bad_name(silver_ts):
    good, bad = CL.split_quarantine(silver_ts)
    assert bad.count() == 3
    assert good.where(F.col(K.SERIAL).isNull()).count() == 0


def test_space_in_path_lineage(bronze_ts):
    row = bronze_ts.where(F.col(SOURCE_NAME).contains("c" * 32)).select(SOURCE_FILE).first()
    assert "Test" in row[SOURCE_FILE] and "Bench" in row[SOURCE_FILE]


def test_features_by_hand(silver_ts):
    f = by_serial(FE.sequence_features(silver_ts))
    r = f[HEX_NORMAL]
    assert r["PR_1_mean"] == pytest.approx(4.0)
    assert r["PR_1_std"] == pytest.approx(math.sqrt(12.5))
    assert (r["PR_1_min"], r["PR_1_max"], r["PR_1_med"]) == (1.0, 10.0, 3.0)
    assert r[K.LEAK_COUNT] == 5 and r[K.LEAK_PHASES] == 3 and r[K.LEAK_DURATION] == 40
    one = f[HEX_SINGLE]
    assert one["PR_1_std"] is None and one[K.LEAK_DURATION] == 0
    assert "SENSOR_3_mean" not in f[HEX_NORMAL].asDict()


def test_exact_median_option(silver_ts):
    f = by_serial(FE.sequence_features(silver_ts, exact_median=True))
    assert f[HEX_NORMAL]["PR_1_med"] == 3.0


def test_null_phase_not_counted(silver_ts):
    f = by_serial(FE.sequence_features(silver_ts))
    assert f["2" * 32][K.LEAK_PHASES] == 2


def test_dirty_values_become_null_and_are_counted(bronze_ts, silver_ts):
    dirty = silver_ts.where(F.col(K.SERIAL) == "d" * 32)
    vals = sorted((r["PR_1"] for r in dirty.collect()), key=lambda v: (v is None, v))
    assert vals == [7.0, 8.0, 9.0, None, None, None]
    assert dirty.where(F.col(K.TS).isNull()).count() == 2    # wrong format, missing DATE
    joined = bronze_ts.where(F.col(SOURCE_NAME).contains("d" * 32)).select(
        "PR_1", "DATE", "HEURE",
        to_double("PR_1").alias("PR_1_num"))
    pf = {r["column"]: r for r in AU.parse_failures(joined, {"PR_1_num": "PR_1"}).collect()}
    assert pf["PR_1_num"]["non_null_input"] == 5 and pf["PR_1_num"]["failed"] == 2


def test_time_inversions_strict(spark, bronze_ts):
    from assay.sources.delimited import ARRIVAL
    ordered = CL.clean_measurements(bronze_ts, keep_arrival=True) \
        .where(F.col(K.SERIAL) == "e" * 32)
    for chunks in (1, 3):
        r = AU.time_inversions(ordered, order=ARRIVAL, chunks=chunks).first()
        assert (r["pairs"], r["inversions"]) == (4, 1)
    # over every file: only the inverted one contributes
    good, _ = CL.split_quarantine(CL.clean_measurements(bronze_ts, keep_arrival=True))
    r = AU.time_inversions(good, order=ARRIVAL).first()
    assert r["inversions"] == 1


def test_constant_columns(silver_ts):
    const = silver_ts.where(F.col(K.SERIAL) == "abcdef" * 5 + "ab")
    got = {r["column"]: r for r in AU.constant_columns(const, ["PR_1", "PR_2", "PR_3"]).collect()}
    assert got["PR_2"]["is_constant"] and got["PR_2"]["min"] == 0.0
    assert got["PR_3"]["is_constant"] and got["PR_3"]["nulls"] == 4
    assert not got["PR_1"]["is_constant"]


def test_worst_label_rules(results):
    lines = CL.clean_results(results)
    lab = by_serial(LB.worst_label(lines, order=["TEST_DATE"]))
    assert [lab[s][K.LABEL] for s in ["S1", "S2", "S3", "S4"]] == [1, 1, 0, 1]
    assert [lab[s][K.LABEL] for s in ["S5", "S6", "S7", "S8"]] == [0, 0, 0, 0]
    assert lab["S1"]["nb_tests"] == 2 and lab["S1"][K.STAND] == "B1"   # first test's stand
    assert lab["S9"]["nb_tests"] == 2 and "S10" in lab                    # trimmed ids


def test_unknown_verdicts_reported(results):
    got = {r["verdict"]: r["count"] for r in AU.unknown_verdicts(results).collect()}
    assert got == {None: 1, " W": 1, "w": 1, "X": 1}


def test_contradictions(results):
    r = AU.contradictory_results(CL.clean_results(results)).first()
    assert (r["retested"], r["contradictory"]) == (4, 2)   # S1 S2 S3 S9; S1 S2


def test_key_overlap_and_unmatched(spark, silver_ts, results):
    good, _ = CL.split_quarantine(silver_ts)
    lab = LB.worst_label(CL.clean_results(results))
    ov = ST.key_overlap(good, lab).first()
    assert ov["both"] == 2 and ov["left_only"] == 6 and ov["right_only"] == 10
    un = ST.unmatched_keys(good, lab)
    assert un.count() == 16
    war = CL.clean_warranty(read_delimited(spark, os.path.join(FIXTURES, "warranty")))
    assert ST.key_overlap(war, lab).first()["both"] == 0


def test_fact_is_inner_join(silver_ts, results):
    good, _ = CL.split_quarantine(silver_ts)
    fact = ST.fact_table(FE.sequence_features(good), LB.worst_label(CL.clean_results(results)))
    assert {r[K.SERIAL] for r in fact.collect()} == {HEX_NORMAL, HEX_SINGLE}
    assert AU.grain_check(fact).first()["one_row_per_key"]


def test_dimension_dedup_and_optional_columns(spark):
    items = CL.trim_all(read_delimited(spark, os.path.join(FIXTURES, "items_dup"), lineage=True))
    dim = by_serial(ST.dim_product(items), K.PRODUCT)
    assert dim["P1"]["GROUP"] == "G1" and dim["P1"]["STATUS"] == "old"   # deterministic winner
    assert dim["P2"]["GROUP"] == "G3"                                   # trimmed
    assert not any(c.startswith("_") for c in ST.dim_product(items).columns)
    partial = spark.createDataFrame([("P9", None, "N1"), ("P9", "G9", "N2"), ("P9", "G9", None)],
                                    "PRODUCT_NUMBER string, GROUP string, NATURE string")
    assert ST.dim_product(partial).first()["NATURE"] == "N2"      # the complete row wins
    items2 = read_delimited(spark, os.path.join(FIXTURES, "items_nostatus"))
    assert ST.dim_product(items2).columns == [K.PRODUCT, "GROUP", "NATURE", "MODEL"]


def test_scores_small(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.5), (0, 0.4), (0, 0.3), (1, 0.3), (0, 0.1),
            (0, 0.05), (0, 0.0)]
    df = spark.createDataFrame(rows, [K.LABEL, K.PROBABILITY])
    sweep = {r["Threshold"]: r for r in EV.threshold_sweep(df, thresholds=[0.95, 0.5, 0.05])
             .collect()}
    assert (sweep[0.95]["TP"], sweep[0.95]["FP"], sweep[0.95]["Precision"]) == (0, 0, 0.0)
    assert sweep[0.95]["F1"] == 0.0
    assert (sweep[0.5]["TP"], sweep[0.5]["FP"]) == (2, 2)           # 0.5 itself counts
    assert (sweep[0.05]["TP"], sweep[0.05]["FP"], sweep[0.05]["TN"]) == (3, 6, 1)


def test_published_confusion_identities(spark):
    rows = [(1, 1)] * 3 + [(0, 1)] * 11 + [(0, 0)] * 214 + [(1, 0)] * 3
    df = spark.createDataFrame(rows, [K.LABEL, K.FINAL_PREDICTION])
    m = EV.anomaly_metrics(df).first()
    assert (m["TP"], m["FP"], m["TN"], m["FN"]) == (3, 11, 214, 3)
    assert round(m["Precision"] * 100, 2) == 21.43
    assert m["Recall"] == 0.5 and round(m["F1"], 4) == 0.3
    out = {r[K.OUTCOME]: r["count"] for r in
           EV.outcome_counts(EV.with_outcome(df)).collect()}
    assert out == {K.OUTCOME_TP: 3, K.OUTCOME_FP: 11, K.OUTCOME_TN: 214, K.OUTCOME_FN: 3}


def test_bus_records_equal_file_source(spark, bronze_ts):
    """Messages (key = test file name, value = one ';' line) parse into the
    same bronze rows, so silver and features are identical to the file path."""
    from assay.streaming.bus import parse_bus_records
    rows = bronze_ts.select(SOURCE_NAME, *TS_COLS).collect()
    msgs = [(r[SOURCE_NAME].encode(),
             ";".join("" if r[c] is None else r[c] for c in TS_COLS).encode(),
             "bench", 0, i, None) for i, r in enumerate(rows)]
    records = spark.createDataFrame(
        msgs, "key binary, value binary, topic string, partition int, offset long, "
              "timestamp timestamp")
    bus = parse_bus_records(records, TS_COLS)
    f_bus = {r[K.SERIAL]: r for r in FE.sequence_features(
        CL.clean_measurements(bus)).collect()}
    f_file = {r[K.SERIAL]: r for r in FE.sequence_features(
        CL.clean_measurements(bronze_ts)).collect()}
    assert f_bus.keys() == f_file.keys()
    for k in f_file:
        assert f_bus[k].asDict() == f_file[k].asDict()


def test_preview_and_display_rounding(spark, results):
    lab = LB.worst_label(CL.clean_results(results))
    head = AU.preview(lab, 3).collect()
    assert [r[K.SERIAL] for r in head] == sorted(r[K.SERIAL] for r in lab.collect())[:3]
    plan = AU.preview(lab, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    pct = {r[K.LABEL]: r["percentage"] for r in LB.label_distribution(lab, digits=2).collect()}
    assert pct == {0: 58.33, 1: 41.67}
