"""Results must not depend on the partition layout (traps 7, 8, 17) and the
chunked (skew-safe) windows must equal their one-partition definitions."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import SF001, SF01

from assay import constants as K
from assay.operators import audit as AU
from assay.operators import evaluate as EV
from assay.operators import label as LB
from assay.operators import split as SP
from assay.operators import star as ST
from assay.plans import bindings as B


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_labels_split_dim_invariant(spark, parts):
    res = LB.label_lines(B.results_a(spark, SF001).repartition(parts))
    base = LB.label_lines(B.results_a(spark, SF001).coalesce(1))
    kw = dict(attributes=[K.STAND], order=B.A_ORDER)
    assert rows(LB.worst_label(res, **kw)) == rows(LB.worst_label(base, **kw))
    f = B.scores_e(spark, SF001)
    assert rows(SP.stratified_split(f.repartition(parts))) == rows(SP.stratified_split(f))
    items = B.items_b(spark, SF001)
    dup = items.unionByName(items.withColumn("GROUP", F.concat(F.col("GROUP"), F.lit("x"))))
    assert rows(ST.dim_product(dup.repartition(parts))) == rows(ST.dim_product(dup.coalesce(1)))


def test_split_is_stratified_and_near_80(spark):
    f = B.scores_e(spark, SF01)
    s = SP.stratified_split(f).groupBy(K.LABEL, "split").count().toPandas()
    for y in (0, 1):
        tr = s[(s[K.LABEL] == y) & (s["split"] == "train")]["count"].sum()
        tot = s[s[K.LABEL] == y]["count"].sum()
        assert 0.7 < tr / tot < 0.9


@pytest.mark.parametrize("chunks", [1, 4, 13])
def test_time_inversions_chunked_equals_bruteforce(spark, chunks):
    li = B.table(spark, SF001, "lineitem").select(
        F.col("l_orderkey").alias(K.SERIAL), F.col("l_shipdate").alias(K.TS),
        "l_linenumber", "l_partkey", "l_suppkey")
    got = AU.time_inversions(li, order=["l_linenumber", "l_partkey", "l_suppkey"],
                             chunks=chunks).first()
    pdf = li.toPandas().sort_values([K.SERIAL, "l_linenumber", "l_partkey", "l_suppkey"])
    prev = pdf.groupby(K.SERIAL)[K.TS].shift(1)
    assert got["pairs"] == int(prev.notna().sum())
    assert got["inversions"] == int((pdf[K.TS] < prev).sum())


@pytest.mark.parametrize("chunks", [1, 5])
def test_curves_equal_evaluator_exact(spark, chunks):
    sc = B.scores_e(spark, SF01)
    pdf = sc.toPandas()
    vec = spark.createDataFrame(
        [(float(r[K.LABEL]), Vectors.dense([1 - r[K.PROBABILITY], r[K.PROBABILITY]]))
         for r in pdf.itertuples(index=False) for r in [r._asdict()]],
        ["label", "raw"])
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="raw", numBins=0)
    roc = EV.roc_auc(sc, chunks=chunks).first()["roc_auc"]
    pr = EV.pr_auc(sc, chunks=chunks).first()["pr_auc"]
    assert roc == pytest.approx(ev.evaluate(vec, {ev.metricName: "areaUnderROC"}), abs=1e-12)
    assert pr == pytest.approx(ev.evaluate(vec, {ev.metricName: "areaUnderPR"}), abs=1e-12)
    assert round(roc, 6) == 0.667019 and round(pr, 6) == 0.269791


def test_sweep_matches_published_binding_figures(spark):
    sw = {r["Threshold"]: r for r in EV.threshold_sweep(B.scores_e(spark, SF01)).collect()}
    assert tuple(sw[0.5][c] for c in ("TP", "FP", "TN", "FN")) == (190, 578, 652, 80)
    assert tuple(sw[0.45][c] for c in ("TP", "FP", "TN", "FN")) == (237, 838, 392, 33)
    assert tuple(sw[0.4][c] for c in ("TP", "FP", "TN", "FN")) == (264, 1026, 204, 6)


@pytest.mark.parametrize("accuracy", [100, 10000])
def test_exact_medians_equal_percentile_disc(spark, accuracy):
    """Short series, a unit with most of the readings, ties, no unit, no values."""
    from assay.operators.features import exact_medians
    hot = spark.range(40_000).select(F.when(F.col("id") % 9 == 0, F.lit(None)).otherwise(F.lit(-1)).cast("long").alias(K.SERIAL),
                                     *[F.when(F.col("id") % 5 == 0, F.lit(7.0)).otherwise(F.rand(i) * 10).alias(c) for i, c in enumerate(B.SENSORS_B)])
    none = spark.range(3).select(F.lit(-2).cast("long").alias(K.SERIAL), F.lit(None).cast("double").alias("a"),
                                 *[F.lit(1.0).alias(c) for c in "bcd"]).toDF(K.SERIAL, *B.SENSORS_B)
    ser = B.series_b(spark, SF001).select(K.SERIAL, *B.SENSORS_B).unionByName(hot).unionByName(none).repartition(6).cache()
    got = {r[K.SERIAL]: r for r in exact_medians(ser, K.SERIAL, B.SENSORS_B, accuracy).collect()}
    want = ser.groupBy(K.SERIAL).agg(*[
        F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {c})").alias(f"{c}_med")
        for c in B.SENSORS_B]).collect()
    assert len(got) == len(want)
    for r in want:
        for c in B.SENSORS_B:
            assert got[r[K.SERIAL]][f"{c}_med"] == r[f"{c}_med"], (r[K.SERIAL], c)


def test_exact_split_for_rare_class(spark):
    f = B.scores_e(spark, SF01)
    s = SP.stratified_split_exact(f.select(K.SERIAL, K.LABEL)).toPandas()
    pos = s[s[K.LABEL] == 1]
    assert (pos["split"] == "train").sum() == int(len(pos) * 0.8)
    assert len(s) == f.count()
    again = SP.stratified_split_exact(f.select(K.SERIAL, K.LABEL).repartition(5)).toPandas()
    assert sorted(map(tuple, s.values)) == sorted(map(tuple, again.values))
    # one chunk or thousands: the same rank
    for bits in (0, 3, 20):
        cut = SP.stratified_split_exact(f.select(K.SERIAL, K.LABEL), chunk_bits=bits).toPandas()
        assert sorted(map(tuple, s.values)) == sorted(map(tuple, cut.values))


def test_plot_sample_holds_both_sides_of_the_split(spark):
    from assay.operators import kpi as KP
    f = SP.stratified_split(B.scores_e(spark, SF01))
    drawn = KP.sensor_pairs(f, ["split"], fraction=0.3).toPandas()
    assert 0.2 < len(drawn) / f.count() < 0.4 and set(drawn["split"]) == {"train", "test"}


def test_several_predictions_do_not_multiply_units(spark):
    from assay.operators import star as ST
    f = spark.createDataFrame([("u", "p")], f"{K.SERIAL} string, {K.PRODUCT} string")
    d = spark.createDataFrame([("p", "g")], f"{K.PRODUCT} string, GROUP string")
    p = spark.createDataFrame([("u", 0.2, 0), ("u", 0.7, 1)], f"{K.SERIAL} string, {K.PROBABILITY} double, {K.FINAL_PREDICTION} int")
    assert [r[K.PROBABILITY] for r in ST.star_join(d, f, p).collect()] == [0.7]


def test_curve_areas_agree_with_single_metrics(spark):
    sc = B.scores_e(spark, SF001)
    both = EV.curve_areas(sc, chunks=3).first()
    assert both["roc_auc"] == pytest.approx(EV.roc_auc(sc, chunks=4).first()["roc_auc"], abs=1e-12)
    assert both["pr_auc"] == pytest.approx(EV.pr_auc(sc, chunks=1).first()["pr_auc"], abs=1e-12)
