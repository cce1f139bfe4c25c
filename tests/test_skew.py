"""A unit holding a third of all rows: results stay exact and no operator
gathers that unit into one task."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01

from assay import constants as K
from assay.operators import audit as AU
from assay.operators import features as FE
from assay.operators import label as LB
from assay.plans import bindings as B

HOT = -1


@pytest.fixture(scope="module")
def skewed(spark):
    li = B.table(spark, SF01, "lineitem")
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(HOT)).otherwise(F.col("l_orderkey"))
    return li.select(key.alias(K.SERIAL), F.col("l_shipdate").alias(K.TS),
                     F.col("l_returnflag").alias(K.PHASE), "l_quantity", "l_extendedprice",
                     "l_linenumber", "l_partkey", "l_suppkey", "l_orderkey").repartition(8)


def test_hot_unit_is_a_third(skewed):
    n = skewed.count()
    hot = skewed.where(F.col(K.SERIAL) == HOT).count()
    assert hot * 3 > n * 0.95


def test_features_plan_combines_map_side(skewed):
    f = FE.sequence_features(skewed, sensors=["l_quantity", "l_extendedprice"])
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "partial_percentile_approx" in plan and "partial_avg" in plan
    assert "partial_collect_set" in plan


def test_hot_unit_features_exact(skewed):
    f = FE.sequence_features(skewed, sensors=["l_quantity"], exact_median=True)
    got = f.where(F.col(K.SERIAL) == HOT).first()
    pdf = skewed.where(F.col(K.SERIAL) == HOT).select("l_quantity", K.PHASE).toPandas()
    q = pdf["l_quantity"].sort_values().reset_index(drop=True)
    assert got["l_quantity_mean"] == pytest.approx(q.mean())
    assert got["l_quantity_std"] == pytest.approx(q.std(ddof=1))
    assert got["l_quantity_med"] == q[(len(q) - 1) // 2]
    assert got[K.LEAK_COUNT] == len(q) and got[K.LEAK_PHASES] == pdf[K.PHASE].nunique()
    approx = FE.sequence_features(skewed, sensors=["l_quantity"]).where(
        F.col(K.SERIAL) == HOT).first()["l_quantity_med"]
    # rank guarantee of percentile_approx (ties: any rank of the tied run counts)
    lo, hi, eps = int((q < approx).sum()), int((q <= approx).sum()), len(q) / 10000 + 1
    assert lo - eps <= len(q) / 2 <= hi + eps


def test_time_inversions_hot_unit_spans_chunks(spark, skewed):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    got = AU.time_inversions(skewed, order=order, chunks=16).first()
    pdf = skewed.select(K.SERIAL, K.TS, *order).toPandas().sort_values([K.SERIAL, *order])
    prev = pdf.groupby(K.SERIAL)[K.TS].shift(1)
    assert got["pairs"] == int(prev.notna().sum())
    assert got["inversions"] == int((pdf[K.TS] < prev).sum())
    # range partitioning on the same keys spreads the hot unit as well
    chunks = (skewed.select(K.SERIAL, K.TS, *order)
              .repartitionByRange(16, F.col(K.SERIAL), *[F.col(c) for c in order])
              .withColumn("_c", F.spark_partition_id())
              .where(F.col(K.SERIAL) == HOT).select("_c").distinct().count())
    assert chunks >= 4


def test_worst_label_hot_unit(spark):
    o = B.results_a(spark, SF01)
    key = F.when(F.col("TEST_ID") % 3 == 0, F.lit(HOT)).otherwise(F.col(K.SERIAL))
    lines = LB.label_lines(o.withColumn(K.SERIAL, key))
    lab = LB.worst_label(lines, attributes=[K.STAND], order=B.A_ORDER)
    r = lab.where(F.col(K.SERIAL) == HOT).first()
    pdf = lines.where(F.col(K.SERIAL) == HOT).toPandas().sort_values(B.A_ORDER)
    assert r["nb_tests"] == len(pdf) and r[K.LABEL] == pdf["LAB"].max()
    assert r[K.STAND] == pdf[K.STAND].iloc[0]
