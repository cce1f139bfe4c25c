"""Queries over bindings A and B: labels, features, star schema, key audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay import constants as K
from assay.operators import clean as CL
from assay.operators import features as FE
from assay.operators import label as LB
from assay.operators import star as ST
from assay.plans import bindings as B
from assay.plans import sqltext as S
from assay.plans.catalog import query


# ------------------------------------------------------------ shared builders
def labels_a(spark: SparkSession, d: str) -> DataFrame:
    return LB.worst_label(LB.label_lines(B.results_a(spark, d)),
                          attributes=[K.STAND], order=B.A_ORDER)


def labels_b(spark: SparkSession, d: str) -> DataFrame:
    return LB.worst_label(LB.label_lines(B.results_b(spark, d)),
                          attributes=[K.PRODUCT, K.STAND], order=["TEST_DATE", K.SERIAL])


def features_a(spark: SparkSession, d: str) -> DataFrame:
    return FE.sequence_features(B.series_a(spark, d), sensors=B.SENSORS_A)


def features_b(spark: SparkSession, d: str) -> DataFrame:
    return FE.sequence_features(B.series_b(spark, d), sensors=B.SENSORS_B)


def fact_b(spark: SparkSession, d: str) -> DataFrame:
    return ST.fact_table(features_b(spark, d), labels_b(spark, d))


def fact_a(spark: SparkSession, d: str) -> DataFrame:
    return ST.fact_table(features_a(spark, d), labels_a(spark, d))


def dim_b(spark: SparkSession, d: str) -> DataFrame:
    """The partial catalogue of the coverage reports."""
    return ST.dim_product(B.items_b(spark, d))


def dim_all_b(spark: SparkSession, d: str) -> DataFrame:
    return ST.dim_product(CL.trim_all(B.catalogue_b(spark, d)))


# ------------------------------------------------------------ labels
@query("worst_label", S.LABELS_A)
def q_worst_label(spark, d):
    """AG1-AG3: worst verdict, number of tests, first test's stand per unit."""
    return labels_a(spark, d)


# ------------------------------------------------------------ features
@query("sequence_features", S.FEATURES_A)
def q_sequence_features(spark, d):
    """AG4-AG11: 5 statistics per sensor + 3 test-run columns, one aggregation."""
    return features_a(spark, d)


@query("sequence_features_wide", S.FEATURES_B)
def q_sequence_features_wide(spark, d):
    """AG8 on binding B: 4 sensors, ~15k units."""
    return features_b(spark, d)


# ------------------------------------------------------------ star schema
@query("fact_test", S.FACT_B)
def q_fact_test(spark, d):
    """JO1: features ⋈ labels (inner), binding B."""
    return fact_b(spark, d)


@query("fact_test_devices", S.FACT_A)
def q_fact_test_devices(spark, d):
    """JO1 on binding A."""
    return fact_a(spark, d)


@query("sequence_features_exact", S.FEATURES_B)
def q_sequence_features_exact(spark, d):
    """AG7 exact: lower median per unit by chunked running counts (skew-safe)."""
    return FE.sequence_features(B.series_b(spark, d), sensors=B.SENSORS_B, exact_median=True)


@query("worst_label_pair", f"""
SELECT SERIAL_NUMBER, max(LAB) AS LABEL, count(*) AS nb_tests,
       arg_min(PRODUCT_NUMBER, (PRODUCT_NUMBER, TEST_STAND)) AS PRODUCT_NUMBER,
       arg_min(TEST_STAND, (PRODUCT_NUMBER, TEST_STAND)) AS TEST_STAND
FROM (SELECT o_custkey AS SERIAL_NUMBER, o_orderpriority AS PRODUCT_NUMBER, o_orderstatus AS TEST_STAND,
             CASE WHEN o_totalprice >= {B.W_PRICE} THEN 1 ELSE 0 END AS LAB FROM orders) t
GROUP BY SERIAL_NUMBER""")
def q_worst_label_pair(spark, d):
    """AG3 without an order: product and stand come from one and the same test."""
    o = B.table(spark, d, "orders")
    lines = o.select(F.col("o_custkey").alias(K.SERIAL), F.col("o_orderpriority").alias(K.PRODUCT),
                     F.col("o_orderstatus").alias(K.STAND),
                     F.when(F.col("o_totalprice") >= B.W_PRICE, 1).otherwise(0).alias("LAB"))
    return LB.worst_label(lines, attributes=(K.PRODUCT, K.STAND))
