"""Queries: star schema, key audits and data-quality audits (bindings A, B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay import constants as K
from assay.operators import audit as AU
from assay.operators import features as FE
from assay.operators import kpi as KP
from assay.operators import label as LB
from assay.operators import split as SP
from assay.operators import star as ST
from assay.operators.evaluate import positive_rate
from assay.plans import bindings as B
from assay.plans import sqltext as S
from assay.plans.catalog import query
from assay.plans.queries_core import dim_all_b, dim_b, fact_a, fact_b, labels_a, labels_b

FEATS_B = FE.feature_names(B.SENSORS_B)
FEATS_A = FE.feature_names(B.SENSORS_A)
FACT_B_COLS = ["SERIAL_NUMBER", *FEATS_B, *K.LEAK_COLUMNS, "LABEL", "PRODUCT_NUMBER",
               "TEST_STAND"]
SELECTED_B = ["l_quantity_mean", "l_quantity_std", "l_quantity_min", "l_quantity_max",
              "l_extendedprice_mean", "l_extendedprice_std", "l_discount_mean",
              "l_discount_max"]
SPLIT_SQL = ("CAST(('0x' || substr(md5(CAST(SERIAL_NUMBER AS VARCHAR) || ':42'), 1, 8)) "
             "AS BIGINT) % 1000")


@query("dim_product", S.DIM_ALL_B)
def q_dim_product(spark, d):
    """PR2 + SO5: key + the attributes present, one deterministic row per key."""
    return dim_all_b(spark, d)


@query("dataset_ml", f"""
SELECT f.*, d."GROUP", d.NATURE, d.MODEL
FROM ({S.FACT_B}) f LEFT JOIN ({S.DIM_ALL_B}) d ON f.PRODUCT_NUMBER = d.PRODUCT_NUMBER""")
def q_dataset_ml(spark, d):
    """JO2: fact ⟕ product dimension (flat ML dataset)."""
    return ST.dataset_ml(fact_b(spark, d), dim_all_b(spark, d))


@query("sql_fact_scan", S.FACT_B)
def q_sql_fact_scan(spark, d):
    """IO11: the fact table read back through SQL from a registered view."""
    fact_b(spark, d).createOrReplaceTempView("gold_fait_test_moteur")
    return spark.sql("SELECT * FROM gold_fait_test_moteur")


@query("catalogue_coverage", S.rounded(f"""
WITH u AS (SELECT DISTINCT PRODUCT_NUMBER FROM ({S.FACT_B}) f WHERE PRODUCT_NUMBER IS NOT NULL),
     k AS (SELECT DISTINCT PRODUCT_NUMBER FROM ({S.DIM_B}) d)
SELECT count(*) AS products_tested, count(k.PRODUCT_NUMBER) AS products_covered,
       coalesce(CAST(count(k.PRODUCT_NUMBER) AS DOUBLE) / nullif(count(*), 0), 0.0) AS coverage
FROM u LEFT JOIN k ON u.PRODUCT_NUMBER = k.PRODUCT_NUMBER""", ["coverage"]))
def q_catalogue_coverage(spark, d):
    """JO4 / BI8: products tested, covered by the catalogue, coverage."""
    return ST.catalogue_coverage(fact_b(spark, d), dim_b(spark, d))


@query("unmatched_serials", """
SELECT DISTINCT l.l_orderkey AS SERIAL_NUMBER, 'series_without_result' AS side FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL
SELECT DISTINCT o.o_orderkey, 'result_without_series' FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def q_unmatched_serials(spark, d):
    """JO5: keys lost on either side of the inner fact join."""
    return ST.unmatched_keys(B.series_b(spark, d), labels_b(spark, d))


@query("key_overlap", """
WITH s AS (SELECT DISTINCT user_id AS k FROM events WHERE user_id IS NOT NULL),
     r AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey IS NOT NULL)
SELECT count(*) FILTER (WHERE r.k IS NULL) AS left_only,
       count(*) FILTER (WHERE s.k IS NOT NULL AND r.k IS NOT NULL) AS both,
       count(*) FILTER (WHERE s.k IS NULL) AS right_only
FROM s FULL OUTER JOIN r ON s.k = r.k""")
def q_key_overlap(spark, d):
    """JO3 / QA8: series keys vs result keys: left-only, both, right-only."""
    return ST.key_overlap(B.series_a(spark, d), B.results_a(spark, d))


@query("grain_check", f"""
SELECT count(*) AS total_rows, count(DISTINCT SERIAL_NUMBER) AS unique_keys,
       count(*) = count(DISTINCT SERIAL_NUMBER) AS one_row_per_key
FROM ({S.FACT_B}) f""")
def q_grain_check(spark, d):
    """QA1 / AG12 / ST2: one row per unit in the fact."""
    return AU.grain_check(fact_b(spark, d))


@query("positive_rate", S.rounded(f"""
SELECT count(*) AS units, count(*) FILTER (WHERE LABEL = 1) AS positives,
       coalesce(count(*) FILTER (WHERE LABEL = 1) * 100.0 / nullif(count(*), 0), 0.0)
         AS positive_rate
FROM ({S.FACT_B}) f""", ["positive_rate"]))
def q_positive_rate(spark, d):
    """AG20 / FI2: positives in the fact and their share."""
    return positive_rate(fact_b(spark, d))


@query("ml_frame", f"""
SELECT SERIAL_NUMBER, LABEL, {", ".join(FEATS_B)} FROM ({S.FACT_B}) f""")
def q_ml_frame(spark, d):
    """PR4-PR6: id + label + features chosen by inclusion, checked numeric."""
    return FE.ml_frame(fact_b(spark, d), B.SENSORS_B)


@query("null_audit", f"""
SELECT {", ".join(f'count(*) FILTER (WHERE {S.q(c)} IS NULL) AS {S.q(c)}' for c in FACT_B_COLS)}
FROM ({S.FACT_B}) f""")
def q_null_audit(spark, d):
    """AG14 / QA2: NULLs per fact column (one-row series leave std NULL)."""
    return AU.null_audit(fact_b(spark, d))


def _describe_sql() -> str:
    parts = []
    for stat, fn in [("count", "count({})"), ("mean", "avg({})"), ("stddev", "stddev_samp({})"),
                     ("min", "min({})"), ("max", "max({})")]:
        cols = ", ".join(f"CAST({fn.format(c)} AS DOUBLE) AS {c}" for c in FEATS_B)
        parts.append(f"SELECT '{stat}' AS summary, {cols} FROM ({S.FACT_B_RAW}) f")
    return S.rounded(" UNION ALL ".join(parts), FEATS_B)


@query("describe_features", _describe_sql())
def q_describe_features(spark, d):
    """AG15: count / mean / stddev / min / max of every feature, one pass."""
    return AU.describe_numeric(fact_b(spark, d), FEATS_B)


@query("label_means", S.rounded(f"""
SELECT LABEL, {", ".join(f"avg({c}) AS {c}" for c in SELECTED_B)}
FROM ({S.FACT_B_RAW}) f GROUP BY LABEL""", SELECTED_B))
def q_label_means(spark, d):
    """AG16: selected feature means per label."""
    return AU.label_means(fact_b(spark, d), SELECTED_B)


def _constant_sql() -> str:
    parts = [f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS "min",
      CAST(max({c}) AS DOUBLE) AS "max", count(*) FILTER (WHERE {c} IS NULL) AS nulls,
      coalesce(min({c}) = max({c}), true) AS is_constant FROM lineitem""" for c in B.SENSORS_B]
    return S.rounded(" UNION ALL ".join(parts), ["min", "max"])


@query("constant_columns", _constant_sql())
def q_constant_columns(spark, d):
    """QA4: constant-column detection over the raw sensors."""
    return AU.constant_columns(B.series_b(spark, d), B.SENSORS_B)


@query("time_inversions", S.rounded("""
WITH s AS (SELECT l_shipdate AS ts, lag(l_shipdate) OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey) AS prev FROM lineitem)
SELECT count(prev) AS pairs, count(*) FILTER (WHERE ts < prev) AS inversions,
       coalesce(CAST(count(*) FILTER (WHERE ts < prev) AS DOUBLE) / nullif(count(prev), 0), 0.0)
         AS share
FROM s""", ["share"]))
def q_time_inversions(spark, d):
    """QA6: share of consecutive readings going back in time (skew-safe lag)."""
    li = B.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias(K.SERIAL), F.col("l_shipdate").alias(K.TS),
        "l_linenumber", "l_partkey", "l_suppkey")
    return AU.time_inversions(li, order=["l_linenumber", "l_partkey", "l_suppkey"])


@query("sequence_variability", S.rounded(f"""
WITH m AS (SELECT SERIAL_NUMBER, avg("VALUE") AS v, avg("K") AS k FROM ({S.SERIES_A_SQL}) s
           GROUP BY SERIAL_NUMBER)
SELECT 'VALUE' AS sensor, stddev_samp(v) / nullif(abs(avg(v)), 0) AS variability FROM m
UNION ALL
SELECT 'K', stddev_samp(k) / nullif(abs(avg(k)), 0) FROM m""", ["variability"]))
def q_sequence_variability(spark, d):
    """QA7: coefficient of variation of per-unit sensor means."""
    return AU.sequence_variability(B.series_a(spark, d), B.SENSORS_A)


@query("parse_failures", """
SELECT 'K_parsed' AS "column", count(props) AS non_null_input,
       count(*) FILTER (WHERE props IS NOT NULL AND TRY_CAST(props->>'$.k' AS DOUBLE) IS NULL)
         AS failed FROM events
UNION ALL
SELECT 'VALUE_parsed', count(value), 0 FROM events""")
def q_parse_failures(spark, d):
    """QA9: non-NULL inputs that did not parse."""
    ev = B.table(spark, d, "events").select(
        "props", "value",
        F.get_json_object("props", "$.k").try_cast("double").alias("K_parsed"),
        F.col("value").try_cast("double").alias("VALUE_parsed"))
    return AU.parse_failures(ev, {"K_parsed": "props", "VALUE_parsed": "value"})


@query("label_distribution", S.rounded(f"""
SELECT LABEL, count(*) AS count, count(*) * 100.0 / sum(count(*)) OVER () AS percentage
FROM ({S.LABELS_A}) l GROUP BY LABEL""", ["percentage"]))
def q_label_distribution(spark, d):
    """AG13 / SC10: units per label and share."""
    return LB.label_distribution(labels_a(spark, d))


@query("contradictory_results", f"""
WITH p AS (SELECT o_custkey, count(*) AS n, min({S.VERDICT_SQL}) AS lo, max({S.VERDICT_SQL}) AS hi
           FROM orders GROUP BY o_custkey)
SELECT count(*) AS units, count(*) FILTER (WHERE hi = 1) AS positives,
       count(*) FILTER (WHERE n > 1) AS retested,
       count(*) FILTER (WHERE lo <> hi) AS contradictory FROM p""")
def q_contradictory_results(spark, d):
    """QA5: re-tested units and units whose tests disagree."""
    return AU.contradictory_results(LB.label_lines(B.results_a(spark, d)))


@query("layer_row_counts", f"""
SELECT 'series' AS "table", count(*) AS rows, count(DISTINCT user_id) AS units FROM events
UNION ALL SELECT 'results', count(*), count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'labels', count(*), count(DISTINCT SERIAL_NUMBER) FROM ({S.LABELS_A}) l
UNION ALL SELECT 'fact', count(*), count(DISTINCT SERIAL_NUMBER) FROM ({S.FACT_A}) f""")
def q_layer_row_counts(spark, d):
    """IO15: rows and units per layer table, one union of aggregates."""
    return AU.layer_counts({"series": B.series_a(spark, d), "results": B.results_a(spark, d),
                            "labels": labels_a(spark, d), "fact": fact_a(spark, d)},
                           key=K.SERIAL)


@query("anomaly_by_stand", S.rounded(f"""
SELECT TEST_STAND, count(*) AS units, count(*) FILTER (WHERE LABEL = 1) AS positives,
       count(*) FILTER (WHERE LABEL = 1) * 100.0 / count(*) AS anomaly_rate
FROM ({S.FACT_A}) f GROUP BY TEST_STAND""", ["anomaly_rate"]))
def q_anomaly_by_stand(spark, d):
    """BI2: anomaly rate per test stand."""
    return KP.anomaly_by(fact_a(spark, d), K.STAND)


@query("anomaly_by_attribute", S.rounded(f"""
WITH j AS (SELECT f.LABEL, d."GROUP", d.NATURE FROM ({S.FACT_B}) f
           JOIN ({S.DIM_B}) d ON f.PRODUCT_NUMBER = d.PRODUCT_NUMBER)
SELECT 'GROUP' AS attribute, "GROUP" AS value, count(*) AS units,
       count(*) FILTER (WHERE LABEL = 1) AS positives,
       count(*) FILTER (WHERE LABEL = 1) * 100.0 / count(*) AS anomaly_rate FROM j GROUP BY "GROUP"
UNION ALL
SELECT 'NATURE', NATURE, count(*), count(*) FILTER (WHERE LABEL = 1),
       count(*) FILTER (WHERE LABEL = 1) * 100.0 / count(*) FROM j GROUP BY NATURE""",
    ["anomaly_rate"]))
def q_anomaly_by_attribute(spark, d):
    """BI6: anomaly rate by product attribute on the covered subset."""
    return KP.anomaly_by_attribute(fact_b(spark, d), dim_b(spark, d))


@query("sensor_pairs", f"""
SELECT SERIAL_NUMBER, LABEL, l_extendedprice_mean, l_quantity_mean, l_discount_max
FROM ({S.FACT_B}) f""")
def q_sensor_pairs(spark, d):
    """BI7: points behind the sensor scatter plots, coloured by label."""
    return KP.sensor_pairs(fact_b(spark, d),
                           ["l_extendedprice_mean", "l_quantity_mean", "l_discount_max"])


@query("stratified_split", f"""
SELECT SERIAL_NUMBER, LABEL, CASE WHEN {SPLIT_SQL} < 800 THEN 'train' ELSE 'test' END AS split
FROM ({S.FACT_B}) f""")
def q_stratified_split(spark, d):
    """ML1 / FI1 / ST1: hash-stratified 80/20 split, seed 42."""
    return SP.stratified_split(fact_b(spark, d).select(K.SERIAL, K.LABEL))


@query("class_weights", S.rounded(f"""
WITH t AS (SELECT LABEL FROM ({S.FACT_B}) f WHERE {SPLIT_SQL} < 800),
     c AS (SELECT LABEL, count(*) AS count FROM t GROUP BY LABEL)
SELECT LABEL, count, CAST(sum(count) OVER () AS DOUBLE) / (2.0 * count) AS weight FROM c""",
    ["weight"]))
def q_class_weights(spark, d):
    """AG17 / SC12: class weights N / (2 n_c) from the training split."""
    train, _ = SP.train_test(fact_b(spark, d).select(K.SERIAL, K.LABEL))
    return SP.class_weights(train)



@query("split_balance", f"""
SELECT CASE WHEN {SPLIT_SQL} < 800 THEN 'train' ELSE 'test' END AS split, LABEL,
       count(*) AS count
FROM ({S.FACT_B}) f GROUP BY 1, 2""")
def q_split_balance(spark, d):
    """AG13 on the split: units per (split, label), i.e. both classes present
    on both sides."""
    s = SP.stratified_split(fact_b(spark, d).select(K.SERIAL, K.LABEL))
    return SP.split_balance(s)


SPLIT_HASH_SQL = "CAST(('0x' || substr(md5(CAST(SERIAL_NUMBER AS VARCHAR) || ':42'), 1, 8)) AS BIGINT)"


@query("stratified_split_exact", f"""
WITH f AS (SELECT SERIAL_NUMBER, LABEL FROM ({S.FACT_B}) x),
r AS (SELECT SERIAL_NUMBER, LABEL,
        row_number() OVER (PARTITION BY LABEL ORDER BY {SPLIT_HASH_SQL}, SERIAL_NUMBER) AS rn,
        count(*) OVER (PARTITION BY LABEL) AS n
      FROM f WHERE LABEL = 1)
SELECT SERIAL_NUMBER, LABEL, CASE WHEN {SPLIT_SQL} < 800 THEN 'train' ELSE 'test' END AS split
FROM f WHERE LABEL <> 1 OR LABEL IS NULL
UNION ALL
SELECT SERIAL_NUMBER, LABEL, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END
FROM r""")
def q_stratified_split_exact(spark, d):
    """ML1 option: exactly 80 % of the rare positive class by hash rank; the
    majority class keeps the bucket rule."""
    return SP.stratified_split_exact(fact_b(spark, d).select(K.SERIAL, K.LABEL))
