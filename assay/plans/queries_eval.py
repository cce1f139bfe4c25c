"""Queries: evaluation and report measures on score relations (binding E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay import constants as K
from assay.operators import evaluate as EV
from assay.operators import kpi as KP
from assay.operators import star as ST
from assay.plans import bindings as B
from assay.plans import sqltext as S
from assay.plans.catalog import query
from assay.plans.queries_core import dim_all_b, fact_a, fact_b

PE = K.PROBABILITY
FP = K.FINAL_PREDICTION


def predictions_e(spark, d):
    return EV.with_prediction(B.scores_e(spark, d), threshold=B.E_THRESHOLD)


def scored_e(spark, d):
    return EV.with_outcome(predictions_e(spark, d))


def predictions_b(spark, d):
    """Per-order scores for the star join: score = total price / scale."""
    o = B.table(spark, d, "orders")
    from assay.functions.scalar import round_ieee
    s = o.select(F.col("o_orderkey").alias(K.SERIAL),
                 round_ieee(F.col("o_totalprice") / F.lit(B.SCORE_SCALE), 6).alias(PE))
    return EV.with_prediction(s, threshold=B.E_THRESHOLD)


def _sweep_sql() -> str:
    parts = []
    for t in K.SWEEP_THRESHOLDS:
        parts.append(f"""SELECT {t} AS Threshold,
  count(*) FILTER (WHERE LABEL = 1 AND {PE} >= {t}) AS TP,
  count(*) FILTER (WHERE LABEL = 0 AND {PE} >= {t}) AS FP,
  count(*) FILTER (WHERE LABEL = 0 AND {PE} < {t}) AS TN,
  count(*) FILTER (WHERE LABEL = 1 AND {PE} < {t}) AS FN FROM ({S.SCORES_E}) e""")
    return _with_ratios(" UNION ALL ".join(parts), extra=["Threshold"])


def _with_ratios(cells_sql: str, extra=()) -> str:
    cols = ", ".join(list(extra) + ["TP", "FP", "TN", "FN"])
    sql = f"""
WITH c AS ({cells_sql}),
     p AS (SELECT {cols},
       coalesce(CAST(TP AS DOUBLE) / nullif(TP + FP, 0), 0.0) AS Precision,
       coalesce(CAST(TP AS DOUBLE) / nullif(TP + FN, 0), 0.0) AS Recall FROM c)
SELECT *, coalesce(2.0 * Precision * Recall / nullif(Precision + Recall, 0), 0.0) AS F1 FROM p"""
    return S.rounded(sql, ["Precision", "Recall", "F1"] + list(
        c for c in extra if c == "Threshold"))


CELLS_E = f"""SELECT count(*) FILTER (WHERE LABEL = 1 AND {FP} = 1) AS TP,
  count(*) FILTER (WHERE LABEL = 0 AND {FP} = 1) AS FP,
  count(*) FILTER (WHERE LABEL = 0 AND {FP} = 0) AS TN,
  count(*) FILTER (WHERE LABEL = 1 AND {FP} = 0) AS FN FROM ({S.PRED_E}) e"""


@query("threshold_sweep", _sweep_sql())
def q_threshold_sweep(spark, d):
    """EV5 / FI3: confusion cells and ratios at 10 thresholds in one pass."""
    return EV.threshold_sweep(B.scores_e(spark, d))


@query("apply_threshold", S.PRED_E)
def q_apply_threshold(spark, d):
    """SC14: inclusive threshold -> 0/1 prediction."""
    return predictions_e(spark, d)


@query("outcome_label", S.SCORED_E)
def q_outcome_label(spark, d):
    """SC15: TP / FP / FN / TN wording per unit."""
    return scored_e(spark, d)


@query("anomaly_metrics", _with_ratios(CELLS_E))
def q_anomaly_metrics(spark, d):
    """EV2 / BI3: class-1 cells, precision, recall, F1."""
    return EV.anomaly_metrics(predictions_e(spark, d))


@query("confusion_matrix", f"""
SELECT LABEL, {FP}, count(*) AS count FROM ({S.PRED_E}) e GROUP BY LABEL, {FP}""")
def q_confusion_matrix(spark, d):
    """AG18: (label, prediction) cells."""
    return EV.confusion_matrix(predictions_e(spark, d))


@query("accuracy_f1w", S.rounded(f"""
WITH c AS ({CELLS_E}),
     d AS (SELECT CAST(TP AS DOUBLE) tp, CAST(FP AS DOUBLE) fp, CAST(TN AS DOUBLE) tn,
                  CAST(FN AS DOUBLE) fn FROM c)
SELECT coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0), 0.0) AS accuracy,
       coalesce(((tp + fn) * coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0)
               + (tn + fp) * coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0.0))
               / nullif(tp + fp + tn + fn, 0), 0.0) AS f1_weighted,
       coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1_anomaly FROM d""",
    ["accuracy", "f1_weighted", "f1_anomaly"]))
def q_accuracy_f1w(spark, d):
    """EV1: accuracy and weighted F1 (multiclass evaluator's definitions)."""
    return EV.accuracy_f1w(predictions_e(spark, d))


@query("roc_auc", S.rounded(f"""
WITH g AS (SELECT {PE} p, CAST(sum(LABEL) AS DOUBLE) pos, CAST(sum(1 - LABEL) AS DOUBLE) neg
           FROM ({S.SCORES_E}) e GROUP BY {PE}),
     c AS (SELECT p, pos, neg, sum(pos) OVER (ORDER BY p DESC) cp,
                  sum(pos) OVER () tp, sum(neg) OVER () tn FROM g)
SELECT sum(neg * (cp - pos / 2)) / max(tp * tn) AS roc_auc FROM c""", ["roc_auc"]))
def q_roc_auc(spark, d):
    """EV3: exact ROC-AUC without a one-task sort."""
    return EV.roc_auc(B.scores_e(spark, d))


@query("pr_auc", S.rounded(f"""
WITH g AS (SELECT {PE} p, CAST(sum(LABEL) AS DOUBLE) pos, CAST(count(*) AS DOUBLE) n
           FROM ({S.SCORES_E}) e GROUP BY {PE}),
     c AS (SELECT p, sum(pos) OVER (ORDER BY p DESC) / sum(pos) OVER () r,
                  sum(pos) OVER (ORDER BY p DESC) / sum(n) OVER (ORDER BY p DESC) q FROM g),
     d AS (SELECT r, q, lag(r) OVER (ORDER BY p DESC) r0, lag(q) OVER (ORDER BY p DESC) q0 FROM c)
SELECT sum((r - coalesce(r0, 0)) * (q + coalesce(q0, q)) / 2) AS pr_auc FROM d""", ["pr_auc"]))
def q_pr_auc(spark, d):
    """EV4: exact PR-AUC (trapezoid, first point (0, first precision))."""
    return EV.pr_auc(B.scores_e(spark, d))


@query("outcome_counts", f"""
SELECT {K.OUTCOME}, count(*) AS count FROM ({S.SCORED_E}) s GROUP BY {K.OUTCOME}""")
def q_outcome_counts(spark, d):
    """AG19: units per outcome."""
    return EV.outcome_counts(scored_e(spark, d))


@query("risk_ranking", S.PRED_E)
def q_risk_ranking(spark, d):
    """SO6: all units by decreasing anomaly probability."""
    return EV.risk_ranking(predictions_e(spark, d))


@query("false_negatives", f"SELECT * FROM ({S.SCORED_E}) s WHERE LABEL = 1 AND {FP} = 0")
def q_false_negatives(spark, d):
    """FI4 / BI5: anomalous units the model missed."""
    return EV.false_negatives(scored_e(spark, d))


@query("score_histogram", S.rounded(f"""
SELECT CAST(least(floor({PE} * 20), 19) AS INTEGER) AS bin, count(*) AS count,
       count(*) FILTER (WHERE LABEL = 1) AS positives,
       CAST(least(floor({PE} * 20), 19) AS INTEGER) / 20.0 AS bin_low
FROM ({S.SCORES_E}) e GROUP BY 1""", ["bin_low"]))
def q_score_histogram(spark, d):
    """BI4: distribution of the anomaly probability (20 bins)."""
    return EV.score_histogram(B.scores_e(spark, d))


@query("rate_gap", S.rounded(f"""
SELECT avg(CAST({FP} AS DOUBLE)) * 100.0 AS predicted_rate,
       avg(CAST(LABEL AS DOUBLE)) * 100.0 AS real_rate,
       avg(CAST({FP} AS DOUBLE)) * 100.0 - avg(CAST(LABEL AS DOUBLE)) * 100.0 AS gap
FROM ({S.PRED_E}) e""", ["predicted_rate", "real_rate", "gap"]))
def q_rate_gap(spark, d):
    """BI9: predicted minus real anomaly rate."""
    return KP.rate_gap(predictions_e(spark, d))


@query("kpi_overview", S.rounded(f"""
SELECT count(*) AS units_tested, count(p.{FP}) AS units_scored,
       coalesce(count(*) FILTER (WHERE f.LABEL = 1) * 100.0 / nullif(count(*), 0), 0.0)
         AS anomaly_rate,
       coalesce(count(*) FILTER (WHERE p.{FP} = 1) * 100.0 / nullif(count(p.{FP}), 0), 0.0)
         AS predicted_rate
FROM ({S.FACT_A}) f LEFT JOIN ({S.PRED_E}) p ON f.SERIAL_NUMBER = p.SERIAL_NUMBER""",
    ["anomaly_rate", "predicted_rate"]))
def q_kpi_overview(spark, d):
    """BI1: tested units, scored units, real and predicted anomaly rates."""
    return KP.kpi_overview(fact_a(spark, d), predictions_e(spark, d))


@query("star_join", S.rounded(f"""
SELECT f.*, d."GROUP", d.NATURE, d.MODEL, p.{PE}, p.{FP}
FROM ({S.FACT_B_RAW}) f
LEFT JOIN ({S.DIM_ALL_B}) d ON f.PRODUCT_NUMBER = d.PRODUCT_NUMBER
LEFT JOIN (SELECT o_orderkey AS SERIAL_NUMBER,
                  {S.r6(f"o_totalprice / {B.SCORE_SCALE}")} AS {PE},
                  CAST({S.r6(f"o_totalprice / {B.SCORE_SCALE}")} >= {B.E_THRESHOLD} AS INTEGER)
                    AS {FP} FROM orders) p
  ON f.SERIAL_NUMBER = p.SERIAL_NUMBER""",
    [f"{s}_{st}" for s in B.SENSORS_B for st in K.STATS] + [PE]))
def q_star_join(spark, d):
    """JO6: dimension — fact — predictions, the report's model."""
    return ST.star_join(dim_all_b(spark, d), fact_b(spark, d), predictions_b(spark, d))
