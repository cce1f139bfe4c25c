"""Evaluation on any (label, score[, prediction]) relation (EV1-EV6,
SC14-SC16, FI3-FI4, AG18-AG19, SO6).

Counts are single-pass conditional aggregates (the reference runs four
filtered counts per threshold: 40 jobs for a 10-threshold sweep; here it is
one). Curves (ROC / PR) never sort all rows in one task: rows are first
reduced to one row per distinct score (map-side), the score range is cut into
chunks, running sums are taken inside each chunk and offset by the totals of the
chunks above (a table with one row per chunk). ROC and PR areas come from one
such table (``curve_areas``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assay import constants as K
from assay.functions.scalar import apply_threshold, f1_from, outcome_label, place_among, safe_ratio


def with_prediction(df: DataFrame, score: str = K.PROBABILITY,
                    threshold: float = K.FINAL_THRESHOLD,
                    out: str = K.FINAL_PREDICTION) -> DataFrame:
    """SC14: inclusive threshold -> 0/1."""
    return df.withColumn(out, apply_threshold(score, threshold))


def with_outcome(df: DataFrame, label: str = K.LABEL,
                 prediction: str = K.FINAL_PREDICTION, out: str = K.OUTCOME) -> DataFrame:
    """SC15: TP / FP / FN / TN wording of each row."""
    return df.withColumn(out, outcome_label(label, prediction))


def _cells(y: Column, p: Column) -> list[Column]:
    return [F.count_if((y == 1) & (p == 1)).alias("TP"),
            F.count_if((y == 0) & (p == 1)).alias("FP"),
            F.count_if((y == 0) & (p == 0)).alias("TN"),
            F.count_if((y == 1) & (p == 0)).alias("FN")]


def _ratios(df: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("TP"), F.col("FP"), F.col("FN")
    return (df.withColumn("Precision", safe_ratio(tp, tp + fp))
              .withColumn("Recall", safe_ratio(tp, tp + fn))
              .withColumn("F1", f1_from(F.col("Precision"), F.col("Recall"))))


def anomaly_metrics(df: DataFrame, label: str = K.LABEL,
                    prediction: str = K.FINAL_PREDICTION) -> DataFrame:
    """EV2: class-1 confusion cells and precision / recall / F1 (0 on 0/0)."""
    return _ratios(df.agg(*_cells(F.col(label), F.col(prediction))))


def confusion_matrix(df: DataFrame, label: str = K.LABEL,
                     prediction: str = K.FINAL_PREDICTION) -> DataFrame:
    """AG18: one row per (label, prediction) cell present."""
    return (df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(label, prediction))


def with_accuracy(cells: DataFrame) -> DataFrame:
    """EV1 from the class counts TP, FP, TN, FN: accuracy and class-weighted F1
    (as the multiclass evaluator's ``f1``): sum over the label classes present of
    share(c) * F1(c)."""
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("TP", "FP", "TN", "FN"))
    n = tp + fp + tn + fn
    f1_pos = safe_ratio(2 * tp, 2 * tp + fp + fn)
    f1_neg = safe_ratio(2 * tn, 2 * tn + fn + fp)
    return (cells.withColumn("accuracy", safe_ratio(tp + tn, n))
            .withColumn("f1_weighted", safe_ratio((tp + fn) * f1_pos + (tn + fp) * f1_neg, n))
            .withColumn("f1_anomaly", f1_pos))


def accuracy_f1w(df: DataFrame, label: str = K.LABEL,
                 prediction: str = K.FINAL_PREDICTION) -> DataFrame:
    """EV1: accuracy and class-weighted F1 of the rows."""
    cells = df.agg(*_cells(F.col(label), F.col(prediction)))
    return with_accuracy(cells).select("accuracy", "f1_weighted", "f1_anomaly")


def threshold_sweep(df: DataFrame, label: str = K.LABEL, score: str = K.PROBABILITY,
                    thresholds: Sequence[float] = K.SWEEP_THRESHOLDS) -> DataFrame:
    """EV5: TP/FP/TN/FN, precision, recall, F1 at each threshold, one pass.

    One global aggregate with 2 conditional counts per threshold plus the
    class totals (partial per partition, one tiny final row), then one row
    per threshold. Ordered by decreasing threshold. Units without a score are in
    no cell: they were neither predicted good nor bad.
    """
    y, s = F.col(label), F.col(score)
    known = s.isNotNull()
    aggs = [F.count_if((y == 1) & known).alias("_P"), F.count_if((y == 0) & known).alias("_N")]
    for i, t in enumerate(thresholds):
        hit = s >= F.lit(float(t))
        aggs += [F.count_if((y == 1) & hit).alias(f"tp{i}"),
                 F.count_if((y == 0) & hit).alias(f"fp{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(float(t)).alias("Threshold"),
                     F.col(f"tp{i}").alias("TP"), F.col(f"fp{i}").alias("FP"),
                     (F.col("_N") - F.col(f"fp{i}")).alias("TN"),
                     (F.col("_P") - F.col(f"tp{i}")).alias("FN"))
            for i, t in enumerate(thresholds)]
    return _ratios(one.select(F.inline(F.array(*rows)))).orderBy(F.desc("Threshold"))


def outcome_counts(scored: DataFrame, outcome: str = K.OUTCOME) -> DataFrame:
    """AG19: rows per outcome, most frequent first."""
    return (scored.groupBy(outcome).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), outcome))


def false_negatives(scored: DataFrame, label: str = K.LABEL,
                    prediction: str = K.FINAL_PREDICTION) -> DataFrame:
    """FI4: anomalous units the model missed (report table)."""
    return scored.where((F.col(label) == 1) & (F.col(prediction) == 0))


def risk_ranking(scored: DataFrame, score: str = K.PROBABILITY, key: str = K.SERIAL,
                 top: int | None = None) -> DataFrame:
    """SO6: units by decreasing risk (a distributed range sort; ``top`` makes
    it a top-k report)."""
    out = scored.orderBy(F.desc(score), F.asc(key))
    return out.limit(top) if top else out


def score_histogram(scored: DataFrame, score: str = K.PROBABILITY, label: str = K.LABEL,
                    bins: int = 20) -> DataFrame:
    """BI4: distribution of the score in ``bins`` equal-width bins of [0, 1]."""
    b = F.least(F.floor(F.col(score) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    return (scored.groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"),
                 F.count_if(F.col(label) == 1).alias("positives"))
            .withColumn("bin_low", F.col("bin") / F.lit(float(bins)))
            .orderBy("bin"))


# ------------------------------------------------------------------ curves
#: Cut points of the score range; so many distinct scores a chunk, if they suffice.
CUTS = 1023
SCORES_A_CHUNK = 1_000_000


def _running_by_score(df: DataFrame, label: str, score: str, chunks: int | None) -> DataFrame:
    """One row per distinct score with running sums over decreasing score
    (cum_pos, cum_n, inclusive) and the totals tot_pos, tot_n; NULL scores rank
    nothing and are left out.

    Rows are first counted per score (map-side). A quantile sketch of the distinct
    scores cuts their range; a score's chunk is its place among the cuts, a pure
    function of the score, so nothing has to be checkpointed. The sketch and the
    chunks read the same exchange. Running sums are taken inside a chunk and
    added to the totals of the chunks above it (one row a chunk)."""
    g = (df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("_s"))
         .agg(F.count_if(F.col(label) == 1).cast("double").alias("_pos"), F.count(F.lit(1)).cast("double").alias("_n")))
    points = [(i + 1) / (CUTS + 1) for i in range(CUTS)]
    sketch = g.agg(F.struct(F.count(F.lit(1)).alias("n"), F.percentile_approx("_s", points, 10 * (CUTS + 1)).alias("cuts"),
                            F.sum("_pos").alias("pos"), F.sum("_n").alias("rows"))).scalar()
    # as many chunks as the scores need, out of the finest cut
    wanted = F.lit(chunks) if chunks else F.least(F.lit(CUTS + 1), F.ceil(F.col("_sketch.n") / F.lit(SCORES_A_CHUNK)))
    place = place_among(F.col("_s"), F.col("_sketch.cuts"), CUTS)
    cut = (g.withColumn("_sketch", sketch)
           .select("_s", "_pos", "_n", F.col("_sketch.pos").alias("tot_pos"), F.col("_sketch.rows").alias("tot_n"), F.when(wanted > 1, F.floor(place * wanted / F.lit(CUTS + 1))).otherwise(F.lit(0)).cast("int").alias("_chunk")))
    totals = cut.groupBy("_chunk").agg(F.sum("_pos").alias("_cp"), F.sum("_n").alias("_cn"))
    above = Window.orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    # one row per chunk, at most CUTS + 1
    offsets = totals.select(F.col("_chunk").alias("_o_chunk"),
                            F.coalesce(F.sum("_cp").over(above), F.lit(0.0)).alias("_op"),
                            F.coalesce(F.sum("_cn").over(above), F.lit(0.0)).alias("_on"))
    w = (Window.partitionBy("_chunk").orderBy(F.desc("_s"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = cut.withColumn("_rp", F.sum("_pos").over(w)).withColumn("_rn", F.sum("_n").over(w))
    return (summed.join(F.broadcast(offsets), F.col("_chunk") == F.col("_o_chunk"))
            .withColumn("cum_pos", F.col("_op") + F.col("_rp"))
            .withColumn("cum_n", F.col("_on") + F.col("_rn")).drop("_o_chunk", "_rp", "_rn"))


def pr_curve(df: DataFrame, label: str = K.LABEL, score: str = K.PROBABILITY,
             chunks: int | None = None) -> DataFrame:
    """Points (threshold, recall, precision, ...) per distinct score."""
    r = _running_by_score(df, label, score, chunks)
    return (r.withColumnRenamed("_s", "threshold")
            .withColumn("recall", F.try_divide(F.col("cum_pos"), F.col("tot_pos")))
            .withColumn("precision", F.try_divide(F.col("cum_pos"), F.col("cum_n"))))


def curve_areas(df: DataFrame, label: str = K.LABEL, score: str = K.PROBABILITY,
                chunks: int | None = None) -> DataFrame:
    """EV3 + EV4 in one pass: one row with

    * ``roc_auc``: exact area under ROC, ties counted one half;
    * ``pr_auc``: trapezoid area under (recall, precision) with the first
      point (0, precision at the highest score) -- the binary evaluator's rule.

    Both equal the evaluator with ``numBins=0``. A point's predecessor follows
    from its own running sums less its own counts.
    """
    p = pr_curve(df, label, score, chunks)
    pos0, n0 = F.col("cum_pos") - F.col("_pos"), F.col("cum_n") - F.col("_n")
    recall0 = F.try_divide(pos0, F.col("tot_pos"))
    precision0 = F.coalesce(F.try_divide(pos0, n0), F.col("precision"))
    neg = F.col("_n") - F.col("_pos")
    return p.agg(
        F.try_divide(F.sum(neg * (F.col("cum_pos") - F.col("_pos") / 2.0)),
                     F.sum("_pos") * F.sum(neg)).alias("roc_auc"),
        F.sum((F.col("recall") - recall0) * (F.col("precision") + precision0) / 2.0).alias("pr_auc"))


def roc_auc(df: DataFrame, label: str = K.LABEL, score: str = K.PROBABILITY,
            chunks: int | None = None) -> DataFrame:
    """EV3: exact area under ROC, ties counted one half (equals the binary
    evaluator with ``numBins=0``)."""
    return curve_areas(df, label, score, chunks).select("roc_auc")


def pr_auc(df: DataFrame, label: str = K.LABEL, score: str = K.PROBABILITY,
           chunks: int | None = None) -> DataFrame:
    """EV4: exact PR-AUC (see ``curve_areas``)."""
    return curve_areas(df, label, score, chunks).select("pr_auc")


def positive_rate(fact: DataFrame, label: str = K.LABEL) -> DataFrame:
    """AG20 / FI2: units, positives, share of positives (0 on an empty fact)."""
    return (fact.agg(F.count(F.lit(1)).alias("units"),
                     F.count_if(F.col(label) == 1).alias("positives"))
            .withColumn("positive_rate",
                        safe_ratio(F.col("positives") * 100.0, F.col("units"))))
