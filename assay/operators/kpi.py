"""Report measures (BI1-BI10): the data behind each report visual, as
DataFrames. Every measure is one aggregation over the fact / predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay import constants as K
from assay.functions.scalar import safe_ratio


def kpi_overview(fact: DataFrame, predictions: DataFrame, key: str = K.SERIAL,
                 label: str = K.LABEL, prediction: str = K.FINAL_PREDICTION) -> DataFrame:
    """BI1: tested units, scored units, real anomaly rate (%), predicted rate (%).
    A unit scored several times counts once, as an anomaly if any score says so;
    a unit without a serial is tested and not scored."""
    p = predictions.groupBy(key).agg(F.max(prediction).alias("_pred"))
    j = fact.select(key, label).join(p, key, "left")
    return j.agg(
        F.count(F.lit(1)).alias("units_tested"),
        F.count("_pred").alias("units_scored"),
        safe_ratio(F.count_if(F.col(label) == 1) * 100.0, F.count(F.lit(1))).alias("anomaly_rate"),
        safe_ratio(F.count_if(F.col("_pred") == 1) * 100.0, F.count("_pred"))
        .alias("predicted_rate"))


def anomaly_by(fact: DataFrame, by: str, label: str = K.LABEL) -> DataFrame:
    """BI2: units, positives and anomaly rate (%) per value of ``by``."""
    return (fact.groupBy(by)
            .agg(F.count(F.lit(1)).alias("units"),
                 F.count_if(F.col(label) == 1).alias("positives"))
            .withColumn("anomaly_rate", safe_ratio(F.col("positives") * 100.0, F.col("units")))
            .orderBy(by))


def anomaly_by_attribute(fact: DataFrame, dim: DataFrame,
                         attributes: Sequence[str] = ("GROUP", "NATURE", "STATUS"),
                         key: str = K.PRODUCT, label: str = K.LABEL) -> DataFrame:
    """BI6: anomaly rate per attribute value, on the covered subset only
    (inner join with the dimension). Long form: attribute, value, counts.

    One pass: the per-attribute groupings are expressed as grouping sets of a
    single aggregate (one shuffle) instead of a union of N aggregates."""
    attrs = [a for a in attributes if a in dim.columns]
    j = fact.select(key, label).join(dim.select(key, *attrs), key, "inner")
    cube = j.groupingSets([[F.col(a)] for a in attrs], *[F.col(a) for a in attrs]).agg(
        F.count(F.lit(1)).alias("units"),
        F.count_if(F.col(label) == 1).alias("positives"),
        *[F.grouping(a).alias(f"_g{i}") for i, a in enumerate(attrs)])
    which = F.coalesce(*[F.when(F.col(f"_g{i}") == 0, F.lit(a)) for i, a in enumerate(attrs)])
    value = F.coalesce(*[F.when(F.col(f"_g{i}") == 0, F.col(a).cast("string"))
                         for i, a in enumerate(attrs)])
    return cube.select(which.alias("attribute"), value.alias("value"), "units", "positives",
                       safe_ratio(F.col("positives") * 100.0, F.col("units")).alias("anomaly_rate"))


def rate_gap(scored: DataFrame, label: str = K.LABEL,
             prediction: str = K.FINAL_PREDICTION) -> DataFrame:
    """BI9: predicted anomaly rate minus real anomaly rate (percentage points)."""
    return scored.agg(
        (F.avg(F.col(prediction).cast("double")) * 100.0).alias("predicted_rate"),
        (F.avg(F.col(label).cast("double")) * 100.0).alias("real_rate"),
    ).withColumn("gap", F.col("predicted_rate") - F.col("real_rate"))


def sensor_pairs(fact: DataFrame, features: Sequence[str], key: str = K.SERIAL,
                 label: str = K.LABEL, fraction: float | None = None,
                 seed: int = K.SPLIT_SEED) -> DataFrame:
    """BI7: the points behind the sensor scatter plots (key, label, the chosen
    features). ``fraction`` draws a seeded, key-hashed sample for plotting; its
    hash differs from the split's, so it holds training and test units alike."""
    out = fact.select(key, label, *features)
    if fraction is not None:
        from assay.functions.scalar import split_hash
        out = out.where(split_hash(key, f"plot-{seed}") < F.lit(int(round(fraction * 2 ** 32))))
    return out


def with_scoring_metadata(scored: DataFrame, model_version: str,
                          scored_at=None) -> DataFrame:
    """BI10: scoring time and model version on every scored row."""
    ts = F.current_timestamp() if scored_at is None else F.lit(scored_at).cast("timestamp")
    return scored.withColumn("scored_at", ts).withColumn("model_version", F.lit(model_version))


def top_features(importances: DataFrame, k: int = 2, feature: str = "Feature",
                 importance: str = "Importance") -> list[str]:
    """Names of the ``k`` most important features (reads k rows)."""
    rows = importances.orderBy(F.desc(importance), F.asc(feature)).limit(k).collect()
    return [r[feature] for r in rows]


def sensor_pairs_by_importance(fact: DataFrame, importances: DataFrame, k: int = 2,
                               key: str = K.SERIAL, label: str = K.LABEL) -> DataFrame:
    """BI7 as the report builds it: the scatter data of the ``k`` features the
    random forest ranks highest, coloured by label."""
    return sensor_pairs(fact, top_features(importances, k), key, label)
