"""Star schema: fact (one row per unit), product dimension, flat ML dataset, and
the key audits around them (JO1-JO6, PR2-PR3, SO5).

Joins are plain equi-joins without hints: Spark broadcasts a side only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks
at run time), and falls back to a sort-merge join otherwise, so a large
catalogue stays safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay import constants as K


def fact_table(features: DataFrame, labels: DataFrame, key: str = K.SERIAL,
               carry: Sequence[str] = (K.LABEL, K.PRODUCT, K.STAND),
               how: str = "inner") -> DataFrame:
    """features ⋈ labels on the unit key (inner, as the reference)."""
    cols = [c for c in carry if c in labels.columns]
    return features.join(labels.select(key, *cols), key, how)


def dim_product(items: DataFrame, key: str = K.PRODUCT,
                attributes: Sequence[str] = K.PRODUCT_ATTRIBUTES) -> DataFrame:
    """Key + the optional attributes that exist, one row per key.

    Duplicates keep the most complete row (fewest NULL attributes), then the
    smallest attribute tuple: deterministic, and a ``min(struct)`` aggregate
    that combines map-side (no per-key window).
    """
    attrs = [a for a in attributes if a in items.columns]
    if not attrs:
        return items.select(key).distinct()
    nulls = sum((F.col(a).isNull().cast("int") for a in attrs), F.lit(0))
    return (items.groupBy(key)
            .agg(F.min(F.struct(nulls.alias("_nulls"), *[F.col(a) for a in attrs])).alias("_row"))
            .select(key, *[F.col(f"_row.{a}").alias(a) for a in attrs]))


def dataset_ml(fact: DataFrame, dim: DataFrame, key: str = K.PRODUCT) -> DataFrame:
    """fact ⟕ dimension (using-join: the key comes first)."""
    return fact.join(dim, key, "left")


def key_overlap(left: DataFrame, right: DataFrame, key: str = K.SERIAL,
                right_key: str | None = None) -> DataFrame:
    """Distinct keys on each side, then counts of left-only / both / right-only.

    Both sides are de-duplicated (map-side first) before the full outer join,
    so a hot key is one row by the time it is joined.
    """
    rk = right_key or key
    lk = left.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    rk_ = (right.select(F.col(rk).alias("_k")).where(F.col("_k").isNotNull()).distinct()
           .withColumn("_r", F.lit(True)))
    j = lk.withColumn("_l", F.lit(True)).join(rk_, "_k", "full")
    return j.agg(
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNull()).alias("left_only"),
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("both"),
        F.count_if(F.col("_l").isNull() & F.col("_r").isNotNull()).alias("right_only"),
    )


def catalogue_coverage(fact: DataFrame, dim: DataFrame, key: str = K.PRODUCT) -> DataFrame:
    """Products present in the fact, how many the dimension describes, share."""
    used = fact.select(key).where(F.col(key).isNotNull()).distinct()
    known = dim.select(key).distinct().withColumn("_known", F.lit(1))
    j = used.join(known, key, "left")
    return j.agg(
        F.count(F.lit(1)).alias("products_tested"),
        F.count("_known").alias("products_covered"),
    ).withColumn("coverage",
                 F.coalesce(F.try_divide(F.col("products_covered").cast("double"),
                                         F.col("products_tested").cast("double")), F.lit(0.0)))


def unmatched_keys(series_keys: DataFrame, label_keys: DataFrame,
                   key: str = K.SERIAL) -> DataFrame:
    """Keys lost by the inner fact join, with the side they come from."""
    s = series_keys.select(key).distinct()
    r = label_keys.select(key).distinct()
    return (s.join(r, key, "left_anti").withColumn("side", F.lit("series_without_result"))
            .unionByName(r.join(s, key, "left_anti")
                         .withColumn("side", F.lit("result_without_series"))))


def star_join(dim: DataFrame, fact: DataFrame, predictions: DataFrame,
              product: str = K.PRODUCT, key: str = K.SERIAL,
              carry: Sequence[str] = (K.PROBABILITY, K.FINAL_PREDICTION)) -> DataFrame:
    """dimension —(1:*)— fact —(1:0..1)— predictions, as the report model. Of
    several predictions for a unit the one with the highest values stays, so
    units are never multiplied."""
    held = [c for c in carry if c in predictions.columns]
    p = (predictions.groupBy(key).agg(F.max(F.struct(*held)).alias("_p"))
         .select(key, *[F.col("_p")[c].alias(c) for c in held]))
    return fact.join(dim, product, "left").join(p, key, "left")
