"""Test-data stand-ins for the reference's tables (FIXTURES.md §3).

A  device series   events  -> series (serial = user_id), orders -> results
B  wide sensors    lineitem -> series (serial = l_orderkey), orders -> results,
                   part (every 7th key) -> product classification
C  ML vectors      embeddings -> id + 64 features + label
E  scores          orders per customer -> (label, score)
D  CSV layer       lives in plans/medallion.py (it writes files)

Only renames and derived columns here; every operator is in ``operators/``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay import constants as K
from assay.functions.scalar import round_ieee

# --- fixed values: binding rules of the test stand-ins -----------------------
W_PRICE = 490000.0          # an order at or above this total price is a 'W' verdict
SCORE_SCALE = 500000.0      # binding E score = avg(total price) / this
CATALOGUE_EVERY = 7         # binding B catalogue: parts with key % 7 = 0
EMBEDDING_DIM = 64
E_THRESHOLD = 0.5           # binding E decision threshold
SENSORS_A = ["VALUE", "K"]
SENSORS_B = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# --- end of fixed values ----------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _verdict(price: str = "o_totalprice"):
    return F.when(F.col(price) >= F.lit(W_PRICE), F.lit(K.ANOMALY_VERDICT)) \
            .otherwise(F.lit(K.GOOD_VERDICT))


# ---------------------------------------------------------------- binding A
def series_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias(K.SERIAL),
        F.col("ts").alias(K.TS),
        F.col("event_type").alias(K.PHASE),
        F.col("value").alias("VALUE"),
        F.get_json_object("props", "$.k").try_cast("double").alias("K"),
    )


def results_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias(K.SERIAL),
        _verdict().alias(K.RESULT),
        F.col("o_orderpriority").alias(K.STAND),
        F.col("o_orderdate").alias("TEST_DATE"),
        F.col("o_orderkey").alias("TEST_ID"),
    )


A_ORDER = ["TEST_DATE", "TEST_ID"]


# ---------------------------------------------------------------- binding B
def series_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias(K.SERIAL),
        F.col("l_shipdate").alias(K.TS),
        F.col("l_returnflag").alias(K.PHASE),
        *SENSORS_B,
    )


def results_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One test per order; product = part of the order's first line."""
    li = table(spark, sf_dir, "lineitem")
    first_part = (li.groupBy("l_orderkey")
                  .agg(F.min(F.struct("l_linenumber", "l_partkey")).alias("_f"))
                  .select(F.col("l_orderkey").alias(K.SERIAL),
                          F.col("_f.l_partkey").alias(K.PRODUCT)))
    o = table(spark, sf_dir, "orders")
    res = o.select(
        F.col("o_orderkey").alias(K.SERIAL),
        _verdict().alias(K.RESULT),
        F.col("o_orderpriority").alias(K.STAND),
        F.col("o_orderdate").alias("TEST_DATE"),
    )
    return res.join(first_part, K.SERIAL, "left")


def items_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return (p.where(F.col("p_partkey") % CATALOGUE_EVERY == 0)
            .select(F.col("p_partkey").alias(K.PRODUCT),
                    F.col("p_brand").alias("GROUP"),
                    F.col("p_type").alias("NATURE"),
                    F.col("p_size").cast("string").alias("MODEL")))


def catalogue_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts as a raw product catalogue: padded text, a second less complete
    row for every fifth part and another complete row for every eleventh."""
    p = table(spark, sf_dir, "part")
    key, size = F.col("p_partkey").alias(K.PRODUCT), F.col("p_size")

    def rows(df, group, nature, model):
        return df.select(key, group.alias("GROUP"), nature.alias("NATURE"), model.cast("string").alias("MODEL"))
    return (rows(p, F.concat(F.lit("  "), "p_brand", F.lit(" ")), F.concat("p_type", F.lit(" ")), size)
            .unionAll(rows(p.where("p_partkey % 5 = 0"), F.concat(F.lit(" "), "p_brand"), F.lit(None).cast("string"), size))
            .unionAll(rows(p.where("p_partkey % 11 = 0"), F.col("p_brand"), F.col("p_type"), size + 100)))


# ---------------------------------------------------------------- binding C
def vectors_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    feats = [F.col("embedding")[i].cast("double").alias(f"e_{i}") for i in range(EMBEDDING_DIM)]
    return e.select(F.col("vec_id").alias(K.SERIAL),
                    (F.col("label") == 0).cast("int").alias(K.LABEL), *feats)


C_FEATURES = [f"e_{i}" for i in range(EMBEDDING_DIM)]


# ---------------------------------------------------------------- binding E
def scores_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_custkey").alias(K.SERIAL))
            .agg(F.max(F.when(F.col("o_totalprice") >= F.lit(W_PRICE), 1).otherwise(0))
                 .alias(K.LABEL),
                 round_ieee(F.avg("o_totalprice") / F.lit(SCORE_SCALE), 6)
                 .alias(K.PROBABILITY)))
