"""Builders for the oracle SQL texts (ANSI SQL as run by DuckDB on the same
parquet views). Kept beside the queries so each query and its SQL read
together; these only assemble strings."""

from __future__ import annotations

from assay import constants as K
from assay.plans import bindings as B

VERDICT_SQL = f"CASE WHEN o_totalprice >= {B.W_PRICE} THEN 1 ELSE 0 END"


def r6(expr: str) -> str:
    return f"(round(CAST({expr} AS DOUBLE) * 1000000.0) / 1000000.0 + 0.0)"


def rounded(sql: str, cols) -> str:
    """Wrap a query, rounding the listed double columns (engine-identical)."""
    rep = ", ".join(f'{r6(q(c))} AS {q(c)}' for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) _r"


def q(c: str) -> str:
    return f'"{c}"'


def feature_select(sensors: dict[str, str], ts: str, phase: str,
                   leak: bool = True, rnd=r6) -> str:
    parts = []
    for name, expr in sensors.items():
        parts += [
            f"{rnd(f'avg({expr})')} AS {name}_mean",
            f"{rnd(f'stddev_samp({expr})')} AS {name}_std",
            f"{rnd(f'min({expr})')} AS {name}_min",
            f"{rnd(f'max({expr})')} AS {name}_max",
            f"{rnd(f'quantile_disc({expr}, 0.5)')} AS {name}_med",
        ]
    if leak:
        parts += [
            f"count(*) AS {K.LEAK_COUNT}",
            f"count(DISTINCT {phase}) AS {K.LEAK_PHASES}",
            f"date_diff('second', min({ts}), max({ts})) AS {K.LEAK_DURATION}",
        ]
    return ",\n  ".join(parts)


SENSORS_A_SQL = {"VALUE": "value", "K": "TRY_CAST(props->>'$.k' AS DOUBLE)"}
SENSORS_B_SQL = {s: s for s in B.SENSORS_B}

FEATURES_A = f"""
SELECT user_id AS SERIAL_NUMBER,
  {feature_select(SENSORS_A_SQL, 'ts', 'event_type')}
FROM events GROUP BY user_id"""

FEATURES_B = f"""
SELECT l_orderkey AS SERIAL_NUMBER,
  {feature_select(SENSORS_B_SQL, 'l_shipdate', 'l_returnflag')}
FROM lineitem GROUP BY l_orderkey"""

# worst verdict per unit, binding A (customer = unit, order = test)
LABELS_A = f"""
SELECT o_custkey AS SERIAL_NUMBER,
  max({VERDICT_SQL}) AS LABEL,
  count(*) AS nb_tests,
  first(o_orderpriority ORDER BY o_orderdate, o_orderkey) AS TEST_STAND
FROM orders GROUP BY o_custkey"""


def _raw(x):
    return f"CAST({x} AS DOUBLE)"


FEATURES_B_RAW = f"""
SELECT l_orderkey AS SERIAL_NUMBER,
  {feature_select(SENSORS_B_SQL, 'l_shipdate', 'l_returnflag', rnd=_raw)}
FROM lineitem GROUP BY l_orderkey"""

FIRST_PART_B = """
SELECT l_orderkey, first(l_partkey ORDER BY l_linenumber, l_partkey) AS PRODUCT_NUMBER
FROM lineitem GROUP BY l_orderkey"""

LABELS_B = f"""
SELECT o.o_orderkey AS SERIAL_NUMBER,
  max({VERDICT_SQL}) AS LABEL,
  count(*) AS nb_tests,
  first(fp.PRODUCT_NUMBER ORDER BY o.o_orderdate, o.o_orderkey) AS PRODUCT_NUMBER,
  first(o.o_orderpriority ORDER BY o.o_orderdate, o.o_orderkey) AS TEST_STAND
FROM orders o LEFT JOIN ({FIRST_PART_B}) fp ON fp.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey"""

FACT_B = f"""
SELECT f.*, r.LABEL, r.PRODUCT_NUMBER, r.TEST_STAND
FROM ({FEATURES_B}) f JOIN ({LABELS_B}) r ON f.SERIAL_NUMBER = r.SERIAL_NUMBER"""

FACT_B_RAW = f"""
SELECT f.*, r.LABEL, r.PRODUCT_NUMBER, r.TEST_STAND
FROM ({FEATURES_B_RAW}) f JOIN ({LABELS_B}) r ON f.SERIAL_NUMBER = r.SERIAL_NUMBER"""

FACT_A = f"""
SELECT f.*, r.LABEL, r.TEST_STAND
FROM ({FEATURES_A}) f JOIN ({LABELS_A}) r ON f.SERIAL_NUMBER = r.SERIAL_NUMBER"""

DIM_B = f"""
SELECT p_partkey AS PRODUCT_NUMBER, p_brand AS "GROUP", p_type AS NATURE,
       CAST(p_size AS VARCHAR) AS MODEL
FROM part WHERE p_partkey % {B.CATALOGUE_EVERY} = 0"""

CATALOGUE_B = """
SELECT p_partkey AS PRODUCT_NUMBER, '  ' || p_brand || ' ' AS "GROUP", p_type || ' ' AS NATURE,
       CAST(p_size AS VARCHAR) AS MODEL FROM part
UNION ALL SELECT p_partkey, ' ' || p_brand, NULL, CAST(p_size AS VARCHAR) FROM part WHERE p_partkey % 5 = 0
UNION ALL SELECT p_partkey, p_brand, p_type, CAST(p_size + 100 AS VARCHAR) FROM part WHERE p_partkey % 11 = 0"""

TRIMMED_B = f"""
SELECT PRODUCT_NUMBER, trim("GROUP") AS "GROUP", trim(NATURE) AS NATURE, trim(MODEL) AS MODEL
FROM ({CATALOGUE_B}) c"""

DIM_ALL_B = f"""
SELECT PRODUCT_NUMBER, "GROUP", NATURE, MODEL FROM (
  SELECT *, row_number() OVER (PARTITION BY PRODUCT_NUMBER ORDER BY
    CAST("GROUP" IS NULL AS INT) + CAST(NATURE IS NULL AS INT) + CAST(MODEL IS NULL AS INT),
    "GROUP" NULLS FIRST, NATURE NULLS FIRST, MODEL NULLS FIRST) AS nth FROM ({TRIMMED_B}) t) r
WHERE nth = 1"""

SCORES_E = f"""
SELECT o_custkey AS SERIAL_NUMBER, max({VERDICT_SQL}) AS LABEL,
       {r6(f"avg(o_totalprice) / {B.SCORE_SCALE}")} AS {K.PROBABILITY}
FROM orders GROUP BY o_custkey"""

PRED_E = f"""
SELECT *, CAST({K.PROBABILITY} >= {B.E_THRESHOLD} AS INTEGER) AS {K.FINAL_PREDICTION}
FROM ({SCORES_E}) _s"""

OUTCOME_SQL = f"""CASE WHEN LABEL = 1 AND {K.FINAL_PREDICTION} = 1 THEN '{K.OUTCOME_TP}'
  WHEN LABEL = 0 AND {K.FINAL_PREDICTION} = 1 THEN '{K.OUTCOME_FP}'
  WHEN LABEL = 1 AND {K.FINAL_PREDICTION} = 0 THEN '{K.OUTCOME_FN}'
  ELSE '{K.OUTCOME_TN}' END"""

SCORED_E = f"SELECT *, {OUTCOME_SQL} AS {K.OUTCOME} FROM ({PRED_E}) _p"

SERIES_B_SQL = """SELECT l_orderkey AS SERIAL_NUMBER, l_shipdate AS TS, l_returnflag AS PHASE,
  l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem"""

SERIES_A_SQL = """SELECT user_id AS SERIAL_NUMBER, ts AS TS, event_type AS PHASE,
  value AS "VALUE", TRY_CAST(props->>'$.k' AS DOUBLE) AS "K" FROM events"""
