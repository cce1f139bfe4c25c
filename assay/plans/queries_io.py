"""Queries: sources, lineage and stateless silver transforms (bindings A, B, D).

Binding D writes the test tables as ';' CSV source folders into a fresh
folder under the shared checkpoint directory, then reads them back as the
reference's bronze layer does.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from assay import constants as K
from assay.functions.scalar import parse_timestamp, serial_from_path
from assay.operators import clean as CL
from assay.operators import label as LB
from assay.plans import bindings as B
from assay.plans import medallion as M
from assay.plans import sqltext as S
from assay.plans.catalog import query
from assay.session import scratch_path
from assay.sources.delimited import INGESTED_AT, SOURCE_FILE, SOURCE_NAME

BRONZE_TS_SQL = """
SELECT strftime(ts, '%d/%m/%Y') AS "DATE", strftime(ts, '%H:%M:%S') AS HEURE,
       event_type AS PHASE, CAST(value AS VARCHAR) AS "VALUE", props->>'$.k' AS "K"
FROM events"""

SILVER_TS_SQL = """
SELECT md5(CAST(user_id AS VARCHAR)) AS SERIAL_NUMBER,
       strptime(strftime(ts, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S') AS TS,
       event_type AS PHASE, value AS "VALUE", TRY_CAST(props->>'$.k' AS DOUBLE) AS "K"
FROM events"""


SOURCE_SERIAL_SQL = """CASE WHEN o_orderkey % 5 = 0 THEN ' ' || md5(CAST(o_custkey AS VARCHAR)) || ' '
         ELSE md5(CAST(o_custkey AS VARCHAR)) END"""

SOURCE_RESULT_SQL = """CASE WHEN o_totalprice >= 490000.0
         THEN CASE WHEN o_orderstatus = 'P' THEN ' W' ELSE 'W' END
         ELSE CASE WHEN o_orderstatus = 'P' THEN 'g' ELSE 'G' END END"""


@query("unknown_verdicts", """
SELECT RESULT AS verdict, count(*) AS count FROM (SELECT {r} AS RESULT FROM orders) s
WHERE RESULT IS NULL OR RESULT NOT IN ('W', 'G') GROUP BY RESULT""".format(r=SOURCE_RESULT_SQL))
def q_unknown_verdicts(spark, d):
    """Trap 5: verdict texts other than 'G' / 'W' (they all become label 0),
    counted, on the results source text."""
    from assay.operators.audit import unknown_verdicts
    return unknown_verdicts(M.source_results(spark, d))


def _time_series(spark, d):
    return M.write_time_series(spark, d, scratch_path(spark, "sources"))


@query("bronze_measurements", BRONZE_TS_SQL)
def q_bronze_measurements(spark, d):
    """IO1 (+IO7 upstream): source CSV folder read back as all-string columns."""
    return M.read_bronze_measurements(spark, _time_series(spark, d)).select(*M.TS_COLUMNS_D)


@query("bronze_results", """
SELECT {SOURCE_SERIAL_SQL} AS SERIAL_NUMBER, {SOURCE_RESULT_SQL} AS RESULT,
       o_orderpriority AS TEST_STAND, strftime(o_orderdate, '%Y-%m-%d') AS TEST_DATE,
       CAST(o_orderkey AS VARCHAR) AS TEST_ID
FROM orders""".format(SOURCE_RESULT_SQL=SOURCE_RESULT_SQL, SOURCE_SERIAL_SQL=SOURCE_SERIAL_SQL))
def q_bronze_results(spark, d):
    """IO2: results folder read back as strings."""
    path = M.write_results(spark, d, scratch_path(spark, "sources"))
    return M.read_bronze_results(spark, path).select(*M.RESULT_COLUMNS_D)


@query("bronze_lineage", """
SELECT strftime(ts, '%d/%m/%Y') AS "DATE", strftime(ts, '%H:%M:%S') AS HEURE,
       'TimeSeries_' || md5(CAST(user_id AS VARCHAR)) AS folder, md5(CAST(user_id AS VARCHAR)) AS SERIAL_NUMBER,
       TRUE AS name_ends_path, TRUE AS is_csv, TRUE AS ingested FROM events""")
def q_bronze_lineage(spark, d):
    """IO5 / IO6: every bronze row with the folder and serial of its source file;
    file names and ingestion times differ from run to run and are checked as
    conditions."""
    raw = M.read_bronze_measurements(spark, _time_series(spark, d))
    return raw.select(K.DATE, K.TIME, F.regexp_extract(SOURCE_FILE, r"_test=([^/]*)/", 1).alias("folder"),
                      serial_from_path(SOURCE_FILE, scope="path").alias(K.SERIAL),
                      F.col(SOURCE_FILE).endswith(F.concat(F.lit("/"), SOURCE_NAME)).alias("name_ends_path"),
                      F.col(SOURCE_NAME).endswith(".csv").alias("is_csv"),
                      (F.col(INGESTED_AT) <= F.current_timestamp()).alias("ingested"))


@query("silver_measurements", SILVER_TS_SQL)
def q_silver_measurements(spark, d):
    """PR1 + SC1-SC4 + SO1: bronze CSV -> typed series sorted by (unit, time)."""
    raw = M.read_bronze_measurements(spark, _time_series(spark, d))
    clean = CL.clean_measurements(raw, sensors=M.SENSORS_D, scope="path")
    good, _ = CL.split_quarantine(clean)
    return CL.sort_series(good)


def _paths(spark, d):
    """Source-style file paths built from the events: the serial is in the
    file name, except for 'error' events whose file has no serial; every
    10th folder name carries a decoy 32-hex run."""
    ev = B.table(spark, d, "events")
    name = F.when(F.col("event_type") == "error",
                  F.concat(F.lit("TimeSeries_"), F.date_format("ts", "yyyyMMdd_HHmmss"),
                           F.lit("_nohex.csv"))) \
            .otherwise(F.concat(F.lit("TimeSeries_"), F.date_format("ts", "yyyyMMdd_HHmmss"),
                                F.lit("_"), F.md5(F.col("user_id").cast("string")),
                                F.lit(".csv")))
    folder = F.when(F.col("event_id") % 10 == 0,
                    F.concat(F.lit("/lake/Test Bench/"), F.md5(F.col("event_id").cast("string")),
                             F.lit("/"))).otherwise(F.lit("/lake/Test Bench/TimeSeries/"))
    return ev.select("event_id", F.concat(folder, name).alias("path"))


@query("serial_from_path", r"""
WITH p AS (
  SELECT event_id,
    CASE WHEN event_id % 10 = 0 THEN '/lake/Test Bench/' || md5(CAST(event_id AS VARCHAR)) || '/'
         ELSE '/lake/Test Bench/TimeSeries/' END ||
    CASE WHEN event_type = 'error' THEN 'TimeSeries_' || strftime(ts, '%Y%m%d_%H%M%S') || '_nohex.csv'
         ELSE 'TimeSeries_' || strftime(ts, '%Y%m%d_%H%M%S') || '_' || md5(CAST(user_id AS VARCHAR)) || '.csv'
    END AS path FROM events)
SELECT event_id, path,
  nullif(regexp_extract(regexp_extract(path, '([^/\\]*)$', 1), '([0-9a-fA-F]{32})', 1), '')
    AS SERIAL_NUMBER,
  nullif(regexp_extract(path, '([0-9a-fA-F]{32})', 1), '') AS serial_whole_path
FROM p""")
def q_serial_from_path(spark, d):
    """SC1: 32-hex serial from the file name (NULL when absent); the
    reference's whole-path variant alongside, which a hex folder fools."""
    p = _paths(spark, d)
    return p.select("event_id", "path",
                    serial_from_path("path", scope="name").alias(K.SERIAL),
                    serial_from_path("path", scope="path").alias("serial_whole_path"))


@query("parse_timestamp", """
SELECT user_id AS SERIAL_NUMBER, strftime(ts, '%d/%m/%Y') AS "DATE", strftime(ts, '%H:%M:%S') AS HEURE,
       strptime(strftime(ts, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S') AS TS
FROM events""")
def q_parse_timestamp(spark, d):
    """SC2 + SC3: DATE + HEURE text -> timestamp (NULL on bad input)."""
    ev = B.table(spark, d, "events").select(
        F.col("user_id").alias(K.SERIAL),
        F.date_format("ts", "dd/MM/yyyy").alias(K.DATE),
        F.date_format("ts", "HH:mm:ss").alias(K.TIME))
    return ev.withColumn(K.TS, parse_timestamp(K.DATE, K.TIME))


@query("line_label", f"""
SELECT o_custkey AS SERIAL_NUMBER, CASE WHEN o_totalprice >= 490000.0 THEN 'W' ELSE 'G' END AS RESULT,
       o_orderpriority AS TEST_STAND, o_orderdate AS TEST_DATE, o_orderkey AS TEST_ID,
       {S.VERDICT_SQL} AS LAB
FROM orders""")
def q_line_label(spark, d):
    """SC7: per-test label, exactly 'W' -> 1."""
    return LB.label_lines(B.results_a(spark, d))


@query("results_trim", """
SELECT md5(CAST(o_custkey AS VARCHAR)) AS SERIAL_NUMBER, {SOURCE_RESULT_SQL} AS RESULT,
       o_orderpriority AS TEST_STAND, strftime(o_orderdate, '%Y-%m-%d') AS TEST_DATE,
       CAST(o_orderkey AS VARCHAR) AS TEST_ID,
       CASE WHEN {SOURCE_RESULT_SQL} = 'W' THEN 1 ELSE 0 END AS LAB
FROM orders""".format(SOURCE_RESULT_SQL=SOURCE_RESULT_SQL))
def q_results_trim(spark, d):
    """SC5 + SC7 on the text results: trimmed ids and the line label."""
    return CL.clean_results(M.source_results(spark, d))


@query("trim_all", S.TRIMMED_B)
def q_trim_all(spark, d):
    """SC6: trim every non-'_' text column of the product classification."""
    return CL.trim_all(B.catalogue_b(spark, d))


def medallion_fact_sql() -> str:
    """The gold fact of binding D in one SQL statement."""
    feats = S.feature_select({"VALUE": "v", "K": "k"}, "t", "ph")
    return f"""
WITH e AS (SELECT md5(CAST(user_id AS VARCHAR)) AS s,
                  strptime(strftime(ts, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S') AS t,
                  event_type AS ph, value AS v, TRY_CAST(props->>'$.k' AS DOUBLE) AS k
           FROM events),
f AS (SELECT s AS SERIAL_NUMBER, {feats} FROM e GROUP BY s),
r AS (SELECT md5(CAST(o_custkey AS VARCHAR)) AS SERIAL_NUMBER,
             max(CASE WHEN {SOURCE_RESULT_SQL} = 'W' THEN 1 ELSE 0 END) AS LABEL,
             first(o_orderpriority ORDER BY strftime(o_orderdate, '%Y-%m-%d'),
                   CAST(o_orderkey AS VARCHAR)) AS TEST_STAND
      FROM orders GROUP BY 1)
SELECT f.*, r.LABEL, r.TEST_STAND FROM f JOIN r ON f.SERIAL_NUMBER = r.SERIAL_NUMBER"""


@query("medallion_fact", medallion_fact_sql())
def q_medallion_fact(spark, d):
    """IO1-IO9 end to end: source folders -> bronze -> silver (typed, padded
    ids trimmed, worst verdict, sorted series) -> gold fact, each layer
    written to and read back from a fresh lake folder."""
    from assay.sources.layers import read_layer
    src = M.write_sources(spark, d, scratch_path(spark, "sources"))
    lake = M.Lake(scratch_path(spark, "lake"))
    M.bronze(spark, src, lake, columns={"timeseries": M.TS_COLUMNS_D,
                                        "results": M.RESULT_COLUMNS_D})
    M.silver(spark, lake, sensors=M.SENSORS_D, scope="path",
             result_order=["TEST_DATE", "TEST_ID"])
    M.gold(spark, lake, sensors=M.SENSORS_D)
    return read_layer(spark, lake.path("gold", "fait_test_moteur"))


@query("file_time_inversions", S.rounded("""
WITH e AS (SELECT md5(CAST(user_id AS VARCHAR)) AS s, date_trunc('second', ts) AS t,
                  strftime(ts, '%d/%m/%Y') AS d, strftime(ts, '%H:%M:%S') AS h FROM events),
l AS (SELECT t, lag(t) OVER (PARTITION BY s ORDER BY h, d) AS p FROM e)
SELECT count(p) AS pairs, count(*) FILTER (WHERE t < p) AS inversions,
       coalesce(CAST(count(*) FILTER (WHERE t < p) AS DOUBLE) / nullif(count(p), 0), 0.0)
         AS share
FROM l""", ["share"]))
def q_file_time_inversions(spark, d):
    """QA6 on source files: readings in file arrival order (file, split
    offset, row in split, kept from bronze) whose time goes backwards. The
    files are read once, into a silver table that the counting, the cut points
    and the chunks read."""
    from assay.operators.audit import time_inversions
    from assay.sources.delimited import ARRIVAL
    from assay.sources.layers import read_layer, write_layer
    raw = M.read_bronze_measurements(spark, _time_series(spark, d))
    clean = CL.clean_measurements(raw, sensors=M.SENSORS_D, scope="path", keep_arrival=True)
    silver = read_layer(spark, write_layer(clean, scratch_path(spark, "silver")))
    good, _ = CL.split_quarantine(silver)
    return time_inversions(good, order=ARRIVAL)
