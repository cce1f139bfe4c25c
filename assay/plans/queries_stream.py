"""Queries: the layers on Structured Streaming (bindings A, B, D). Each runs its
stream over all available files, then reads what the stream has written; the SQL
is the batch definition, so these check stream = batch."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay import constants as K
from assay.operators import features as FE
from assay.operators import label as LB
from assay.plans import bindings as B
from assay.plans import medallion as M
from assay.plans import sqltext as S
from assay.plans.catalog import query
from assay.plans.queries_io import SILVER_TS_SQL
from assay.session import scratch_path
from assay.sources.delimited import read_delimited_stream
from assay.streaming import scoring, sequences, silver, upsert
from assay.streaming.continuous import materialize, stream_table


FILES_A_BATCH = 50_000      # the files of a batch are listed and planned on the driver


def _places(spark, name):
    return scratch_path(spark, f"stream-{name}-out"), scratch_path(spark, f"stream-{name}-ckpt")


def _series_a(events):
    return events.select(
        F.col("user_id").alias(K.SERIAL), F.col("ts").alias(K.TS),
        F.col("event_type").alias(K.PHASE), F.col("value").alias("VALUE"),
        F.get_json_object("props", "$.k").try_cast("double").alias("K"))


def _upserted(spark, df, name):
    """Runs an update-mode aggregate into a keyed table and reads it."""
    out, ckpt = _places(spark, name)
    upsert.run_upserts(df, out, ckpt, [K.SERIAL], buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return upsert.current(spark, out, [K.SERIAL], df.schema)


@query("stream_worst_label", S.LABELS_A)
def q_stream_worst_label(spark, d):
    """SS3: worst verdict / tests / first stand per unit, as a stateful stream
    whose batches write the units that changed."""
    o = stream_table(spark, d, "orders")
    lines = LB.label_lines(o.select(
        F.col("o_custkey").alias(K.SERIAL),
        F.when(F.col("o_totalprice") >= F.lit(B.W_PRICE), F.lit(K.ANOMALY_VERDICT))
        .otherwise(F.lit(K.GOOD_VERDICT)).alias(K.RESULT),
        F.col("o_orderpriority").alias(K.STAND),
        F.col("o_orderdate").alias("TEST_DATE"), F.col("o_orderkey").alias("TEST_ID")))
    return _upserted(spark, LB.worst_label(lines, attributes=[K.STAND], order=B.A_ORDER), "worst-label")


@query("stream_features", S.FEATURES_A)
def q_stream_features(spark, d):
    """SS4: running sequence features per unit, as a stateful stream whose
    batches write the units that changed."""
    return _upserted(spark, FE.sequence_features(_series_a(stream_table(spark, d, "events")), sensors=B.SENSORS_A), "features")


@query("stream_silver", SILVER_TS_SQL)
def q_stream_silver(spark, d):
    """SS1 + SS2: binding D's text files as a stream -> serial from the path,
    parsed dates and numbers; equals ``silver_measurements``."""
    path = M.write_time_series(spark, d, scratch_path(spark, "sources"))
    out, ckpt = _places(spark, "silver")
    raw = read_delimited_stream(spark, path, M.TS_COLUMNS_D)
    silver.run_silver(raw, out, ckpt, sensors=M.SENSORS_D, scope="path")
    return silver.read_silver(spark, out, M.SENSORS_D)[0]


@query("stream_silver_dirty", """
SELECT CASE WHEN event_type <> 'error' THEN md5(CAST(user_id AS VARCHAR)) END AS SERIAL_NUMBER,
       CASE WHEN event_id % 13 <> 0 AND event_id % 17 <> 0
            THEN strptime(strftime(ts, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S') END AS TS,
       event_type AS PHASE, CASE WHEN event_id % 7 <> 0 THEN value END AS "VALUE",
       CASE WHEN event_id % 11 <> 0 THEN TRY_CAST(props->>'$.k' AS DOUBLE) END AS "K",
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS quarantined
FROM events""")
def q_stream_silver_dirty(spark, d):
    """SS2 on faulty files: bad dates and numbers become NULL, rows of files
    without a serial go to the quarantine layer."""
    path = M.write_test_files(M.dirty_events(spark, d), scratch_path(spark, "dirty"))
    out, ckpt = _places(spark, "silver-dirty")
    silver.run_silver(read_delimited_stream(spark, path, M.TS_COLUMNS_D), out, ckpt, sensors=M.SENSORS_D, scope="path")
    good, bad = silver.read_silver(spark, out, M.SENSORS_D)
    return good.withColumn("quarantined", F.lit(0)).unionByName(bad.withColumn("quarantined", F.lit(1)))


@query("stream_file_features", f"""
WITH e AS (SELECT md5(CAST(user_id AS VARCHAR)) AS s, date_trunc('second', ts) AS t, event_type AS ph, value AS v,
                  TRY_CAST(props->>'$.k' AS DOUBLE) AS k FROM events)
SELECT s AS SERIAL_NUMBER, {S.feature_select({"VALUE": "v", "K": "k"}, "t", "ph")} FROM e GROUP BY s""")
def q_stream_file_features(spark, d):
    """SS4, one file per test: features of each file from the batch that reads
    it, without state."""
    path = M.write_test_files(M.source_events(spark, d), scratch_path(spark, "tests"))
    out, ckpt = _places(spark, "file-features")
    raw = read_delimited_stream(spark, path, M.TS_COLUMNS_D, max_files_per_trigger=FILES_A_BATCH)
    sequences.run_file_sequences(raw, out, ckpt, M.SENSORS_D, scope="path")
    got = sequences.read_sequences(spark, out, sequences.sequence_schema(M.SENSORS_D))
    return got.select(K.SERIAL, *FE.feature_names(M.SENSORS_D), *K.LEAK_COLUMNS)


SESSION_GAP_HOURS = 6
_SESSIONS_SQL = f"""
WITH e AS (
  SELECT user_id, ts, event_type, value, TRY_CAST(props->>'$.k' AS DOUBLE) AS k,
    CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
           OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL {SESSION_GAP_HOURS} HOUR
         THEN 1 ELSE 0 END AS new_session
  FROM events),
s AS (SELECT *, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM e)
SELECT user_id AS SERIAL_NUMBER, min(ts) AS session_start,
       max(ts) + INTERVAL {SESSION_GAP_HOURS} HOUR AS session_end,
  {S.feature_select({"VALUE": "value", "K": "k"}, "ts", "event_type")}
FROM s GROUP BY user_id, sid"""


@query("stream_sessions", _SESSIONS_SQL)
def q_stream_sessions(spark, d):
    """SS4 with a watermark: a unit's readings form one sequence until a gap
    of 6 hours (session window); features per (unit, sequence)."""
    from assay.streaming.continuous import completed_sequences
    seq = completed_sequences(_series_a(stream_table(spark, d, "events")), B.SENSORS_A, gap=f"{SESSION_GAP_HOURS} hours")
    # complete mode: the final state of every sequence, including those the
    # watermark has not closed yet (append mode emits closed ones only)
    return materialize(spark, seq, "sessions", mode="complete")


@query("stream_closed_sequences", f"""
SELECT * FROM ({_SESSIONS_SQL}) s
WHERE session_end <= (SELECT max(ts) - INTERVAL {SESSION_GAP_HOURS} HOUR FROM events)""")
def q_stream_closed_sequences(spark, d):
    """SS4, end of sequence on a bus: append mode emits a sequence once, when the
    watermark has passed its end."""
    out, ckpt = _places(spark, "closed")
    gap = f"{SESSION_GAP_HOURS} hours"
    series = _series_a(stream_table(spark, d, "events"))
    sequences.run_bus_sequences(series, out, ckpt, B.SENSORS_A, gap=gap)
    schema = sequences.sequence_schema(B.SENSORS_A, ends="gap", serial=series.schema[K.SERIAL].dataType)
    return sequences.read_sequences(spark, out, schema).drop("batch_id")


def stream_scores(spark, d, model):
    """Binding B's sequences scored with ``model`` as they finish (a unit's
    readings lie in one file)."""
    models = scratch_path(spark, "models")
    scoring.register_model(model, models, 1)
    out, ckpt = _places(spark, "scores")
    li = stream_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias(K.SERIAL), F.col("l_shipdate").alias(K.TS), F.col("l_returnflag").alias(K.PHASE), *B.SENSORS_B)
    scoring.run_scoring(li, models, out, ckpt, B.SENSORS_B,
                        features=lambda batch: FE.sequence_features(batch, sensors=B.SENSORS_B))
    return scoring.read_scores(spark, out, serial=T.LongType()).drop("batch_id")


@query("stream_scores", rounded=False)
def q_stream_scores(spark, d):
    """SS5: binding B's sequences scored by a stream with the random forest of
    ``scored_fact``."""
    from assay.plans.queries_ml import fit_fact_forest
    return stream_scores(spark, d, fit_fact_forest(spark, d)[0])
