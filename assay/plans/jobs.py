"""Command-line jobs: the reference's workflow on a user's own folders.

    python -m assay.plans.jobs bronze --sources DIR --lake DIR
    python -m assay.plans.jobs silver --lake DIR [--sensors A,B,...] [--scope name|path]
    python -m assay.plans.jobs gold   --lake DIR [--sensors ...] [--exact-median]
    python -m assay.plans.jobs model  --lake DIR [--sensors ...] [--threshold 0.05]
    python -m assay.plans.jobs audit  --lake DIR [--sensors ...]

``--sources`` holds the four source folders of the reference layout
(TimeSeries, Results, Warranty, ItemClassification; the last two optional),
';'-separated text with a header. Every step reads the previous layer from
``--lake`` and overwrites its own; counts are printed from small aggregate
frames. The model step writes its leaderboard, importances and scored units
under ``<lake>/ml`` (and, with ``--table``, the scored units as a catalog
table).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay import constants as K
from assay.operators import audit as AU
from assay.operators import clean as CL
from assay.operators import evaluate as EV
from assay.operators import features as FE
from assay.operators import star as ST
from assay.operators import model as MD
from assay.operators import split as SP
from assay.operators.kpi import with_scoring_metadata
from assay.plans import medallion as M
from assay.sources.delimited import ARRIVAL
from assay.sources.layers import read_layer, read_optional, write_layer

# --- fixed values: source folder names of the reference layout --------------
SOURCE_FOLDERS = {"timeseries": "TimeSeries", "results": "Results",
                  "warranty": "Warranty", "itemclassification": "ItemClassification"}
# --- end of fixed values ----------------------------------------------------


def source_paths(sources: str) -> dict[str, str]:
    """The source folders under ``sources`` (local or remote). An optional one
    that is missing is noticed when it is listed."""
    return {name: f"{sources.rstrip('/')}/{folder}" for name, folder in SOURCE_FOLDERS.items()}


def run_model(spark: SparkSession, lake: M.Lake, sensors=K.SENSORS,
              threshold: float = K.FINAL_THRESHOLD, rare_exact: bool = True,
              models=("lr", "rf", "gbt", "svm"), table: str | None = None,
              model_version: str = "rf-200x8-seed42") -> dict[str, DataFrame]:
    """Fact -> features by inclusion (NULL std filled and counted) -> split
    (exact 80 % of the rare class) -> class weights from the training rows ->
    weighted models -> leaderboard, importances -> final random forest scores
    at ``threshold``. Results are written under ``<lake>/ml``."""
    fact = read_layer(spark, lake.path("gold", "fait_test_moteur"))
    feats = FE.feature_names(sensors)
    frame = FE.single_precision(FE.fill_missing_features(FE.ml_frame(fact, sensors), feats), feats)
    split = (SP.stratified_split_exact(frame) if rare_exact else SP.stratified_split(frame))
    write_layer(split, lake.path("ml", "split"))
    split = read_layer(spark, lake.path("ml", "split"))
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    SP.require_both_classes(SP.class_weights(train))
    train = SP.with_class_weight(train).cache()
    fitted, preds = {}, {}
    for kind in models:
        fitted[kind] = MD.fit(kind, train, feats)
        p = MD.predict(fitted[kind], test)
        write_layer(p, lake.path("ml", f"predictions_{kind}"))
        preds[MD.MODEL_NAMES[kind]] = read_layer(spark, lake.path("ml", f"predictions_{kind}"))
    write_layer(MD.leaderboard(preds), lake.path("ml", "leaderboard"))
    imps = [MD.feature_importance(fitted[k], feats, spark, top=None, model_name=MD.MODEL_NAMES[k])
            for k in ("rf", "gbt") if k in fitted]
    if imps:
        out = imps[0]
        for i in imps[1:]:
            out = out.unionByName(i)
        write_layer(out, lake.path("ml", "feature_importance"))
    final = fitted.get("rf") or MD.fit("rf", train, feats)
    scored = with_scoring_metadata(MD.score_units(final, test, threshold=threshold),
                                   model_version=model_version)
    write_layer(scored, lake.path("ml", "scored"))
    train.unpersist()
    if table:
        M.publish_scores(read_layer(spark, lake.path("ml", "scored")), table)
    return {name: read_layer(spark, lake.path("ml", name))
            for name in ("leaderboard", "scored")}


def run_audits(spark: SparkSession, lake: M.Lake, sensors=K.SENSORS) -> DataFrame:
    """The data-quality findings of the layers, each written under
    ``<lake>/audit/<name>``; returns one row per audit with its row count."""
    ts = M.read_series(spark, lake)[0]
    fact = read_layer(spark, lake.path("gold", "fait_test_moteur"))
    res = CL.clean_results(M.read_bronze(spark, lake, "results"))
    audits = {
        "grain": AU.grain_check(fact),
        "nulls": AU.null_audit(fact),
        "constant_sensors": AU.constant_columns(ts, list(sensors)),
        "contradictions": AU.contradictory_results(res),
        "unknown_verdicts": AU.unknown_verdicts(res),
        "series_vs_results": ST.key_overlap(ts, res),
        "unmatched": ST.unmatched_keys(ts, res),
        "positive_rate": EV.positive_rate(fact),
    }
    order = [c for c in ARRIVAL if c in ts.columns]
    if order:
        audits["time_inversions"] = AU.time_inversions(ts, order=order)
    war = read_optional(spark, lake.path("silver", "warranty_clean"))
    if war is not None:
        audits["warranty_vs_results"] = ST.key_overlap(war, res)
    dim = read_optional(spark, lake.path("gold", "dim_produit"))
    if dim is not None:
        audits["catalogue_coverage"] = ST.catalogue_coverage(fact, dim)
    for name, df in audits.items():
        write_layer(df, lake.path("audit", name))
    return AU.layer_counts({n: read_layer(spark, lake.path("audit", n)) for n in audits})


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="assay.plans.jobs")
    ap.add_argument("step", choices=["bronze", "silver", "gold", "model", "audit"])
    ap.add_argument("--lake", required=True)
    ap.add_argument("--sources")
    ap.add_argument("--sensors", default=",".join(K.SENSORS))
    ap.add_argument("--scope", default="name", choices=["name", "path"])
    ap.add_argument("--result-order", default="",
                    help="comma-separated columns ordering a unit's tests (first = representative)")
    ap.add_argument("--exact-median", action="store_true")
    ap.add_argument("--by-ingest-date", action="store_true",
                    help="bronze: partition by ingestion day, replacing only that day")
    ap.add_argument("--no-sort", action="store_true",
                    help="silver: keep arrival order instead of the (unit, time) sort")
    ap.add_argument("--threshold", type=float, default=K.FINAL_THRESHOLD)
    ap.add_argument("--table")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"assay-{a.step}").getOrCreate()
    lake = M.Lake(a.lake.rstrip("/"))
    sensors = [s for s in a.sensors.split(",") if s]
    if a.step == "bronze":
        if not a.sources:
            ap.error("bronze needs --sources")
        counts = M.bronze(spark, source_paths(a.sources), lake,
                          by_ingest_date=a.by_ingest_date)
    elif a.step == "silver":
        order = [c for c in a.result_order.split(",") if c] or None
        counts = M.silver(spark, lake, sensors=sensors, scope=a.scope, result_order=order,
                          sort=not a.no_sort)
    elif a.step == "gold":
        counts = M.gold(spark, lake, sensors=sensors, exact_median=a.exact_median)
    elif a.step == "audit":
        counts = run_audits(spark, lake, sensors=sensors)
    else:
        counts = run_model(spark, lake, sensors=sensors, threshold=a.threshold,
                           table=a.table)["leaderboard"]
    for row in counts.collect():      # a handful of rows: one per table / model
        print(row.asDict())


if __name__ == "__main__":
    main()
