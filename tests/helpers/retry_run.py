"""Run the chunked operators with and without a failed first task attempt
(local[4,3]: up to 3 attempts per task) and print both results as JSON."""

import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main(sf_dir: str) -> None:
    spark = (SparkSession.builder.master("local[4,3]")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "6")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="assay-retry-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from assay import constants as K
    from assay.operators import audit as AU
    from assay.operators import evaluate as EV
    from assay.operators import features as FE
    from assay.plans import bindings as B

    marks = tempfile.mkdtemp(prefix="assay-retry-marks-")

    @F.udf("long")
    def flaky(x):
        tc = TaskContext.get()
        if tc is not None and tc.attemptNumber() == 0 and tc.partitionId() == 0:
            open(os.path.join(marks, f"stage{tc.stageId()}"), "w").close()
            raise RuntimeError("injected task failure")
        return x

    def run(fail: bool):
        li = B.table(spark, sf_dir, "lineitem").repartition(3)
        key = flaky(F.col("l_orderkey")) if fail else F.col("l_orderkey")
        series = li.select(key.alias(K.SERIAL), F.col("l_shipdate").alias(K.TS),
                           "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                           F.col("l_returnflag").alias(K.PHASE))
        inv = AU.time_inversions(series, order=["l_linenumber", "l_partkey", "l_suppkey"]).first()
        med = (FE.exact_medians(series, K.SERIAL, ["l_quantity"])
               .agg(F.sum("l_quantity_med").alias("s"), F.count(F.lit(1)).alias("n")).first())
        scores = B.scores_e(spark, sf_dir)
        if fail:
            scores = scores.withColumn(K.SERIAL, flaky(F.col(K.SERIAL)))
        roc = EV.roc_auc(scores).first()["roc_auc"]
        pr = EV.pr_auc(scores).first()["pr_auc"]
        return {"pairs": inv["pairs"], "inversions": inv["inversions"],
                "median_sum": med["s"], "units": med["n"], "roc": roc, "pr": pr}

    res = {"clean": run(False), "retried": run(True), "failed_attempts": len(os.listdir(marks))}
    print("RESULT " + json.dumps(res))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
