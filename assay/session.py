"""Session helpers: building a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "assay") -> SparkSession:
    """Session used by tests and the bench. On a cluster, the cluster's own
    session (with its shuffle-partition count and checkpoint dir) is used."""
    spark = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset and the master is
    local (tests) is a fresh folder created and registered; on a cluster an
    unset setting is an error, so ``DataFrame.checkpoint()`` and the scratch
    tables below always land in one place every executor can read.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name a folder "
                "every executor can read (a machine-local temporary folder would not do)")
        configured = tempfile.mkdtemp(prefix="assay-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused sub-folder of the shared checkpoint folder.

    The token keeps its dashes on purpose: a 32-hex run in a path is read as a
    serial number by ``serial_from_path(scope="path")``.
    """
    root = checkpoint_root(spark)
    token = str(uuid.uuid4())
    return f"{root}/assay-scratch/{name}-{token}"


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Settings for folders with a file per unit, for what is listed, started or
    written inside. By default Spark reckons a file at 4 MB, so that a task reads a
    handful of files of a few dozen rows, lists with up to 10,000 tasks, and keeps the
    status of files listed before, up to 250 MB of the driver's memory."""
    ours = {"spark.sql.hive.filesourcePartitionFileCacheSize": "0",
            "spark.sql.files.openCostInBytes": str(64 << 10),
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(8 * spark.sparkContext.defaultParallelism)}
    before = {k: spark.conf.get(k) for k in ours}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
