"""Spark session settings and the shared checkpoint folder.

Cluster jobs get their session from the platform; only `get_session` (tests,
bench, local runs) sets values, and it never overrides one that is set.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. AQE re-plans joins and coalesces shuffle
# partitions at run time; skew-join splits hot keys of the postings join.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # 128 MB splits: pages are a few KB each, a split holds ~40k pages.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Broadcasts are decided by the code against explicit row bounds, plus
    # Spark's own size estimate for plans we do not hint.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_session(master: str | None = None, app: str = "sitesift", shuffle_partitions: int | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by `spark.checkpoint.dir`.

    On a cluster this is set by the platform to a shared file system and is
    used as is; a cluster without the setting is an error. Only a local master
    (tests, bench) gets a fresh local folder.
    """
    cdir = spark.conf.get("spark.checkpoint.dir", None)
    if not cdir:
        cdir = spark.sparkContext.getCheckpointDir()
    if not cdir:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        cdir = tempfile.mkdtemp(prefix="sitesift-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cdir)
    spark.sparkContext.setCheckpointDir(cdir)
    return spark.sparkContext.getCheckpointDir() or cdir


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder, read back: for large frames, which a
    checkpoint would keep as whole uncompressed rows."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python path, once per session, for functions that run there."""
    context = spark.sparkContext
    if getattr(context, "_sitesift_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = shutil.make_archive(os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="sitesift-zip-")), "sitesift"), "zip", root, "sitesift")
    context.addPyFile(path)  # served by the driver
    context._sitesift_shipped = True
