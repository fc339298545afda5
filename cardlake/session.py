"""Session set-up and the shared scratch folder.

Cluster settings come from the cluster; ``build_session`` only fills in what
is unset (local runs and tests). Scratch output (lineage cuts, ingest round
trips, persisted layers) goes under the folder named by
``spark.checkpoint.dir``, which on a cluster is shared storage.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.cbo.enabled": "true",  # row counts of analyzed tables decide joins
    "spark.ui.showConsoleProgress": "false",
    # keep a bucketed table's layout on scan even without a join above it, so
    # a projection of a bucketed table writes one file per bucket
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  checkpoint_dir: str | None = None, extra: dict | None = None,
                  app_name: str = "cardlake") -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def sizing(largest_shuffle_bytes: int, target_partition_bytes: int = 256 * 1024 ** 2,
           split_bytes: int = 512 * 1024 ** 2) -> dict[str, str]:
    """Settings for a run whose largest shuffle moves ``largest_shuffle_bytes``
    (the de-duplicated transactions): enough shuffle partitions that each holds
    about ``target_partition_bytes``, AQE aiming at the same size when it
    coalesces, and input splits of ``split_bytes``. Use the returned shuffle
    partition count as the pipeline's bucket count too (its default), so the
    de-duplication shuffle lays out the buckets.

    Example: 40 TB of transactions -> 163,840 partitions of 256 MB."""
    parts = max(1, -(-largest_shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the session's checkpoint folder; set ``fallback`` only if none is set."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not fallback:
        raise RuntimeError("spark.checkpoint.dir is not set; pass a shared folder")
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


_scratch_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run; of the warehouse, which is shared too, where
    no checkpoint folder is named."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # sessions without a SparkContext handle (Spark Connect)
            base = None
    if not base:
        base = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_cardlake_scratch")
    path = f"{base.rstrip('/')}/cardlake/{label}-{uuid.uuid4().hex[:12]}"
    _scratch_made.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this process made, once their results are written or collected (frames over
    them cannot be read afterwards). The number of folders deleted."""
    hadoop, deleted = spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _scratch_made:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_made.pop())
        deleted += bool(folder.getFileSystem(hadoop).delete(folder, True))
    return deleted


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per Spark context, so that Python tasks can
    import them whatever folder the workers start in."""
    sc = spark.sparkContext
    if getattr(sc, "_cardlake_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # executors fetch the file from the driver as they start, so it stays until the driver ends
    folder = tempfile.mkdtemp(prefix="cardlake-py-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "cardlake_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(os.path.join(root, "cardlake")):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(at, name), os.path.relpath(os.path.join(at, name), root))
    sc.addPyFile(path)
    sc._cardlake_shipped = True
