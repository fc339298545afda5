"""Shared small pieces: reading a driver table, Arrow batch bounds, scratch folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardlake.session import ensure_checkpoint_dir, scratch_path, ship_package

MAX_BATCH_ROWS = 500
MAX_BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_tasks(spark: SparkSession) -> None:
    """Get the session ready for Python tasks: the package on the executors, small batches."""
    ship_package(spark)
    bound_batches(spark)


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches to Python small in rows and bytes, so that a task's memory
    does not follow the length of the texts. Lower settings of the user stay."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", MAX_BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", MAX_BATCH_BYTES)):
        now = spark.conf.get(key, None)
        digits = (now or "").rstrip("bB")
        if not digits.isdigit() or int(digits) > most or int(digits) <= 0:
            spark.conf.set(key, str(most))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the session's shared checkpoint folder and
    read it back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark, None)
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    """The session's shuffle partition count: how the cluster was sized for its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
