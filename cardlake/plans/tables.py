"""Table sinks and DDL: overwrite, schema-merging overwrite, schemas, external
tables and views.

Tables are written as Parquet at an explicit location (so on a cluster they
live in shared storage, never on a machine-local disk). Every write is a full
overwrite of a folder: re-running a failed job gives the same table.

``publish_table`` replaces a table that others read: every version is a table and folder of its own, and the
name is a view that one catalog step turns to the new version. A write that fails leaves the name as it
was; a reader that began before keeps its files until the version after the next is published.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def create_schema(spark: SparkSession, name: str, location: str | None = None, use: bool = False) -> None:
    """Idempotent namespace set-up; ``location`` keeps the schema folder in
    shared storage instead of the session's default warehouse folder."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")
    if use:
        spark.catalog.setCurrentDatabase(name)


def overwrite_table(df: DataFrame, name: str, path: str, fmt: str = "parquet",
                    bucket_by: tuple[int, str] | None = None, cluster_by: tuple[str, ...] = ()) -> str:
    """Replace table contents and schema. ``bucket_by=(n, col)`` stores the
    table hash-bucketed on ``col`` so later joins/aggregations on it can skip
    their shuffle. ``cluster_by`` sorts rows within each written file (a local
    sort, no shuffle) so Parquet row-group statistics let pushed-down filters
    on those columns skip row groups."""
    if cluster_by and not bucket_by:
        df = df.sortWithinPartitions(*cluster_by)
    w = df.write.mode("overwrite").format(fmt).option("path", path)
    if bucket_by:
        n, col = bucket_by
        w = w.bucketBy(n, col).sortBy(col)
    w.saveAsTable(name)
    return name


VERSION, PREVIOUS = "cardlake.version", "cardlake.previous"
FIRST = "first"  # the version that lies in the table's own folder; later ones lie beside it


def _delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _version_folder(path: str, version: str) -> str:
    return path if version == FIRST else f"{path}_v{version}"


def _drop_version(spark: SparkSession, name: str, path: str, version: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}_v{version}")
    _delete_folder(spark, _version_folder(path, version))


def published_versions(spark: SparkSession, name: str) -> tuple[str | None, str | None]:
    """The published version of a name, and the one before it."""
    if not spark.catalog.tableExists(name):
        return None, None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return found.get(VERSION), found.get(PREVIOUS) or None


def publish_table(df: DataFrame, name: str, path: str, bucket_by: tuple[int, str] | None = None,
                  cluster_by: tuple[str, ...] = ()) -> str:
    """Write ``df`` as a new version of ``name`` at or beside ``path`` and turn the name to it. The version before is
    kept for its readers; older ones go. ``bucket_by`` and ``cluster_by`` as in ``overwrite_table``."""
    spark = df.sparkSession
    now, before = published_versions(spark, name)
    version = uuid.uuid4().hex[:12] if spark.catalog.tableExists(name) else FIRST
    try:
        overwrite_table(df, f"{name}_v{version}", _version_folder(path, version), bucket_by=bucket_by, cluster_by=cluster_by)
    except Exception:
        _drop_version(spark, name, path, version)
        raise
    if now is None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # a plain table of that name, written by overwrite_table
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{version}', '{PREVIOUS}' = '{now or ''}') "
              f"AS SELECT * FROM {name}_v{version}")
    if before:
        _drop_version(spark, name, path, before)
    return name


def analyze(spark: SparkSession, name: str, columns: tuple[str, ...] = ()) -> None:
    """Row counts, sizes and column statistics of a table, or of the version a published name stands for, for the
    engine's choice of joins."""
    version, _ = published_versions(spark, name)
    what = f"FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {name}{f'_v{version}' if version else ''} COMPUTE STATISTICS {what}")


def merged_schema_frame(new: DataFrame, old_schema: StructType) -> DataFrame:
    """Old columns first (their order kept), new columns appended; columns
    only in the old table come back as NULL. Only the old *schema* is used,
    never its rows, so the target can be overwritten in the same job."""
    spark = new.sparkSession
    empty_old = spark.createDataFrame([], old_schema)
    merged = empty_old.unionByName(new, allowMissingColumns=True)
    old_names = [f.name for f in old_schema.fields]
    return merged.select(*old_names, *[c for c in new.columns if c not in old_names])


def overwrite_merge_schema(spark: SparkSession, df: DataFrame, name: str, path: str) -> str:
    """Overwrite rows, keep the union of old and new columns."""
    if spark.catalog.tableExists(name):
        df = merged_schema_frame(df, spark.table(name).schema)
    return overwrite_table(df, name, path)


def publish_merge_schema(spark: SparkSession, df: DataFrame, name: str, path: str) -> str:
    """``publish_table`` with the union of old and new columns."""
    if spark.catalog.tableExists(name):
        df = merged_schema_frame(df, spark.table(name).schema)
    return publish_table(df, name, path)


def external_table(spark: SparkSession, name: str, columns_ddl: str, location: str) -> str:
    """Drop-if-exists, then declare a Parquet table with fixed columns over a folder."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns_ddl}) USING parquet LOCATION '{location}'")
    return name


def create_view(spark: SparkSession, name: str, select_sql: str, replace: bool = False) -> str:
    """Create a view if absent (or replace it)."""
    verb = "CREATE OR REPLACE VIEW" if replace else "CREATE VIEW IF NOT EXISTS"
    spark.sql(f"{verb} {name} AS {select_sql}")
    return name
