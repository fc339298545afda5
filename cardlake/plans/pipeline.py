"""Batch pipeline: raw -> silver tables -> gold tables, then serving views.

Layers hand off through tables in shared storage (this also cuts lineage:
gold plans start from the silver files, not from the raw text). Tables whose
key is unique per row are stored hash-bucketed on it, all with the same
bucket count, so the gold fraud join (transactions x labels on the
transaction id) reads co-located buckets instead of shuffling the largest
table again. Nothing is bucketed on a key that can
be skewed (client ids): one hot client would become one huge bucket.

The bucket count defaults to ``spark.sql.shuffle.partitions``: the silver
de-duplication already hash-partitions on the key into that many
partitions, so each bucket is written by exactly one task (one file per
bucket, no extra shuffle before the write).

Gold transactions is the column projection of gold fraud monitoring (same
rows, same key, minus the two label columns), so it is served as a view over
that table instead of being stored twice.

A failed or lost task simply recomputes: every write is a new version in a folder of its own, and the
table's name is turned to it once it is whole, so re-running a stage is idempotent and readers never see
half a table. Statistics of the join keys are taken after each layer of ``run``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession

from cardlake.operators import gold as G
from cardlake.operators import quality as Q
from cardlake.operators import silver as S
from cardlake.plans import serving as SV
from cardlake.plans import tables as T

SILVER_KEYS = {"users": "id", "cards": "id", "transactions": "id", "fraud_labels": "transaction_id",
               "mcc_codes": None}
# Gold tables are not bucketed: a bucketed side would keep AQE from splitting the skewed fact side of a join.
GOLD_KEYS = {"users": None, "credit_utilization": None, "fraud_monitoring": None}
# Only the two tables of the fact-to-fact join need the full bucket count.
FACT_TABLES = ("transactions", "fraud_labels")
DIM_BUCKET_DIVISOR = 16
MAX_BUCKETS = 65_536  # below the engine's limit of 100,000


@dataclass(frozen=True)
class PipelineConfig:
    out_dir: str               # shared folder that holds the table files
    schema: str = "cardlake"   # catalog schema for the table names
    buckets: int | None = None  # hash buckets of uniquely keyed tables (default: shuffle partitions)
    concurrent_writes: int = 4  # independent table writes of one layer submitted as concurrent jobs
    rejects: bool = False      # count rejects in the silver jobs, and keep the rejected values
    statistics: bool = True    # row counts and key statistics after each layer of ``run``


def _name(cfg: PipelineConfig, layer: str, table: str) -> str:
    return f"{cfg.schema}.{layer}_{table}"


def _buckets(df: DataFrame, cfg: PipelineConfig, table: str) -> int:
    """Hash buckets of a table: the shuffle partition count, so that the de-duplication shuffle lays
    out the buckets; halved until the engine accepts it (each bucket then gets the files of
    several tasks). Dimension tables take a sixteenth: same hash, larger files."""
    n = cfg.buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while n > MAX_BUCKETS:
        n = -(-n // 2)
    return n if table in FACT_TABLES else max(1, n // DIM_BUCKET_DIVISOR)


# Within-file order of unbucketed gold tables: the fraud table is filtered on
# is_fraud (a small share of rows) and then matched on client_id.
GOLD_CLUSTER = {"fraud_monitoring": ("is_fraud", "client_id")}


def _write(df: DataFrame, cfg: PipelineConfig, layer: str, table: str, key: str | None) -> str:
    name = _name(cfg, layer, table)
    cluster = GOLD_CLUSTER.get(table, ()) if layer == "gold" else ()
    T.publish_table(df, name, f"{cfg.out_dir}/{layer}/{table}",
                    bucket_by=(_buckets(df, cfg, table), key) if key else None, cluster_by=cluster)
    return name


def _run_all(jobs: dict[str, Callable[[], str]], cfg: PipelineConfig) -> dict[str, str]:
    """Independent writes of one layer as concurrent Spark jobs (small stages of
    one table fill task slots left idle by another); order of results is fixed."""
    if cfg.concurrent_writes <= 1:
        return {k: job() for k, job in jobs.items()}
    with ThreadPoolExecutor(max_workers=cfg.concurrent_writes) as pool:
        futures = {k: pool.submit(job) for k, job in jobs.items()}
        return {k: f.result() for k, f in futures.items()}


def write_bronze(spark: SparkSession, raw: dict[str, DataFrame], cfg: PipelineConfig) -> dict[str, str]:
    """Persist the raw frames as read (bronze), one table per source."""
    T.create_schema(spark, cfg.schema, f"{cfg.out_dir}/_schema")
    return _run_all({t: (lambda t=t: _write(raw[t], cfg, "bronze", t, None)) for t in raw}, cfg)


def write_silver(spark: SparkSession, raw: dict[str, DataFrame], cfg: PipelineConfig) -> dict[str, str]:
    T.create_schema(spark, cfg.schema, f"{cfg.out_dir}/_schema")
    seen = {t: Q.observed(raw[t], S.TYPED[t](), t) for t in S.CLEANERS} if cfg.rejects else {}
    source = {t: seen[t][0] if seen else raw[t] for t in S.CLEANERS}
    jobs = {
        t: (lambda t=t: _write(S.CLEANERS[t](source[t]), cfg, "silver", t, SILVER_KEYS[t]))
        for t in S.CLEANERS
    }
    names = _run_all(jobs, cfg)
    if seen:
        write_rejects(spark, raw, {t: observation for t, (_, observation) in seen.items()}, cfg)
    return names


def write_rejects(spark: SparkSession, raw: dict[str, DataFrame], seen: dict[str, Observation],
                  cfg: PipelineConfig) -> tuple[str, str]:
    """Tables ``silver_rejects`` (counts, as the silver jobs observed them) and ``silver_quarantine`` (the rejected
    values). Raw is read again only for tables with rejects, and of those only the columns that have any."""
    counts = reduce(DataFrame.unionByName, [Q.observed_counts(spark, o, t) for t, o in seen.items()])
    rejected = _write(counts, cfg, "silver", "rejects", None)
    rows = spark.createDataFrame([], "table_name string, column_name string, row_key string, raw_text string")
    for t, observation in seen.items():
        typed = {c: e for c, e in S.TYPED[t]().items() if observation.get[c]}
        if typed:
            rows = rows.unionByName(Q.reject_rows(raw[t], typed, t, S.KEYS[t]))
    return rejected, _write(rows, cfg, "silver", "quarantine", None)


def read_tables(spark: SparkSession, names: dict[str, str]) -> dict[str, DataFrame]:
    return {t: spark.table(n) for t, n in names.items()}


def write_gold(spark: SparkSession, silver_names: dict[str, str], cfg: PipelineConfig) -> dict[str, str]:
    silver = read_tables(spark, silver_names)
    names = _run_all({
        "users": lambda: _write(G.gold_users(silver["users"]), cfg, "gold", "users", GOLD_KEYS["users"]),
        "credit_utilization": lambda: _write(
            G.gold_credit_utilization(silver["users"], silver["cards"]), cfg, "gold", "credit_utilization",
            GOLD_KEYS["credit_utilization"],
        ),
        "fraud_monitoring": lambda: _write(
            G.gold_fraud_monitoring(silver["transactions"], silver["fraud_labels"], silver["mcc_codes"]),
            cfg, "gold", "fraud_monitoring", GOLD_KEYS["fraud_monitoring"],
        ),
    }, cfg)
    txn = _name(cfg, "gold", "transactions")
    cols = ", ".join(G.TRANSACTIONS_COLUMNS_SUPERSET)
    T.create_view(spark, txn, f"SELECT {cols} FROM {names['fraud_monitoring']}", replace=True)
    names["transactions"] = txn
    return names


def run(spark: SparkSession, raw: dict[str, DataFrame], cfg: PipelineConfig,
        with_bronze: bool = False) -> dict[str, DataFrame]:
    """Raw frames in, persisted gold tables out (as DataFrames), serving views
    in the catalog (created if absent) and in the session. ``with_bronze`` first persists the raw frames as bronze tables
    and cleans from those."""
    if with_bronze:
        raw = read_tables(spark, write_bronze(spark, raw, cfg))
    silver_names = write_silver(spark, raw, cfg)
    if cfg.statistics:
        for t, name in silver_names.items():
            T.analyze(spark, name, (S.KEYS[t],))
    gold_names = write_gold(spark, silver_names, cfg)
    if cfg.statistics:
        for t in GOLD_KEYS:
            T.analyze(spark, gold_names[t])
    gold = read_tables(spark, gold_names)
    SV.create_views(spark, gold_names, cfg.schema)
    SV.register_views(spark, gold)
    return gold
