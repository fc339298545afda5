"""Every registered query as ``(spark, sf_dir) -> DataFrame``.

Each call plans from the driver tables through raw -> silver -> gold, so
its work grows with the input. The matching DuckDB SQL lives in
``cardlake.plans.oracle``; keys are shared.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cardlake.operators import gold as G
from cardlake.operators import quality
from cardlake.operators import silver as S
from cardlake.operators.dedup import dedup_by_key
from cardlake.operators.quality import reject_counts
from cardlake.plans import measures as M
from cardlake.plans import reports as RP
from cardlake.plans import serving as SV
from cardlake.plans.layers import Layers
from cardlake.plans.roundtrip import ROUNDTRIP_QUERIES

Query = Callable[[SparkSession, str], DataFrame]


def _layers(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers.from_driver_tables(spark, sf_dir)


def _silver(name: str) -> Query:
    return lambda spark, d: _layers(spark, d).silver(name)


def _gold(name: str, project: Callable[[DataFrame], DataFrame] | None = None) -> Query:
    def q(spark: SparkSession, d: str) -> DataFrame:
        df = _layers(spark, d).gold(name)
        return project(df) if project else df

    return q


def _report(fn: Callable[[dict], DataFrame]) -> Query:
    return lambda spark, d: fn(_layers(spark, d).gold_map)


def reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = _layers(spark, sf_dir)
    parts = [reject_counts(L.raw(name), typed(), name) for name, typed in S.TYPED.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = _layers(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        quality.reject_rows(L.raw(name), typed(), name, S.KEYS[name]) for name, typed in S.TYPED.items()])


def spark_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name in ("users", "cards", "transactions", "mcc_codes", "fraud_labels"):
        q[f"silver_{name}"] = _silver(name)
    q["dedup_transactions"] = lambda spark, d: dedup_by_key(_layers(spark, d).raw("transactions"), "id")
    q["reject_report"] = reject_report
    q["reject_rows"] = reject_rows
    q["card_totals"] = lambda spark, d: G.card_totals(_layers(spark, d).silver("cards"))
    q["gold_users"] = _gold("users")
    q["gold_transactions"] = _gold("transactions")
    q["gold_transactions_a"] = _gold("transactions", G.transactions_variant_a)
    q["gold_transactions_b"] = _gold("transactions", G.transactions_variant_b)
    q["gold_credit_utilization"] = _gold("credit_utilization")
    q["gold_fraud_monitoring"] = _gold("fraud_monitoring")
    q["gold_fraud_a"] = _gold("fraud_monitoring", G.fraud_variant_a)
    q["gold_fraud_b"] = _gold("fraud_monitoring", G.fraud_variant_b)
    for view, (src, build) in SV.VIEWS.items():
        q[view] = _gold(src, build)
    q["preview_fraud_monitoring"] = _gold(
        "fraud_monitoring", lambda df: SV.preview(SV.fraud_monitoring_view(df), 10, "transaction_id")
    )
    q["measure_average_credit_score"] = _gold(
        "credit_utilization", lambda df: df.agg(M.average_credit_score().alias("average_credit_score"))
    )
    q["measure_fraud_transactions"] = _gold(
        "fraud_monitoring", lambda df: df.agg(M.fraud_transactions().alias("fraud_transactions"))
    )
    q["measure_transaction_count"] = _gold(
        "transactions", lambda df: df.agg(M.transaction_count().alias("total_transactions"))
    )
    q["measure_distinct_customers"] = _gold(
        "users", lambda df: df.agg(M.distinct_customers().alias("total_customers"))
    )
    q["measure_distinct_customers_by_month"] = _gold("transactions", M.distinct_customers_by_month)
    for name, fn in RP.REPORTS.items():
        q[name] = _report(fn)
    q.update(ROUNDTRIP_QUERIES)
    return q
