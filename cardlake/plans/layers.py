"""Lazy access to every layer of the model for one input.

``Layers`` builds raw -> silver -> gold frames on first use only, so a report
that needs two gold tables never plans the others. Frames
are plain lazy DataFrames; nothing is cached or collected here.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cardlake.operators import gold as G
from cardlake.operators import silver as S
from cardlake.sources import fixtures


class Layers:
    def __init__(self, raw: dict[str, DataFrame] | None = None, silver: dict[str, DataFrame] | None = None,
                 gold: dict[str, DataFrame] | None = None):
        self._raw = raw or {}
        self._silver = dict(silver or {})
        self._gold = dict(gold or {})

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str) -> "Layers":
        return cls(raw=_LazyRaw(spark, sf_dir))

    # raw -------------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return self._raw[name]

    # silver ----------------------------------------------------------
    def silver(self, name: str) -> DataFrame:
        if name not in self._silver:
            self._silver[name] = S.CLEANERS[name](self.raw(name))
        return self._silver[name]

    # gold ------------------------------------------------------------
    def gold(self, name: str) -> DataFrame:
        if name not in self._gold:
            build = {
                "users": lambda: G.gold_users(self.silver("users")),
                "transactions": lambda: G.gold_transactions(self.silver("transactions"), self.silver("mcc_codes")),
                "credit_utilization": lambda: G.gold_credit_utilization(self.silver("users"), self.silver("cards")),
                "fraud_monitoring": lambda: G.gold_fraud_monitoring(
                    self.silver("transactions"), self.silver("fraud_labels"), self.silver("mcc_codes")
                ),
            }[name]
            self._gold[name] = build()
        return self._gold[name]

    @cached_property
    def gold_map(self) -> "_GoldMap":
        return _GoldMap(self)


class _GoldMap(dict):
    """dict-like view that builds gold tables on access (reports take a dict)."""

    def __init__(self, layers: Layers):
        super().__init__()
        self._layers = layers

    def __getitem__(self, name: str) -> DataFrame:
        return self._layers.gold(name)

    def __contains__(self, name: object) -> bool:
        return name in ("users", "transactions", "credit_utilization", "fraud_monitoring")


class _LazyRaw(dict):
    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        if not dict.__contains__(self, name):
            dict.__setitem__(self, name, fixtures.RAW_BUILDERS[name](self._spark, self._dir))
        return dict.__getitem__(self, name)

    def __bool__(self) -> bool:
        return True
