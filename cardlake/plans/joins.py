"""The star relationships of the model and pre-aggregated look-ups along them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Relationship:
    """Many-to-one link from a fact column to a dimension key."""

    fact: str
    fact_column: str
    dim: str
    dim_column: str


# The model's relationships: transactions is the fact, the other gold tables
# are looked up from it.
RELATIONSHIPS = (
    Relationship("transactions", "client_id", "credit_utilization", "customer_id"),
    Relationship("transactions", "client_id", "users", "id"),
    Relationship("transactions", "transaction_id", "fraud_monitoring", "transaction_id"),
)


def relationship(dim: str, fact: str = "transactions") -> Relationship:
    for r in RELATIONSHIPS:
        if r.fact == fact and r.dim == dim:
            return r
    raise KeyError(f"no relationship {fact} -> {dim}")


def fact_measure_by_dim_attribute(
    gold: dict[str, DataFrame],
    dim: str,
    attribute: str,
    partial_aggs: dict,
    final_aggs: dict,
    fact: str = "transactions",
) -> DataFrame:
    """Group a fact measure by an attribute of a looked-up dimension.

    The fact is aggregated per relationship key first (partial aggregation on
    the map side, so a customer holding a third of all rows costs one row per
    task), then the per-key results (one row per key) are left-joined to the
    dimension and re-aggregated by the attribute. Unmatched fact keys land in
    the NULL attribute group, as in a left join from the fact.

    ``partial_aggs``: name -> aggregate over fact rows per key;
    ``final_aggs``: name -> aggregate over the per-key rows.
    """
    r = relationship(dim, fact)
    per_key = gold[fact].groupBy(F.col(r.fact_column).alias("__k")).agg(
        *[e.alias(n) for n, e in partial_aggs.items()]
    )
    d = gold[dim].select(F.col(r.dim_column).alias("__dk"), F.col(attribute))
    joined = per_key.join(d, per_key["__k"] == d["__dk"], "left")
    return joined.groupBy(attribute).agg(*[e.alias(n) for n, e in final_aggs.items()])
