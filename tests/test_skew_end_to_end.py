"""Hot keys through the whole chain: one customer holds a third of all
transactions and one transaction id is copied onto a sixth of the rows.
Spark results must equal the SQL definitions fed the same skewed raw rows."""

import math

import pytest
from pyspark.sql import functions as F

from cardlake.plans import oracle as O
from cardlake.plans import registry
from cardlake.plans.layers import Layers
from cardlake.sources import fixtures

SF = "/root/testdata/sf0.001"
HOT_CLIENT, HOT_ID = 1, 77

SKEWED_SQL = f"""
SELECT CASE WHEN id % 6 = 1 THEN {HOT_ID} ELSE id END AS id, date,
  CASE WHEN id % 3 = 0 THEN {HOT_CLIENT} ELSE client_id END AS client_id,
  card_id, amount, use_chip, merchant_id, merchant_city, merchant_state, zip, mcc
FROM ({O.RAW_TRANSACTIONS})"""

QUERIES = ["silver_transactions", "gold_fraud_monitoring", "report_transactions_by_band",
           "report_transactions_by_segment", "report_companion_customers_by_band",
           "report_fraud_investigation", "report_monthly_debit_credit", "report_labelled_by_state_category"]


def skewed_layers(spark):
    raw = fixtures.raw_transactions(spark, SF)
    raw = raw.select(
        F.when(F.col("id") % 6 == 1, F.lit(HOT_ID).cast("long")).otherwise(F.col("id")).alias("id"), "date",
        F.when(F.col("id") % 3 == 0, F.lit(HOT_CLIENT).cast("long")).otherwise(F.col("client_id")).alias("client_id"),
        "card_id", "amount", "use_chip", "merchant_id", "merchant_city", "merchant_state", "zip", "mcc")
    L = Layers.from_driver_tables(spark, SF)
    L._raw["transactions"] = raw
    return L


def norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return repr(v.isoformat() if hasattr(v, "isoformat") else v)


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_input_matches_sql(spark, duck, name):
    L = skewed_layers(spark)
    if name.startswith("report_"):
        from cardlake.plans import reports as RP

        df = RP.REPORTS[name](L.gold_map)
    elif name.startswith("gold_"):
        df = L.gold(name[len("gold_"):])
    else:
        df = L.silver(name[len("silver_"):])
    assert name in registry.spark_queries()
    res = duck.execute(O.oracle_queries({"raw_transactions": SKEWED_SQL})[name])
    onames = [d[0] for d in res.description]
    assert canon(df.columns, df.collect()) == canon(onames, res.fetchall())


def test_hot_customer_really_is_a_third(spark):
    L = skewed_layers(spark)
    t = L.raw("transactions")
    total, hot = t.count(), t.filter(F.col("client_id") == HOT_CLIENT).count()
    assert hot * 3 >= total - 3
