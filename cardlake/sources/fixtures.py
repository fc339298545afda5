"""Raw banking frames derived from the driver's TPC-H-like tables.

Value rules inject the dirty shapes the cleaning layer must handle (duplicate keys with
different content, unparseable money and dates, padded flags, NULL states,
codes without a category, lower-case labels). Every row of the input
is read; fraud labels exist, as in the source, for part of the transactions only (line items
with return flag R or A). The same rules are written as
SQL in ``cardlake.plans.oracle`` for the independent DuckDB check.

Raw column types follow what a header CSV read with schema inference gives:
numeric ids stay numeric, money / dates / flags stay text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("customer", "orders", "lineitem", "supplier", "nation", "part")


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money_text(x: Column) -> Column:
    """Whole dollars as ``$12,345`` text."""
    return F.concat(
        F.lit("$"),
        F.floor(x / 1000).cast("long").cast("string"),
        F.lit(","),
        F.lpad((x % 1000).cast("string"), 3, "0"),
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_driver(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        # every 50th customer shares the id of its neighbour: same key, other content
        F.when(k % 50 == 49, k - 1).otherwise(k).alias("id"),
        (18 + k % 73).cast("int").alias("current_age"),
        (60 + k % 11).cast("int").alias("retirement_age"),
        (1930 + k % 73).cast("int").alias("birth_year"),
        (1 + k % 12).cast("int").alias("birth_month"),
        F.when(k % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.col("c_name").alias("address"),
        (25 + k % 24).cast("double").alias("latitude"),
        (-70 - k % 50).cast("double").alias("longitude"),
        _money_text(10000 + (k * 131) % 60000).alias("per_capita_income"),
        F.when(k % 97 == 0, "$0")
        .when(k % 101 == 100, "unknown")
        .otherwise(_money_text(20000 + (k * 7919) % 130000))
        .alias("yearly_income"),
        _money_text(1000 + (k * 4241) % 120000).alias("total_debt"),
        (480 + (k * 53) % 371).cast("int").alias("credit_score"),
        (1 + k % 9).cast("int").alias("num_credit_cards"),
    )


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver(spark, sf_dir, "orders")
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        k.alias("id"),
        # every 37th customer's cards are booked on its neighbour: users without a card
        F.when(cust % 37 == 36, cust - 1).otherwise(cust).alias("client_id"),
        # every 23rd customer has only zero-limit cards: NULL utilization; some limits are no number or below a cent
        F.when(cust % 23 == 0, "$0").when(k % 1009 == 5, "NaN").when(k % 1013 == 6, "$0.004")
        .otherwise(_money_text(500 + (k * 613) % 20000)).alias("credit_limit"),
        (1 + k % 3).cast("int").alias("num_cards_issued"),
        F.when(k % 1000 == 4, "13/2020").otherwise(F.date_format("o_orderdate", "MM/yyyy")).alias("acct_open_date"),
        F.concat(F.lpad((1 + k % 12).cast("string"), 2, "0"), F.lit("/"), (2020 + k % 10).cast("string")).alias(
            "expires"
        ),
        F.when(k % 12 == 0, "YES").when(k % 12 == 4, " no ").otherwise("n/a").alias("has_chip"),
        F.when(k % 40 == 0, "Yes").otherwise("No").alias("card_on_dark_web"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_driver(spark, sf_dir, "lineitem")
    o = read_driver(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    s = read_driver(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_driver(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(s, li.l_suppkey == s.s_suppkey)
        .join(n, s.s_nationkey == n.n_nationkey)
    )
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    minutes = (part % 1440).cast("int")
    when_text = F.date_format(
        F.col("l_shipdate") + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), minutes, F.lit(0)),
        "MM-dd-yyyy HH:mm",
    )
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.when(part % 997 == 0, "not a date").otherwise(when_text).alias("date"),
        F.col("o_custkey").alias("client_id"),
        F.col("l_orderkey").alias("card_id"),
        F.when(part % 503 == 0, "")
        .when(part % 499 == 0, "$0.00")
        .when(supp % 7 == 0, F.concat(F.lit("$-"), price))
        .otherwise(F.concat(F.lit("$"), price))
        .alias("amount"),
        F.when(F.col("l_linenumber") % 3 == 0, "Swipe")
        .when(F.col("l_linenumber") % 3 == 1, "Chip")
        .otherwise("Online")
        .alias("use_chip"),
        supp.alias("merchant_id"),
        F.col("s_name").alias("merchant_city"),
        F.when(F.col("s_nationkey") % 9 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias(
            "merchant_state"
        ),
        (10000 + supp).cast("string").alias("zip"),
        (part % 120).cast("int").alias("mcc"),
    )


def raw_mcc_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per code 0..99 (the whole part table folded onto 100 codes);
    transaction codes 100..119 therefore have no category."""
    p = read_driver(spark, sf_dir, "part")
    code = (F.col("p_partkey") % 100).cast("int")
    label = F.concat(F.lit(" "), F.col("p_type"), F.lit(" "), F.col("p_brand"), F.lit(" "))
    return (
        p.groupBy(code.alias("mcc"))
        .agg(F.min(label).alias("category"))
        .select("mcc", F.when(F.col("mcc") % 33 == 32, F.lit(None).cast("string")).otherwise(F.col("category")).alias("category"))
    )


def raw_fraud_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels exist for returned/accepted line items only (flag R or A)."""
    li = read_driver(spark, sf_dir, "lineitem")
    label = (
        F.when(F.col("l_partkey") % 251 == 0, "yes").when(F.col("l_returnflag") == "R", "Yes").otherwise("No")
    )
    tid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return (
        li.filter(F.col("l_returnflag") != "N")
        .groupBy(tid.alias("tid"))
        .agg(F.min(label).alias("fraud_label"))
        .select(F.col("tid").cast("string").alias("transaction_id"), "fraud_label")
    )


RAW_BUILDERS = {
    "users": raw_users,
    "cards": raw_cards,
    "transactions": raw_transactions,
    "mcc_codes": raw_mcc_codes,
    "fraud_labels": raw_fraud_labels,
}


def raw_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}
