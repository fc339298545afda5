"""The semantic model's measures and the report visuals' implicit aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.functions.rules import money_sum


def average_credit_score(c: str = "credit_score") -> Column:
    return F.avg(c)


def fraud_transactions(c: str = "is_fraud") -> Column:
    """Rows flagged fraud. The model's filtered row count is blank on an empty
    set; here it is 0."""
    return F.count(F.when(F.col(c) == 1, F.lit(1)))


def transaction_count(c: str = "transaction_id") -> Column:
    return F.count(c)


def distinct_customers(c: str = "id") -> Column:
    return F.count_distinct(F.col(c))


def distinct_state(df: DataFrame, keys: list[str], c: str) -> DataFrame:
    """A mergeable state of exact distinct counts: per key and bucket of 32,768 ids, a bitmap of the ids seen. Kept per
    day, it answers any longer span without the fact; NULL ids are not counted."""
    seen = df.where(F.col(c).isNotNull()).select(
        *keys, F.bitmap_bucket_number(c).alias("bucket"), F.bitmap_bit_position(c).alias("position"))
    return seen.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("position").alias("ids"))


def merged_distinct(state: DataFrame, keys: list[str | Column], name: str) -> DataFrame:
    """Distinct ids per (coarser) key, from the states' bitmaps alone."""
    merged = state.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    out = [c for c in merged.columns if c not in ("bucket", "ids")]
    return merged.groupBy(*out).agg(F.sum(F.bitmap_count("ids")).alias(name))


def distinct_customers_by_month(transactions: DataFrame) -> DataFrame:
    """Customers with transactions, per month and in all, merged from one state per day."""
    state = distinct_state(transactions, ["transaction_date"], "client_id")
    month = [F.year("transaction_date").alias("transaction_year"), F.month("transaction_date").alias("transaction_month")]
    by_month = merged_distinct(state, month, "distinct_customers").withColumn("span", F.lit("month"))
    total = merged_distinct(state, [], "distinct_customers").select(
        F.lit(None).cast("int").alias("transaction_year"), F.lit(None).cast("int").alias("transaction_month"),
        F.coalesce("distinct_customers", F.lit(0)).cast("long").alias("distinct_customers"), F.lit("all").alias("span"))
    return by_month.unionByName(total)


# Visual aggregation codes (0 = sum, 5 = count of non-blank values).
VISUAL_SUM = 0
VISUAL_COUNT_NON_NULL = 5


def visual_aggregate(code: int, c: str) -> Column:
    if code == VISUAL_SUM:
        return money_sum(c)
    if code == VISUAL_COUNT_NON_NULL:
        return F.count(c)
    raise ValueError(f"unsupported visual aggregation code {code}")
