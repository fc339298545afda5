"""Versions behind a name, catalog views, observed rejects, statistics, mergeable distinct counts."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from cardlake.operators import quality as Q
from cardlake.operators import silver as S
from cardlake.plans import measures as M
from cardlake.plans import pipeline as PL
from cardlake.plans import serving as SV
from cardlake.plans import tables as T
from cardlake.plans.layers import Layers
from cardlake.session import scratch_path
from cardlake.sources import fixtures

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def published(spark):
    cfg = PL.PipelineConfig(out_dir=scratch_path(spark, "published"), schema="cardlake_published", rejects=True)
    return cfg, PL.run(spark, fixtures.raw_frames(spark, SF), cfg)


def test_readers_keep_their_rows_and_old_versions_go(spark):
    T.create_schema(spark, "cardlake_p", scratch_path(spark, "schema"))
    name, path = "cardlake_p.numbers", scratch_path(spark, "numbers")
    T.publish_table(spark.range(3), name, path)
    reader = spark.table(name)
    T.publish_table(spark.range(5).withColumn("x", F.lit("new")), name, path)
    assert rows(reader) == [(0,), (1,), (2,)]  # planned before, run after
    assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 5
    for n in (7, 8):
        T.publish_table(spark.range(n), name, path)
    assert spark.table(name).count() == 8 and len(glob.glob(f"{path}*")) == 2
    assert len([t for t in spark.catalog.listTables("cardlake_p") if t.name.startswith("numbers_v")]) == 2


def test_a_failed_write_leaves_the_old_version(spark):
    T.create_schema(spark, "cardlake_p", scratch_path(spark, "schema"))
    name, path = "cardlake_p.kept", scratch_path(spark, "kept")
    T.publish_table(spark.range(3), name, path)
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("killed"))).alias("id"))
    with pytest.raises(Exception, match="killed"):
        T.publish_table(broken, name, path)
    assert rows(spark.table(name)) == [(0,), (1,), (2,)] and len(glob.glob(f"{path}*")) == 1
    T.publish_merge_schema(spark, spark.range(2).withColumn("y", F.lit(1)), name, path)
    assert rows(spark.table(name)) == [(0, 1), (1, 1)]


def test_a_plain_table_can_be_published_over(spark):
    T.create_schema(spark, "cardlake_p", scratch_path(spark, "schema"))
    path = scratch_path(spark, "plain")
    T.overwrite_table(spark.range(2), "cardlake_p.plain", path)
    T.publish_table(spark.range(4), "cardlake_p.plain", path)
    assert spark.table("cardlake_p.plain").count() == 4


def test_views_are_in_the_catalog_and_follow_the_tables(spark, published):
    cfg, gold = published
    other = spark.newSession()
    for view, (table, build) in SV.VIEWS.items():
        want = build(gold[table])
        got = other.table(f"{cfg.schema}.{view}")
        assert got.schema.simpleString() == want.schema.simpleString(), view
        assert rows(got) == rows(want) and got.count(), view
    before = other.table(f"{cfg.schema}.vw_customer_segmentation").count()
    T.publish_table(gold["users"].limit(5), f"{cfg.schema}.gold_users", f"{cfg.out_dir}/gold/users")
    assert other.table(f"{cfg.schema}.vw_customer_segmentation").count() == 5 != before


def test_observed_rejects_and_quarantine(spark, published):
    cfg, _ = published
    raw = Layers.from_driver_tables(spark, SF)
    counts = [Q.reject_counts(raw.raw(t), S.TYPED[t](), t) for t in S.CLEANERS]
    want = sorted(r for c in counts for r in rows(c))
    assert rows(spark.table(f"{cfg.schema}.silver_rejects")) == want and sum(n for *_, n in want)
    listed = spark.table(f"{cfg.schema}.silver_quarantine")
    again = listed.groupBy("table_name", "column_name").count()
    assert rows(again) == [r for r in want if r[2]]
    assert listed.where("raw_text IS NULL OR trim(raw_text) = ''").count() == 0


def test_observed_frame_reads_raw_once(spark):
    raw = fixtures.raw_users(spark, SF)
    df, _ = Q.observed(raw, S.users_typed(), "users")
    plan = S.clean_users(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CollectMetrics") == 1 and plan.count("FileScan") == S.clean_users(raw)._jdf.queryExecution(
    ).executedPlan().toString().count("FileScan")


def test_statistics_reach_the_joins(spark, published):
    from cardlake.operators import gold as G

    cfg, _ = published
    silver = PL.read_tables(spark, {t: f"{cfg.schema}.silver_{t}" for t in S.CLEANERS})
    df = G.gold_transactions(silver["transactions"], silver["mcc_codes"])
    cost = df._jdf.queryExecution().stringWithStats()
    assert cost.count("rowCount=") >= 3
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # rows and columns decide, not the bytes of (compressed) files, which would always pass for small
    files = sum(map(os.path.getsize, glob.glob(f"{cfg.out_dir}/silver/mcc_codes/*.parquet")))
    size = int(silver["mcc_codes"]._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    assert size > files
    try:
        for bound, join in ((size, "BroadcastHashJoin"), (size - 1, "SortMergeJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(bound))
            planned = G.gold_transactions(silver["transactions"], silver["mcc_codes"])._jdf.queryExecution().sparkPlan()
            assert join in planned.toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_merged_bitmaps_equal_distinct_counts(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, *range(40)]), rng.choice(["a", "b", None]),
             rng.choice([None, rng.randrange(-5, 5), rng.randrange(10**5), rng.randrange(10**12)])) for _ in range(5000)]
    df = spark.createDataFrame(data, "day int, kind string, id long")
    state = M.distinct_state(df, ["day", "kind"], "id")
    for keys in (["day", "kind"], ["kind"], [(F.col("day") / 7).cast("int").alias("week")], []):
        got = M.merged_distinct(state, keys, "n")
        want = df.where("id IS NOT NULL").groupBy(*keys).agg(F.count_distinct("id").alias("n"))
        assert rows(got) == rows(want)
    assert "FileScan" not in state._jdf.queryExecution().executedPlan().toString()


def test_reject_rows_names_what_failed(spark):
    from cardlake.functions import parse as P

    raw = spark.createDataFrame([("1", "$5", "x"), ("2", "abc", "13/2020"), ("z", " ", None)], "id string, amount string, opened string")
    typed = {"id": P.to_long("id"), "amount": P.money("amount"), "opened": P.month_year_date("opened")}
    assert rows(Q.reject_rows(raw, typed, "cards", "id")) == [
        ("cards", "amount", "2", "abc"), ("cards", "id", "z", "z"), ("cards", "opened", "1", "x"), ("cards", "opened", "2", "13/2020")]
