"""Table sinks and DDL on small frames."""

from pyspark.sql import functions as F

from cardlake.plans import serving as SV
from cardlake.plans import tables as T
from cardlake.session import scratch_path


def test_merge_schema_keeps_old_columns_and_appends_new(spark):
    T.create_schema(spark, "cardlake_t", scratch_path(spark, "schema"))
    name = "cardlake_t.merge_demo"
    old = spark.createDataFrame([(1, "a")], "id long, legacy string")
    T.overwrite_table(old, name, scratch_path(spark, "merge_v1"))
    new = spark.createDataFrame([(2, 0.5)], "id long, ratio double")
    T.overwrite_merge_schema(spark, new, name, scratch_path(spark, "merge_v2"))
    got = spark.table(name)
    assert got.columns == ["id", "legacy", "ratio"]
    assert [tuple(r) for r in got.collect()] == [(2, None, 0.5)]


def test_view_if_absent_does_not_replace(spark):
    T.create_schema(spark, "cardlake_t", scratch_path(spark, "schema"))
    T.create_view(spark, "cardlake_t.v_demo", "SELECT 1 AS x", replace=True)
    T.create_view(spark, "cardlake_t.v_demo", "SELECT 2 AS x")
    assert spark.table("cardlake_t.v_demo").first().x == 1
    T.create_view(spark, "cardlake_t.v_demo", "SELECT 3 AS x", replace=True)
    assert spark.table("cardlake_t.v_demo").first().x == 3


def test_external_table_declares_types(spark):
    T.create_schema(spark, "cardlake_t", scratch_path(spark, "schema"))
    folder = scratch_path(spark, "ext")
    spark.range(5).select(F.col("id").alias("customer_id"), F.lit(2).cast("int").alias("total_cards")) \
        .write.parquet(folder)
    T.external_table(spark, "cardlake_t.ext_demo", "customer_id BIGINT, total_cards INT", folder)
    df = spark.table("cardlake_t.ext_demo")
    assert df.schema.simpleString() == "struct<customer_id:bigint,total_cards:int>"
    assert df.count() == 5
    # dropping and re-creating is idempotent
    T.external_table(spark, "cardlake_t.ext_demo", "customer_id BIGINT, total_cards INT", folder)
    assert spark.table("cardlake_t.ext_demo").count() == 5


def test_ad_hoc_limit(spark):
    spark.range(6000).createOrReplaceTempView("cardlake_big_view")
    assert SV.ad_hoc(spark, "cardlake_big_view").count() == SV.AD_HOC_RESULT_LIMIT
