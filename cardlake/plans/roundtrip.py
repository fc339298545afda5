"""File and table round trips over data derived from the driver tables.

Each query writes a raw or gold frame in a source/sink shape to a fresh
folder under the shared checkpoint folder, then reads it back through the
reader under test, so the reader runs over the whole derived data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.operators import silver as S
from cardlake.operators.quality import reject_counts
from cardlake.plans import pipeline as PL
from cardlake.plans import serving as SV
from cardlake.plans import tables as T
from cardlake.plans.layers import Layers
from cardlake.schemas import RAW_CSV_SCHEMAS
from cardlake.session import scratch_path
from cardlake.sources import files as FS
from cardlake.sources import fixtures

SCRATCH_SCHEMA = "cardlake_scratch"


def _raw(spark: SparkSession, d: str, name: str) -> DataFrame:
    return fixtures.RAW_BUILDERS[name](spark, d)


def ingest_csv(name: str):
    def q(spark: SparkSession, d: str) -> DataFrame:
        path = FS.write_csv(_raw(spark, d, name), scratch_path(spark, f"raw_{name}_csv"))
        return FS.read_csv(spark, path, RAW_CSV_SCHEMAS[name], glob="*.csv")

    return q


def ingest_silver_transactions(spark: SparkSession, d: str) -> DataFrame:
    raw = ingest_csv("transactions")(spark, d)
    return S.clean_transactions(raw)


def ingest_mcc(keep_nulls: bool):
    def q(spark: SparkSession, d: str) -> DataFrame:
        path = FS.write_json_object(_raw(spark, d, "mcc_codes"), "mcc", "category", scratch_path(spark, "raw_mcc"))
        return FS.bronze_mcc_codes(spark, path, keep_nulls=keep_nulls)

    return q


def ingest_csv_cards_extra(spark: SparkSession, d: str) -> DataFrame:
    """Cards with two further columns, in another column order than the declared one."""
    o = fixtures.read_driver(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("card_brand"), F.col("o_orderstatus").alias("card_type"))
    cards = _raw(spark, d, "cards")
    wide = cards.join(o, cards.id == o.o_orderkey).select(
        "card_brand", *reversed(cards.columns), "card_type")
    return FS.read_csv(spark, FS.write_csv(wide, scratch_path(spark, "raw_cards_extra")), RAW_CSV_SCHEMAS["cards"])


def ingest_csv_mixed_headers(spark: SparkSession, d: str) -> DataFrame:
    """Users in one folder whose files have their columns in three orders, some with a further column."""
    users, path = _raw(spark, d, "users"), scratch_path(spark, "raw_users_mixed")
    group = F.coalesce(F.pmod("id", F.lit(3)), F.lit(0))
    orders = [users.columns, sorted(users.columns), ["note", *reversed(users.columns)]]
    for no, columns in enumerate(orders):
        part = users.withColumn("note", F.concat(F.lit("n"), F.col("id").cast("string"))).where(group == no)
        part.select(*columns).write.mode("append").options(**FS.CSV_DIALECT, **FS.CSV_WRITE).csv(path)
    return FS.read_csv(spark, path, RAW_CSV_SCHEMAS["users"])


def reject_report_files(spark: SparkSession, d: str) -> DataFrame:
    """The reject report over files whose numeric columns hold text that is no number."""
    u = _raw(spark, d, "users")
    dirty = u.withColumns({
        "credit_score": F.when(F.col("id") % 11 == 3, "n/a").otherwise(F.col("credit_score").cast("string")),
        "num_credit_cards": F.when(F.col("id") % 13 == 5, "two").otherwise(F.col("num_credit_cards").cast("string")),
        "id": F.when(F.col("id") % 17 == 2, F.concat(F.col("id").cast("string"), F.lit("x"))).otherwise(
            F.col("id").cast("string")),
    })
    raw = FS.read_csv(spark, FS.write_csv(dirty, scratch_path(spark, "raw_users_dirty")))
    return reject_counts(raw, S.users_typed(), "users")


def reject_report_observed(spark: SparkSession, d: str) -> DataFrame:
    """Rejects counted by the jobs that write silver, without another pass over raw."""
    schema = f"{SCRATCH_SCHEMA}_{uuid.uuid4().hex[:10]}"
    cfg = PL.PipelineConfig(out_dir=scratch_path(spark, "observed"), schema=schema, rejects=True)
    PL.write_silver(spark, {name: _raw(spark, d, name) for name in S.CLEANERS}, cfg)
    return spark.table(f"{schema}.silver_rejects")


def table_published(spark: SparkSession, d: str) -> DataFrame:
    """Silver users published under a name, then gold users: rows and columns of the second version."""
    L = Layers.from_driver_tables(spark, d)
    _scratch_schema(spark)
    name, path = _table_name("published"), scratch_path(spark, "table_published")
    T.publish_table(L.silver("users"), name, path)
    T.publish_table(L.gold("users"), name, path)
    return spark.table(name)


_TIME_PATTERN = "MM-dd-yyyy HH:mm"


def silver_transactions_iso(spark: SparkSession, d: str) -> DataFrame:
    """Transactions whose times are written as ISO text."""
    raw = _raw(spark, d, "transactions")
    return S.clean_transactions(raw.withColumn("date", F.coalesce(
        F.date_format(F.try_to_timestamp("date", F.lit(_TIME_PATTERN)), "yyyy-MM-dd HH:mm:ss"), "date")))


def silver_transactions_inferred(spark: SparkSession, d: str) -> DataFrame:
    """Transactions whose time column a reader with type inference already made a timestamp."""
    raw = _raw(spark, d, "transactions").withColumn("date", F.date_format(
        F.try_to_timestamp("date", F.lit(_TIME_PATTERN)), "yyyy-MM-dd HH:mm:ss"))
    path = FS.write_csv(raw, scratch_path(spark, "raw_transactions_iso"))
    return S.clean_transactions(FS.read_csv(spark, path, infer=True))


def _fraud_files(spark: SparkSession, labels: DataFrame, pretty: bool) -> str:
    return FS.write_label_objects(labels, "transaction_id", "fraud_label", scratch_path(spark, "raw_fraud"),
                                  pretty=pretty)


def _odd_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels with nulls, commas and quotes among them."""
    tid = F.col("transaction_id").cast("long")
    return _raw(spark, d, "fraud_labels").withColumn(
        "fraud_label", F.when(tid % 89 == 4, F.lit(None).cast("string")).when(tid % 97 == 5, "No, disputed").when(
            tid % 83 == 6, 'Yes "sic"').otherwise(F.col("fraud_label")))


def ingest_fraud(reader, pretty: bool, labels=None):
    def q(spark: SparkSession, d: str) -> DataFrame:
        frame = labels(spark, d) if labels else _raw(spark, d, "fraud_labels")
        return reader(spark, _fraud_files(spark, frame, pretty))

    return q


def ingest_fraud_split_layouts(spark: SparkSession, d: str) -> DataFrame:
    """Label objects in every legal layout, one folder each, read by splits."""
    base, layouts = scratch_path(spark, "raw_fraud_layouts"), list(FS.LABEL_LAYOUTS)
    labels = _odd_labels(spark, d).withColumn("no", F.coalesce(
        F.pmod(F.col("transaction_id").cast("long"), F.lit(len(layouts))), F.lit(0)))
    for no, layout in enumerate(layouts):
        FS.write_label_objects(labels.where(F.col("no") == no), "transaction_id", "fraud_label", f"{base}/{layout}",
                               entries_per_object=500, layout=layout)
    return FS.bronze_fraud_labels_split(spark, base)


def ingest_fraud_split_one_line(spark: SparkSession, d: str) -> DataFrame:
    """Large label objects, each on a line of its own, read by splits that may begin within a line."""
    return FS.bronze_fraud_labels_split(spark, _fraud_files(spark, _odd_labels(spark, d), False))


def raw_landing_csv(name: str):
    def q(spark: SparkSession, d: str) -> DataFrame:
        src = FS.write_csv(_raw(spark, d, name), scratch_path(spark, f"source_{name}"))
        dst = FS.land_csv(spark, src, scratch_path(spark, f"landed_{name}"), compression="gzip")
        return FS.read_csv(spark, dst, RAW_CSV_SCHEMAS[name], glob="*.csv.gz")

    return q


def raw_landing_csv_odd(spark: SparkSession, d: str) -> DataFrame:
    """Landed users whose addresses hold line breaks, quotes, backslashes, and texts that look like marks."""
    odd = [F.concat("address", F.lit("\n"), "address"), F.lit("\\N"), F.concat("address", F.lit('"')), F.concat("address", F.lit("\\")),
           F.lit(""), F.lit(None).cast("string"), F.concat(F.lit('"'), "address", F.lit('",\r\n\\"'))]
    address = F.col("address")
    for no, value in enumerate(odd):
        address = F.when(F.col("id") % 9 == no, value).otherwise(address)
    users = _raw(spark, d, "users").withColumn("address", address)
    src = FS.write_csv(users, scratch_path(spark, "source_users_odd"))
    landed = FS.land_csv(spark, src, scratch_path(spark, "landed_users_odd"), compression="gzip")
    return FS.read_csv(spark, landed, RAW_CSV_SCHEMAS["users"], glob="*.csv.gz", line_breaks=True)


def raw_landing_json(spark: SparkSession, d: str) -> DataFrame:
    src = _fraud_files(spark, _raw(spark, d, "fraud_labels"), False)
    dst = FS.land_text(spark, src, scratch_path(spark, "landed_fraud"), glob="*.txt")
    return FS.bronze_fraud_labels_by_line(spark, dst)


def raw_landing_mcc(spark: SparkSession, d: str) -> DataFrame:
    src = FS.write_json_object(_raw(spark, d, "mcc_codes"), "mcc", "category", scratch_path(spark, "source_mcc"))
    return FS.bronze_mcc_codes(spark, FS.land_text(spark, src, scratch_path(spark, "landed_mcc"), glob="*.txt"))


def scan_by_extension(spark: SparkSession, d: str) -> DataFrame:
    """A folder tree of mixed files: only the delimited ones are read, each row with its file's extension."""
    base = scratch_path(spark, "mixed")
    users = _raw(spark, d, "users")
    FS.write_csv(users, f"{base}/delimited/users")
    users.write.json(f"{base}/json")
    FS.write_json_object(_raw(spark, d, "mcc_codes"), "mcc", "category", f"{base}/text")
    found = FS.with_source_file(FS.read_csv(spark, base, recursive=True))
    return found.select(F.col("id").try_cast("long").alias("id"), "address", F.regexp_extract(
        "source_file", "[.]([a-z]+)$", 1).alias("extension"))


def _scratch_schema(spark: SparkSession) -> None:
    T.create_schema(spark, SCRATCH_SCHEMA, scratch_path(spark, "schema"))


def _table_name(label: str) -> str:
    return f"{SCRATCH_SCHEMA}.{label}_{uuid.uuid4().hex[:10]}"


def table_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """Write gold users, then overwrite the same table with silver users:
    rows and schema are replaced."""
    L = Layers.from_driver_tables(spark, d)
    _scratch_schema(spark)
    name, path = _table_name("users"), scratch_path(spark, "table_users")
    T.overwrite_table(L.gold("users"), name, path)
    T.overwrite_table(L.silver("users"), name, path + "_v2")
    return spark.table(name)


def table_merge_schema(spark: SparkSession, d: str) -> DataFrame:
    """An older table version with a column the new frame lacks, overwritten
    with schema merge: old columns kept (NULL), new ones appended."""
    L = Layers.from_driver_tables(spark, d)
    _scratch_schema(spark)
    name = _table_name("gold_users")
    old = L.silver("users").select("id", "current_age", "gender", "credit_score").withColumn(
        "legacy_note", F.lit("v1")
    )
    T.overwrite_table(old, name, scratch_path(spark, "table_gold_users"))
    T.overwrite_merge_schema(spark, L.gold("users"), name, scratch_path(spark, "table_gold_users_v2"))
    return spark.table(name)


def table_overwrite_in_place(spark: SparkSession, d: str) -> DataFrame:
    """Gold users, then silver users under the same name and in the same folder: a re-run replaces rows and
    columns, and no file of the first version is left."""
    L = Layers.from_driver_tables(spark, d)
    _scratch_schema(spark)
    name, path = _table_name("users_in_place"), scratch_path(spark, "table_users_in_place")
    T.overwrite_table(L.gold("users"), name, path)
    T.overwrite_table(L.silver("users"), name, path)
    return spark.read.parquet(path)


def _external(spark: SparkSession, d: str, view: str) -> str:
    """The projection of one serving view as an external table with declared columns."""
    source, build = SV.VIEWS[view]
    frame = build(Layers.from_driver_tables(spark, d).gold(source))
    folder = scratch_path(spark, view)
    frame.write.mode("overwrite").parquet(folder)
    _scratch_schema(spark)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields)
    return T.external_table(spark, _table_name(f"ext_{view}"), ddl, folder)


def external_table(view: str):
    return lambda spark, d: spark.table(_external(spark, d, view))


def serving_view(view: str):
    def q(spark: SparkSession, d: str) -> DataFrame:
        name = _table_name(view)
        T.create_view(spark, name, f"SELECT * FROM {_external(spark, d, view)}")
        return spark.table(name)

    return q


ROUNDTRIP_QUERIES = {
    "ingest_csv_users": ingest_csv("users"),
    "ingest_csv_cards": ingest_csv("cards"),
    "ingest_csv_transactions": ingest_csv("transactions"),
    "ingest_silver_transactions": ingest_silver_transactions,
    "ingest_mcc_map": ingest_mcc(True),
    "ingest_mcc_json": ingest_mcc(False),
    "ingest_fraud_split": ingest_fraud(FS.bronze_fraud_labels_split, True),
    "ingest_fraud_lines": ingest_fraud(FS.bronze_fraud_labels_by_line, False),
    "ingest_fraud_whole": ingest_fraud(FS.bronze_fraud_labels_whole, True),
    "ingest_fraud_split_odd": ingest_fraud(FS.bronze_fraud_labels_split, True, _odd_labels),
    "ingest_fraud_lines_odd": ingest_fraud(FS.bronze_fraud_labels_by_line, False, _odd_labels),
    "ingest_fraud_split_layouts": ingest_fraud_split_layouts,
    "ingest_fraud_split_one_line": ingest_fraud_split_one_line,
    "ingest_csv_cards_extra": ingest_csv_cards_extra,
    "ingest_csv_mixed_headers": ingest_csv_mixed_headers,
    "reject_report_files": reject_report_files,
    "reject_report_observed": reject_report_observed,
    "table_published": table_published,
    "silver_transactions_iso": silver_transactions_iso,
    "silver_transactions_inferred": silver_transactions_inferred,
    "raw_landing_csv": raw_landing_csv("users"),
    "raw_landing_csv_cards": raw_landing_csv("cards"),
    "raw_landing_csv_transactions": raw_landing_csv("transactions"),
    "raw_landing_csv_odd": raw_landing_csv_odd,
    "raw_landing_mcc": raw_landing_mcc,
    "scan_by_extension": scan_by_extension,
    "raw_landing_json": raw_landing_json,
    "table_overwrite": table_overwrite,
    "table_overwrite_in_place": table_overwrite_in_place,
    "table_merge_schema": table_merge_schema,
    "external_table": external_table("vw_credit_utilization"),
    "external_customer_segmentation": external_table("vw_customer_segmentation"),
    "external_spending_transactions": external_table("vw_spending_transactions"),
    "external_fraud_monitoring": external_table("vw_fraud_monitoring"),
    "serving_view": serving_view("vw_credit_utilization"),
    "serving_view_customer_segmentation": serving_view("vw_customer_segmentation"),
    "serving_view_spending_transactions": serving_view("vw_spending_transactions"),
    "serving_view_fraud_monitoring": serving_view("vw_fraud_monitoring"),
}
