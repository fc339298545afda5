"""File readers on files written the way the source systems lay them out."""

import json
import os
import tempfile

from cardlake.sources import files as FS

LABELS = {str(10_000 + i): ("Yes" if i % 7 == 0 else "No") for i in range(500)}


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)
    return folder


def rows(df):
    return {(r.transaction_id, r.fraud_label) for r in df.collect()}


WANT = {(int(k), v) for k, v in LABELS.items()}


def test_fraud_readers_on_pretty_and_one_line_files(spark):
    base = tempfile.mkdtemp(dir="/tmp")
    pretty = write(f"{base}/pretty", "train_fraud_labels.json", json.dumps({"target": LABELS}, indent=4))
    oneline = write(f"{base}/oneline", "train_fraud_labels.json", json.dumps({"target": LABELS}))
    assert rows(FS.bronze_fraud_labels_split(spark, pretty)) == WANT
    assert rows(FS.bronze_fraud_labels_split(spark, oneline)) == WANT
    assert rows(FS.bronze_fraud_labels_whole(spark, pretty)) == WANT
    assert rows(FS.bronze_fraud_labels_by_line(spark, oneline)) == WANT
    # a line-wise read of a pretty-printed object finds no complete object
    assert FS.bronze_fraud_labels_by_line(spark, pretty).count() == 0


def test_wholetext_option_trap(spark):
    base = tempfile.mkdtemp(dir="/tmp")
    pretty = write(f"{base}/p", "x.json", json.dumps({"target": LABELS}, indent=2))
    # an option set before .text() is reset by text()'s own keyword default
    trap = spark.read.option("wholetext", "true").text(pretty)
    assert trap.count() > 1
    assert FS.read_text_whole(spark, pretty).count() == 1


def test_split_reader_uses_many_splits(spark):
    base = tempfile.mkdtemp(dir="/tmp")
    big = {str(i): "No" for i in range(200_000)}
    path = write(f"{base}/big", "labels.json", json.dumps({"meta": {"7": "Yes"}, "target": big}, indent=1))
    # one ~3 MB object, an entry a line, read in 256 KB splits
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        df = FS.bronze_fraud_labels_split(spark, path)
        assert df.rdd.getNumPartitions() > 4
        assert df.count() == 200_000
        assert df.select("transaction_id").distinct().count() == 200_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_split_reader_loses_and_adds_nothing(spark):
    base = tempfile.mkdtemp(dir="/tmp")
    obj = {"meta": {"7": "Yes"}, "target": {"1": "Yes", "2": None, "3": "No, disputed", "4": 'a "b" {c}', "5": "No"},
           "after": {"8": "Yes"}}
    want = {(1, "Yes"), (2, None), (3, "No, disputed"), (4, 'a "b" {c}'), (5, "No")}
    assert rows(FS.bronze_fraud_labels_split(spark, write(f"{base}/p", "a.json", json.dumps(obj, indent=2)))) == want
    assert rows(FS.bronze_fraud_labels_split(spark, write(f"{base}/q", "a.json", json.dumps(obj)))) == want
    odd = write(f"{base}/r", "a.json", '{\n"target": {\n"1": "Yes",\n"2" oops\n}\n}')
    assert rows(FS.bronze_fraud_labels_split(spark, odd)) == {(1, "Yes"), (None, '"2" oops')}


def test_csv_by_header_name_with_extras_and_missing_column(spark):
    import pytest
    from pyspark.sql.types import LongType, StringType, StructType

    base = tempfile.mkdtemp(dir="/tmp")
    path = write(base, "cards.csv", "brand,limit,id\nVisa,$5,7x\nAmex,$6,8\n")
    schema = StructType().add("id", LongType()).add("limit", StringType())
    got = {tuple(r) for r in FS.read_csv(spark, path, schema).collect()}
    assert got == {(None, "$5", "Visa"), (8, "$6", "Amex")}
    with pytest.raises(ValueError, match="has_chip"):
        FS.read_csv(spark, path, StructType().add("has_chip", StringType()))


def test_landing_keeps_null_and_empty_apart(spark):
    base = tempfile.mkdtemp(dir="/tmp")
    df = spark.createDataFrame([("1", None), ("2", ""), ("3", " x ")], "id string, s string")
    src = FS.write_csv(df, f"{base}/src")
    back = FS.read_csv(spark, FS.land_csv(spark, src, f"{base}/dst"))
    assert {tuple(r) for r in back.collect()} == {("1", None), ("2", ""), ("3", " x ")}


def test_mcc_object_map_and_json_forms(spark):
    base = tempfile.mkdtemp(dir="/tmp")
    obj = {"5411": " Grocery Stores ", "5812": "Eating Places", "9999": None}
    path = write(f"{base}/mcc", "mcc_codes.json", json.dumps(obj, indent=2))
    keep = {(r.mcc, r.category) for r in FS.bronze_mcc_codes(spark, path, keep_nulls=True).collect()}
    drop = {(r.mcc, r.category) for r in FS.bronze_mcc_codes(spark, path, keep_nulls=False).collect()}
    assert keep == {(5411, " Grocery Stores "), (5812, "Eating Places"), (9999, None)}
    assert drop == keep - {(9999, None)}


def test_csv_extension_filter_and_provenance(spark):
    base = tempfile.mkdtemp(dir="/tmp")
    write(base, "users_data.csv", "id,name\n1,a\n2,b\n")
    write(base, "notes.txt", "id,name\n3,c\n")
    df = FS.with_source_file(FS.read_csv(spark, base, None, glob="*.csv"))
    got = sorted((r.id, r.source_file) for r in df.collect())
    assert got == [("1", "users_data.csv"), ("2", "users_data.csv")]
