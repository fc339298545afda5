"""Delimited files with mixed headers, line breaks in fields, and values that look like marks."""

import csv
import io
import os
import random
import tempfile

import pytest
from pyspark.sql.types import LongType, StringType, StructType

from cardlake.sources import csv_split as CS
from cardlake.sources import files as FS
from cardlake.sources import split_scan as SS

ODD = [None, "", "\\N", 'a"b', '"', '""', "\\", "a,b\\", 'x\\"', "l1\nl2", "l1\r\nl2\n", " pad ", "\\\\", "a\\b", ",", "#c",
       '"q" x', '\\"', "\n", "null", "é😀", '5" pipe']


def folder(**texts):
    base = tempfile.mkdtemp(dir="/tmp")
    for name, text in texts.items():
        with open(os.path.join(base, f"{name}.csv"), "w", newline="") as f:
            f.write(text)
    return base


def test_files_of_one_folder_with_other_headers(spark):
    path = folder(a="id,client_id\n1,10\n2,20\n", b="client_id,id\n30,3\n", c='"id","note",client_id\n4,"x",40\n', d="",
                  e="id,client_id\n5,50\n")
    got = {(r.id, r.client_id, r.note) for r in FS.read_csv(spark, path).collect()}
    assert got == {("1", "10", None), ("2", "20", None), ("3", "30", None), ("4", "40", "x"), ("5", "50", None)}
    schema = StructType().add("client_id", LongType()).add("id", StringType())
    typed = FS.read_csv(spark, path, schema)
    assert typed.columns == ["client_id", "id", "note"] and {r.client_id for r in typed.collect()} == {10, 20, 30, 40, 50}
    with pytest.raises(ValueError, match="brand"):
        FS.read_csv(spark, path, StructType().add("brand", StringType()))
    named = FS.read_csv(spark, path, source_file="file")
    assert {(r.id, r.file) for r in named.collect()} == {
        ("1", "a.csv"), ("2", "a.csv"), ("3", "b.csv"), ("4", "c.csv"), ("5", "e.csv")}


def test_inferred_types_that_differ_are_text(spark):
    path = folder(a="id,v\n1,10\n", b="v,id\nx,2\n")
    assert {tuple(r) for r in FS.read_csv(spark, path, infer=True).collect()} == {(1, "10"), (2, "x")}


def test_one_header_is_read_as_one(spark):
    path = folder(a="id,v\n1,a\n", b="id,v\n2,b\n")
    df = FS.read_csv(spark, path)
    assert "Union" not in df._jdf.queryExecution().toString() and df.count() == 2
    assert [len(files) for _, files in FS.header_groups(spark, path)] == [2]


def test_header_groups_read_records_not_lines(spark):
    path = folder(a='id,"two\nlines"\n1,x\n', b='"two\nlines",id\ny,2\n')
    assert [h for h, _ in FS.header_groups(spark, path)] == ['id,"two\nlines"', '"two\nlines",id']
    got = {tuple(r) for r in FS.read_csv(spark, path, line_breaks=True).collect()}
    assert got == {("1", "x"), ("2", "y")}


def test_landing_keeps_every_value(spark):
    rows = [(str(i), v, w) for i, (v, w) in enumerate(zip(ODD, reversed(ODD)))]
    base = tempfile.mkdtemp(dir="/tmp")
    src = FS.write_csv(spark.createDataFrame(rows, "id string, s string, t string"), f"{base}/src")
    landed = FS.land_csv(spark, src, f"{base}/dst")
    again = FS.land_csv(spark, landed, f"{base}/dst2")
    for path in (src, landed, again):
        back = FS.read_csv(spark, path, line_breaks=True)
        assert back.columns == ["id", "s", "t"] and sorted(map(tuple, back.collect())) == sorted(rows)


def test_compressed_landing_keeps_every_value(spark):
    rows = [(str(i), v, w) for i, (v, w) in enumerate(zip(ODD, reversed(ODD)))]
    base = tempfile.mkdtemp(dir="/tmp")
    src = FS.write_csv(spark.createDataFrame(rows, "id string, s string, t string"), f"{base}/src")
    landed = FS.land_csv(spark, src, f"{base}/dst", compression="gzip")
    again = FS.land_csv(spark, landed, f"{base}/dst2", glob="*.csv.gz", compression="gzip")
    assert not [n for n in os.listdir(landed) if n.endswith(".csv")]
    for path in (landed, again):
        assert [h for h, _ in FS.header_groups(spark, path, pathGlobFilter="*.csv.gz")] == ["id,s,t"]
        back = FS.read_csv(spark, path, glob="*.csv.gz", line_breaks=True)
        assert back.columns == ["id", "s", "t"] and sorted(map(tuple, back.collect())) == sorted(rows)


def test_scan_does_not_shuffle_the_text(spark):
    rows = [(str(i), random.Random(i).choice(ODD[1:])) for i in range(500)]
    src = FS.write_csv(spark.createDataFrame(rows, "id string, s string"), tempfile.mkdtemp(dir="/tmp") + "/src")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole, overhanging = SS.scan(spark, src, CS.QuotedRecords(), CS._lines, "record string")
        for df in (whole, overhanging):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
            df.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_landing_keeps_the_headers_of_files(spark):
    path = folder(a="id,v\n1,a\n", b='v,w,id\n"b\nb",c,2\n')
    landed = FS.land_csv(spark, path, tempfile.mkdtemp(dir="/tmp") + "/dst")
    assert sorted(h for h, _ in FS.header_groups(spark, landed, pathGlobFilter="*.csv")) == ["id,v", "v,w,id"]
    got = {(r.id, r.v, r.w) for r in FS.read_csv(spark, landed, line_breaks=True).collect()}
    assert got == {("1", "a", None), ("2", "b\nb", "c")}


def test_files_as_other_programs_write_them(spark):
    """Quotes doubled, CR LF line ends, and a last line without an end."""
    rng = random.Random(3)
    rows = [[str(i), rng.choice(["a", 'b"c', "d,e", "f\ng", '"', "h\r\ni", " j "])] for i in range(300)]
    out = io.StringIO()
    csv.writer(out).writerows([["id", "v"], *rows])
    path = folder(a=out.getvalue(), b='id,v\n900,"last\nline"', c="id,v\n901,x")
    want = sorted([*map(tuple, rows), ("900", "last\nline"), ("901", "x")])
    assert sorted(map(tuple, FS.read_csv(spark, path, line_breaks=True, escape='"').collect())) == want


def test_records_are_whole_at_every_split(spark):
    rng = random.Random(4)
    rows = [(str(i), rng.choice(ODD[1:]) * rng.choice([1, 1, 40]) + "x") for i in range(20_000)]
    base = tempfile.mkdtemp(dir="/tmp")
    src = FS.write_csv(spark.createDataFrame(rows, "id string, s string").coalesce(1), f"{base}/src")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        got = sorted(map(tuple, FS.read_csv(spark, src, line_breaks=True).collect()))
        splits = spark.read.option("lineSep", "\n").text(src).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert splits > 6 and got == sorted(rows)


def test_every_cut_gives_the_same_records():
    rng, automaton = random.Random(5), CS.QuotedRecords()
    for _ in range(300):
        fields = lambda: [rng.choice(['"a\nb"', '"\\"\n"', '""', "", 'x"y', '"q"x', "z", '"\n\\\\"', '"e\\\nf"'])
                          for _ in range(rng.randint(1, 3))]
        records = [",".join(fields()).encode() + b"\n" for _ in range(rng.randint(0, 6))]
        text = b"".join(records) or b"\n"
        ends = [i + 1 for i, c in enumerate(text) if c == ord("\n")][:-1]
        for cuts in (ends, sorted(rng.sample(ends, rng.randint(0, len(ends)))), []):
            edges = [0, *cuts, len(text)]
            found, inside, total = [], False, SS.NOTHING
            for a, b in zip(edges, edges[1:]):
                assert SS.applied(total, False, "") == (inside, "")
                for part, piece in automaton.runs(text[a:b], inside, ""):
                    if part > 1:
                        found[-1] += piece
                    else:
                        found.append(piece)
                total = SS.composed(total, automaton.effect(text[a:b]))
                inside, _ = SS.applied(automaton.effect(text[a:b]), inside, "")
            assert found == (records or [b"\n"]), (text, cuts)
