"""Raw files -> bronze -> silver -> gold equals the in-memory path from the
driver-table fixtures (the file shapes lose nothing)."""

from cardlake.plans import pipeline as PL
from cardlake.plans.layers import Layers
from cardlake.session import scratch_path
from cardlake.sources import files as FS
from cardlake.sources import fixtures

SF = "/root/testdata/sf0.001"


def rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_files_to_gold_equals_fixture_path(spark):
    raw_dir = FS.write_raw_dir(fixtures.raw_frames(spark, SF), scratch_path(spark, "raw"))
    cfg = PL.PipelineConfig(out_dir=scratch_path(spark, "from-files"), schema="cardlake_from_files")
    gold = PL.run(spark, FS.read_raw_dir(spark, raw_dir), cfg, with_bronze=True)
    mem = Layers.from_driver_tables(spark, SF)
    for t in ("users", "transactions", "credit_utilization", "fraud_monitoring"):
        cols = mem.gold(t).columns
        assert rows(gold[t], cols) == rows(mem.gold(t), cols), t


def test_every_fraud_reader_gives_the_same_labels(spark):
    raw_dir = FS.write_raw_dir(fixtures.raw_frames(spark, SF), scratch_path(spark, "raw"), pretty_labels=False)
    got = {r: sorted(tuple(x) for x in FS.read_raw_dir(spark, raw_dir, r)["fraud_labels"].collect())
           for r in ("split", "lines", "whole")}
    assert got["split"] == got["lines"] == got["whole"]
    assert len(got["split"]) == fixtures.raw_fraud_labels(spark, SF).count()
