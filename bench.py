"""Benchmark: the batch pipeline and every report query at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_EVENT_LOG=1 to write Spark's event log next to the scratch folder.
Prints one JSON line. After a warm-up on the smallest tables: raw->silver
(five tables written) and silver->gold (gold tables written), median of 3
runs each into a fresh folder; then each report query over the persisted
gold tables (executed to a no-op sink), median of 3.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardlake.plans import pipeline as PL  # noqa: E402
from cardlake.plans import reports as RP  # noqa: E402
from cardlake.session import build_session, remove_scratch, scratch_path  # noqa: E402
from cardlake.sources import fixtures  # noqa: E402


WARMUP_DIR = "/root/testdata/sf0.001"


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    # used only if the session names no checkpoint folder (local runs)
    local_ckpt = f"{tempfile.gettempdir()}/cardlake-bench-{uuid.uuid4().hex[:12]}"
    extra = {"spark.driver.memory": "16g"}
    if os.environ.get("BENCH_EVENT_LOG"):  # stage/task times without the web UI
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"{local_ckpt}-events"})
        os.makedirs(f"{local_ckpt}-events", exist_ok=True)
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, checkpoint_dir=local_ckpt,
                          extra=extra)
    out_dir = scratch_path(spark, "bench")
    cfg = PL.PipelineConfig(out_dir=out_dir, schema="cardlake_bench", buckets=cpus * 2)
    timings: dict[str, float] = {}

    # warm-up: the whole pipeline once on the smallest tables (JIT, codegen caches)
    warm = PL.PipelineConfig(out_dir=scratch_path(spark, "bench-warmup"), schema="cardlake_warmup",
                             buckets=cfg.buckets)
    warm_gold = PL.read_tables(spark, PL.write_gold(
        spark, PL.write_silver(spark, fixtures.raw_frames(spark, WARMUP_DIR), warm), warm))
    for fn in RP.REPORTS.values():
        run_noop(fn(warm_gold))

    silver_runs, gold_runs = [], []
    for i in range(3):
        run_cfg = PL.PipelineConfig(out_dir=f"{out_dir}/run{i}", schema=f"cardlake_bench{i}",
                                    buckets=cfg.buckets)
        raw = fixtures.raw_frames(spark, sf_dir)
        t0 = time.time()
        silver_names = PL.write_silver(spark, raw, run_cfg)
        silver_runs.append(time.time() - t0)
        t0 = time.time()
        gold_names = PL.write_gold(spark, silver_names, run_cfg)
        gold_runs.append(time.time() - t0)
    timings["raw_to_silver"] = statistics.median(silver_runs)
    timings["silver_to_gold"] = statistics.median(gold_runs)

    gold = PL.read_tables(spark, gold_names)
    for name, fn in RP.REPORTS.items():
        run_noop(fn(gold))  # warm-up
        runs = []
        for _ in range(3):
            t0 = time.time()
            run_noop(fn(gold))
            runs.append(time.time() - t0)
        timings[name] = statistics.median(runs)

    remove_scratch(spark)
    total = sum(timings.values())
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "pipeline_plus_reports_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
