"""Whole-file vs splittable reading of one fraud-label object as it grows.

Usage: python tools/fraud_reader_bench.py [entries ...]
Writes one single-line ``{"target": {...}}`` file per size to a fresh scratch
folder, then times both readers (count of parsed rows, median of 3). The
whole-file reader runs one task holding the whole object; with the local
default 1 GB heap it fails with OutOfMemoryError on a 4M-entry (72 MB) file,
so it is only attempted up to WHOLE_MAX_ENTRIES (default 1M).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardlake.session import build_session, scratch_path  # noqa: E402
from cardlake.sources import files as FS  # noqa: E402


def timed(fn) -> tuple[float, int]:
    runs, n = [], 0
    for _ in range(3):
        t0 = time.time()
        n = fn()
        runs.append(time.time() - t0)
    return statistics.median(runs), n


def main() -> None:
    sizes = [int(x) for x in sys.argv[1:]] or [250_000, 1_000_000, 4_000_000, 16_000_000]
    whole_max = int(os.environ.get("WHOLE_MAX_ENTRIES", "1000000"))
    spark = build_session("local[8]", 16)
    base = scratch_path(spark, "fraud-reader-bench")
    for n in sizes:
        folder = f"{base}/{n}"
        os.makedirs(folder, exist_ok=True)
        path = f"{folder}/train_fraud_labels.json"
        with open(path, "w") as f:
            json.dump({"target": {str(10_000_000 + i): ("Yes" if i % 50 == 0 else "No") for i in range(n)}}, f)
        mb = os.path.getsize(path) / 1e6
        split, c2 = timed(lambda: FS.bronze_fraud_labels_split(spark, folder).count())
        assert c2 == n
        tasks = FS.bronze_fraud_labels_split(spark, folder).rdd.getNumPartitions()
        out = {"entries": n, "file_mb": round(mb, 1), "split_sec": round(split, 2), "split_tasks": tasks}
        if n <= whole_max:
            whole, c1 = timed(lambda: FS.bronze_fraud_labels_whole(spark, folder).count())
            assert c1 == n
            out["whole_file_sec"] = round(whole, 2)
        else:
            out["whole_file_sec"] = None  # not attempted: one task holds the whole object
        print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
