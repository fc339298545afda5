"""Scratch folders, and the driver contract without the training-data modules."""

import os
import sys

from cardlake import session


def test_scratch_folders_are_removed(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch_made", [])
    paths = [session.scratch_path(spark, "gone") for _ in range(3)]
    for path in paths[:2]:
        spark.range(3).write.parquet(path)
    assert session.remove_scratch(spark) == 2 and session.remove_scratch(spark) == 0
    assert not any(map(os.path.exists, paths))


def test_entry_works_where_training_modules_cannot_be_imported(monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)  # importing it raises ImportError
    assert "pipeline" not in entry.queries() and not any(q.startswith("op") for q in entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries()) and "report_monthly_debit_credit" in entry.oracle_sql()
