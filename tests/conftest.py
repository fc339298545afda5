import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cardlake.session import build_session

    ckpt = tempfile.mkdtemp(prefix="cardlake-tests-", dir="/tmp")
    s = build_session("local[4]", shuffle_partitions=8, checkpoint_dir=ckpt,
                      extra={"spark.sql.ansi.enabled": "true"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
