"""Every registered query against its independent DuckDB definition on the
smallest driver tables: same column names and types, same rows (exact)."""

import math

import pytest

import __spark_entry__ as E
from cardlake.plans.oracle import oracle_queries
from cardlake.plans.registry import spark_queries

SF = "/root/testdata/sf0.001"
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
ORACLES = oracle_queries()
QUERIES = spark_queries()


def norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return repr(v.isoformat() if hasattr(v, "isoformat") else v)


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    res = duck.execute(ORACLES[name])
    onames = [d[0] for d in res.description]
    orows = res.fetchall()
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in df.schema.fields}
    assert stypes == {d[0]: str(d[1]) for d in res.description}
    assert len(rows) == len(orows)
    assert canon(df.columns, rows) == canon(onames, orows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "utilization_band" in df.columns
