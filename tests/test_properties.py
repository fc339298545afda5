"""Property tests: Spark results against brute-force Python definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardlake.functions import parse as P
from cardlake.functions import rules as R
from cardlake.operators.dedup import dedup_by_key

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def money_text(cents: int) -> str:
    sign = "-" if cents < 0 else ""
    whole, frac = divmod(abs(cents), 100)
    return f"${sign}{whole:,}.{frac:02d}"


@SETTINGS
@given(st.lists(st.integers(-10**11, 10**11), min_size=1, max_size=200))
def test_money_parses_formatted_amounts(spark, cents):
    df = spark.createDataFrame([(i, money_text(c)) for i, c in enumerate(cents)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(P.money("t")).collect()]
    assert got == [float(f"{c / 100:.2f}") for c in cents]
    total = df.agg(R.money_sum(P.money("t"))).first()[0]
    assert total == sum(cents) / 100


def none_first(v):
    return (0, 0) if v is None else (1, v)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)),
                          st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
                          st.one_of(st.none(), st.integers(-3, 3))), min_size=1, max_size=120))
def test_dedup_keeps_minimum_row(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string, n int").repartition(3)
    got = {tuple(r) for r in dedup_by_key(df, "k").collect()}
    best = {}
    for k, s, n in rows:
        cand = (none_first(s), none_first(n))
        if k not in best or cand < best[k][0]:
            best[k] = (cand, (k, s, n))
    assert got == {v[1] for v in best.values()}


def py_segment(score, income, ratio):
    def lt(a, b):
        return None if a is None or b is None else a < b

    def ge(a, b):
        return None if a is None or b is None else a >= b

    def gt(a, b):
        return None if a is None or b is None else a > b

    def and3(*xs):
        if any(x is False for x in xs):
            return False
        return None if any(x is None for x in xs) else True

    def or3(*xs):
        if any(x is True for x in xs):
            return True
        return None if any(x is None for x in xs) else False

    if and3(ge(score, 750), ge(income, 75000), lt(ratio, 0.40)) is True:
        return "High-Value"
    if or3(lt(score, 600), gt(ratio, 0.75)) is True:
        return "At-Risk"
    return "Medium-Value"


def py_band(u):
    if u is not None and u < 0.30:
        return "Low (<30%)"
    if u is not None and u <= 0.70:
        return "Medium (30%-70%)"
    return "High (>70%)"


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(300, 850)),
                          st.one_of(st.none(), st.sampled_from([0.0, 74999.99, 75000.0, 120000.0])),
                          st.one_of(st.none(), st.sampled_from([0.0, 0.2999, 0.3, 0.4, 0.7, 0.7001, 0.75, 0.76, 2.0]))),
                min_size=1, max_size=100))
def test_segment_and_band_rules(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, credit_score int, yearly_income double, debt_to_income_ratio double")
    got = df.orderBy("i").select(R.customer_segment(), R.utilization_band(F.col("debt_to_income_ratio"))).collect()
    assert [tuple(g) for g in got] == [(py_segment(*r), py_band(r[2])) for r in rows]
