import datetime as dt

from pyspark.sql import functions as F

from cardlake.functions import parse as P
from cardlake.functions import rules as R


def one_col(spark, values, typ, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_money(spark):
    got = one_col(spark, ["$1,234.56", "$-77.00", "$0", "", "abc", None], "string", P.money)
    assert got == [1234.56, -77.0, 0.0, None, None, None]


def test_month_year_date(spark):
    got = one_col(spark, ["12/2022", "13/2020", None], "string", P.month_year_date)
    assert got == [dt.date(2022, 12, 1), None, None]


def test_yes_no(spark):
    got = one_col(spark, ["YES", " no ", "Yes", "n/a", None], "string", P.yes_no)
    assert got == [True, False, True, None, None]


def test_timestamp_parse_is_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        # 02:30 on this date does not exist in that zone (clocks jump forward)
        got = one_col(spark, ["03-08-2020 02:30", "12-31-1999 23:59", "13-01-2020 00:00", "not a date", None],
                      "string", P.parse_timestamp)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2020, 3, 8, 2, 30), dt.datetime(1999, 12, 31, 23, 59), None, None, None]


def test_calendar_parts(spark):
    df = spark.createDataFrame([("02-29-2020 10:15",)], "d string").select(
        P.parse_timestamp("d").alias("ts"))
    row = df.select(*[c.alias(n) for n, c in P.calendar_parts("ts").items()]).first()
    assert row.asDict() == {"transaction_date": dt.date(2020, 2, 29), "transaction_year": 2020,
                            "transaction_month": 2, "transaction_month_name": "February"}


def test_transaction_type_and_split(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (None,)], "a double")
    rows = df.select(R.transaction_type("a"), R.absolute_amount("a"), R.debited_amount("a"),
                     R.credited_amount("a")).collect()
    assert [tuple(r) for r in rows] == [("Credit", 1.0, 1.0, 0.0), ("Zero", 0.0, 0.0, 0.0),
                                        ("Debit", 1.0, 0.0, 1.0), ("Zero", None, 0.0, 0.0)]


def test_fraud_flag(spark):
    assert one_col(spark, ["Yes", "yes", "No", None], "string", R.fraud_flag) == [1, 0, 0, 0]


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, None), (None, 2.0)], "n double, d double")
    assert [r[0] for r in df.select(R.guarded_ratio("n", "d")).collect()] == [2.5, None, None, None]


def test_segment_edges(spark):
    rows = [
        (750, 75000.0, 0.3999, "High-Value"),
        (749, 75000.0, 0.3999, "Medium-Value"),
        (750, 74999.99, 0.3999, "Medium-Value"),
        (750, 75000.0, 0.40, "Medium-Value"),
        (599, 75000.0, 0.10, "At-Risk"),
        (600, 75000.0, 0.75, "Medium-Value"),
        (600, 75000.0, 0.7501, "At-Risk"),
        (800, 90000.0, None, "Medium-Value"),   # NULL ratio: never High-Value
        (599, 90000.0, None, "At-Risk"),        # ... At-Risk only by score
    ]
    df = spark.createDataFrame(rows, "credit_score int, yearly_income double, debt_to_income_ratio double, want string")
    got = df.select(R.customer_segment().alias("s"), "want").collect()
    assert [r.s for r in got] == [r.want for r in got]


def test_band_edges(spark):
    vals = [0.2999, 0.30, 0.70, 0.7001, None]
    assert one_col(spark, vals, "double", R.utilization_band) == [
        "Low (<30%)", "Medium (30%-70%)", "Medium (30%-70%)", "High (>70%)", "High (>70%)"]
    assert one_col(spark, vals, "double", lambda c: R.utilization_band(c, null_band=None))[-2:] == [
        "High (>70%)", None]


def test_age_band(spark):
    got = one_col(spark, [18, 25, 34, 35, 64, 65, 90, None], "int", R.age_band)
    assert got == ["<25", "25-34", "25-34", "35-44", "55-64", "65+", "65+", None]


def test_money_sum_is_exact_and_order_free(spark):
    vals = [0.1, 0.2, 0.3, 1234.56, -77.0] * 1000
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = df.agg(R.money_sum("x")).first()[0]
    b = df.repartition(7).agg(R.money_sum("x")).first()[0]
    assert a == b == 1158160.0


def test_money_sum_drops_nothing(spark):
    import random
    from decimal import Decimal

    def total(values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        got = {df.repartition(n).agg(R.money_sum("x")).first()[0] for n in (1, 5)}
        assert len(got) == 1
        return got.pop()

    assert total([1e18, 2.0]) == 1e18 + 2 and total([1e25, 1e25, 5.0]) == 2e25
    assert total([float("inf"), float("nan"), None]) is None and total([float("nan"), 2.5]) == 2.5
    assert total([0.0]) == 0.0 and total([-0.01, -0.02]) == -0.03
    assert total([123456789.12, -123456789.11]) == 0.01 and total([1e12 + 0.25, -1e12]) == 0.25
    rng = random.Random(3)
    for places, top in ((2, 9 * 10**13), (6, 9 * 10**9), (9, 9 * 10**5), (2, 1000)):
        texts = [f"{rng.choice([-1, 1]) * rng.randrange(top)}.{rng.randrange(10**places):0{places}d}" for _ in range(3000)]
        values = [Decimal(t) for t in texts if abs(Decimal(t)) < top]
        assert total([float(v) for v in values]) == float(sum(values))


def test_parse_timestamp_layouts(spark):
    texts = ["12-31-2020 23:59", "2020-12-31 23:59", "2020-12-31T23:59:07", "2020-12-31 23:59:07.5", "13-01-2020 10:00",
             "02-30-2020 10:00", "1-02-2020 10:00", "12-31-2020T23:59", "12-31-2020 24:00", "ab-cd-efgh ij:kl", "2020-12-31",
             "12-31-2020 23:59Z", "12-31-2020 9:30Z", "+202-12-31 23:59", "12/31/2020 23:59", " 2-31-2020 10:00", "", None]
    got = [r[0] and r[0].isoformat() for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy(
        "i").select(P.parse_timestamp("t")).collect()]
    assert got == ["2020-12-31T23:59:00", "2020-12-31T23:59:00", "2020-12-31T23:59:07", "2020-12-31T23:59:07.500000"] + [None] * 14
