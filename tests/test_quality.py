"""Reject report: only non-blank raw text that fails to parse counts."""

from cardlake.functions import parse as P
from cardlake.operators.quality import reject_counts


def test_reject_counts_only_unparseable_text(spark):
    raw = spark.createDataFrame(
        [("$1,234.56", "12/2022"), ("", "13/2020"), (None, None), ("abc", " "), ("$-5", "01/1999")],
        "amount string, opened string")
    typed = {"amount": P.money("amount"), "opened": P.month_year_date("opened")}
    got = {(r.table_name, r.column_name): r.rejected_rows for r in reject_counts(raw, typed, "cards").collect()}
    # amount: only 'abc' (blank '' and NULL are not rejects); opened: only '13/2020'
    assert got == {("cards", "amount"): 1, ("cards", "opened"): 1}
