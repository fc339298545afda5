"""Reports come sorted like the visuals (descending keys: NULLs last, ascending ones: NULLs first)."""

import pytest

from cardlake.plans import reports as RP
from cardlake.plans.layers import Layers

SF = "/root/testdata/sf0.001"

# report: (column, descending) in order of precedence
ORDERS = {
    "report_transactions_by_band": [("transaction_count", True), ("utilization_band", False)],
    "report_transactions_by_segment": [("transaction_count", True), ("customer_segment", False)],
    "report_scored_customers_by_segment": [("scored_customers", True), ("customer_segment", False)],
    "report_monthly_debit_credit": [("total_debited", True), ("transaction_month_name", False)],
    "report_spend_by_category": [("total_debited", True), ("category", False)],
    "report_labelled_by_state_category": [
        ("labelled_transactions", True), ("merchant_state", False), ("category", False)],
    "report_high_risk_customers": [("customer_id", False)],
    "report_fraud_investigation": [("customer_id", True), ("transaction_id", False)],
    "report_companion_monthly_by_number": [("transaction_month", False)],
}


@pytest.fixture(scope="module")
def gold(spark):
    return Layers.from_driver_tables(spark, SF).gold_map


@pytest.mark.parametrize("name", ORDERS)
def test_rows_come_in_the_order_of_the_visual(gold, name):
    rows = RP.REPORTS[name](gold).collect()
    assert rows
    expected = rows
    for column, descending in reversed(ORDERS[name]):  # stable sorts, least key first
        known = [r for r in expected if r[column] is not None]
        known.sort(key=lambda r: r[column], reverse=descending)
        null = [r for r in expected if r[column] is None]
        expected = known + null if descending else null + known
    assert rows == expected
