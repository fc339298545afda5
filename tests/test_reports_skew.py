"""Report queries against a brute-force Python computation on a hand-made
star where one customer holds a third of all transactions."""

import random
from collections import Counter, defaultdict

from cardlake.plans import reports as RP

BANDS = ["Low (<30%)", "Medium (30%-70%)", "High (>70%)"]
SEGS = ["High-Value", "Medium-Value", "At-Risk"]


def make_gold(spark):
    random.seed(3)
    users = [(cid, 500 + cid % 300, 50000.0 + cid, 1000.0 * cid, SEGS[cid % 3]) for cid in range(1, 41)]
    util = [(cid, 500 + cid % 300, 50000.0 + cid, 1000.0 * cid, 9000.0, BANDS[cid % 3]) for cid in range(1, 41)]
    txns = []
    for tid in range(3000):
        cid = 7 if tid % 3 == 0 else random.choice([*range(1, 41), 99, None])  # 99: no such customer
        amount = round(random.uniform(-500, 500), 2)
        fraud = random.choice([0, 1, None])
        txns.append((tid, cid, ["January", "March", None][tid % 3], ["food", None, "fuel"][tid % 3],
                     max(-amount, 0.0), max(amount, 0.0), ["TX", None, "CA"][tid % 3],
                     f"city{tid % 5}", fraud))
    gold = {
        "users": spark.createDataFrame(users, "id long, credit_score int, yearly_income double, total_debt double, "
                                              "customer_segment string"),
        "credit_utilization": spark.createDataFrame(
            util, "customer_id long, credit_score int, yearly_income double, total_debt double, "
                  "total_credit_limit double, utilization_band string"),
    }
    f = spark.createDataFrame(txns, "transaction_id long, client_id long, transaction_month_name string, "
                                    "category string, debited_amount double, credited_amount double, "
                                    "merchant_state string, merchant_city string, is_fraud int")
    gold["fraud_monitoring"] = f
    gold["transactions"] = f.drop("is_fraud")
    return gold, users, util, txns


def as_dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_fact_by_dimension_reports(spark):
    gold, users, util, txns = make_gold(spark)
    band = {c[0]: c[5] for c in util}
    seg = {u[0]: u[4] for u in users}
    want_band, want_seg = Counter(), Counter()
    cust_band, cust_seg = defaultdict(set), defaultdict(set)
    for t in txns:
        b, s = band.get(t[1]), seg.get(t[1])
        want_band[b] += t[1] is not None
        want_seg[s] += t[1] is not None
        if t[1] is not None:
            cust_band[b].add(t[1])
            cust_seg[s].add(t[1])
    assert as_dict(RP.transactions_by_band(gold), "utilization_band", "transaction_count") == dict(want_band)
    assert as_dict(RP.transactions_by_segment(gold), "customer_segment", "transaction_count") == dict(want_seg)
    assert as_dict(RP.customers_by_band(gold), "utilization_band", "distinct_customers") == {
        k: len(v) for k, v in cust_band.items()}
    assert as_dict(RP.customers_by_segment(gold), "customer_segment", "distinct_customers") == {
        k: len(v) for k, v in cust_seg.items()}


def test_fraud_investigation_and_labels(spark):
    gold, users, util, txns = make_gold(spark)
    high = {c[0] for c in util if c[5] == "High (>70%)"}
    want = sorted((t[0], t[2], t[1], 1, t[7]) for t in txns if t[8] == 1 and t[1] in high)
    got = sorted(tuple(r) for r in RP.fraud_investigation(gold).collect())
    assert got == want
    lab = Counter((t[6], t[3]) for t in txns if t[6] is not None and t[8] is not None)
    got = {(r.merchant_state, r.category): r.labelled_transactions
           for r in RP.labelled_by_state_category(gold).collect()}
    want_all = Counter((t[6], t[3]) for t in txns if t[6] is not None)
    assert got == {k: lab.get(k, 0) for k in want_all}


def test_money_reports(spark):
    gold, users, util, txns = make_gold(spark)
    want = defaultdict(int)
    for t in txns:
        want[t[2]] += round(t[4] * 100)
    got = as_dict(RP.monthly_debit_credit(gold), "transaction_month_name", "total_debited")
    assert got == {k: v / 100 for k, v in want.items()}
