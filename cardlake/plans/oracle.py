"""Independent SQL definitions of every registered query, for DuckDB.

Written directly in SQL from the workload's rules (not generated from the
Spark plans): raw fixtures, silver cleaning with ``row_number`` de-duplication,
gold joins, views and report queries. Each query is
``WITH <layers> SELECT ...`` over the driver tables.

DuckDB typing notes: year()/month() return BIGINT and sum(int) HUGEINT, so
both are cast to Spark's types; regexp_replace needs the 'g' flag.
"""

from __future__ import annotations


def _money(x: str) -> str:
    return (
        f"concat('$', CAST(CAST(floor(({x}) / 1000) AS BIGINT) AS VARCHAR), ',', "
        f"lpad(CAST(({x}) % 1000 AS VARCHAR), 3, '0'))"
    )


def _money_parse(c: str) -> str:
    value = f"TRY_CAST(regexp_replace(CAST({c} AS VARCHAR), '[$,]', '', 'g') AS DOUBLE)"
    return f"CASE WHEN isfinite({value}) THEN {value} END"


def _money_sum(c: str) -> str:
    # the decimal total goes through its text: that gives the nearest double
    return f"CAST(CAST(sum(CAST({c} AS DECIMAL(28,10))) AS VARCHAR) AS DOUBLE)"


def _yes_no(c: str) -> str:
    return (
        f"CASE WHEN upper(trim({c})) = 'YES' THEN true "
        f"WHEN upper(trim({c})) = 'NO' THEN false END"
    )


def _dedup(source: str, key: str, cols: list[str]) -> str:
    others = [c for c in cols if c != key]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in others)
    sel = ", ".join(cols)
    return (
        f"SELECT {sel} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn__ "
        f"FROM ({source})) WHERE rn__ = 1"
    )


RAW_USERS = f"""
SELECT CASE WHEN c_custkey % 50 = 49 THEN c_custkey - 1 ELSE c_custkey END AS id,
  CAST(18 + c_custkey % 73 AS INT) AS current_age,
  CAST(60 + c_custkey % 11 AS INT) AS retirement_age,
  CAST(1930 + c_custkey % 73 AS INT) AS birth_year,
  CAST(1 + c_custkey % 12 AS INT) AS birth_month,
  CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  c_name AS address,
  CAST(25 + c_custkey % 24 AS DOUBLE) AS latitude,
  CAST(-70 - c_custkey % 50 AS DOUBLE) AS longitude,
  {_money('10000 + (c_custkey * 131) % 60000')} AS per_capita_income,
  CASE WHEN c_custkey % 97 = 0 THEN '$0' WHEN c_custkey % 101 = 100 THEN 'unknown'
       ELSE {_money('20000 + (c_custkey * 7919) % 130000')} END AS yearly_income,
  {_money('1000 + (c_custkey * 4241) % 120000')} AS total_debt,
  CAST(480 + (c_custkey * 53) % 371 AS INT) AS credit_score,
  CAST(1 + c_custkey % 9 AS INT) AS num_credit_cards
FROM customer"""

RAW_CARDS = f"""
SELECT o_orderkey AS id,
  CASE WHEN o_custkey % 37 = 36 THEN o_custkey - 1 ELSE o_custkey END AS client_id,
  CASE WHEN o_custkey % 23 = 0 THEN '$0' WHEN o_orderkey % 1009 = 5 THEN 'NaN'
    WHEN o_orderkey % 1013 = 6 THEN '$0.004' ELSE {_money('500 + (o_orderkey * 613) % 20000')} END AS credit_limit,
  CAST(1 + o_orderkey % 3 AS INT) AS num_cards_issued,
  CASE WHEN o_orderkey % 1000 = 4 THEN '13/2020' ELSE strftime(o_orderdate, '%m/%Y') END AS acct_open_date,
  concat(lpad(CAST(1 + o_orderkey % 12 AS VARCHAR), 2, '0'), '/', CAST(2020 + o_orderkey % 10 AS VARCHAR)) AS expires,
  CASE o_orderkey % 12 WHEN 0 THEN 'YES' WHEN 4 THEN ' no ' ELSE 'n/a' END AS has_chip,
  CASE WHEN o_orderkey % 40 = 0 THEN 'Yes' ELSE 'No' END AS card_on_dark_web
FROM orders"""

RAW_TRANSACTIONS = """
SELECT l_orderkey * 10 + l_linenumber AS id,
  CASE WHEN l_partkey % 997 = 0 THEN 'not a date'
       ELSE strftime(l_shipdate + to_minutes(CAST(l_partkey % 1440 AS BIGINT)), '%m-%d-%Y %H:%M') END AS date,
  o_custkey AS client_id,
  l_orderkey AS card_id,
  CASE WHEN l_partkey % 503 = 0 THEN '' WHEN l_partkey % 499 = 0 THEN '$0.00'
       WHEN l_suppkey % 7 = 0 THEN concat('$-', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR))
       ELSE concat('$', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)) END AS amount,
  CASE l_linenumber % 3 WHEN 0 THEN 'Swipe' WHEN 1 THEN 'Chip' ELSE 'Online' END AS use_chip,
  l_suppkey AS merchant_id,
  s_name AS merchant_city,
  CASE WHEN s_nationkey % 9 = 0 THEN NULL ELSE n_name END AS merchant_state,
  CAST(10000 + l_suppkey AS VARCHAR) AS zip,
  CAST(l_partkey % 120 AS INT) AS mcc
FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey"""

RAW_MCC = """
SELECT mcc, CASE WHEN mcc % 33 = 32 THEN NULL ELSE category END AS category FROM (
  SELECT CAST(p_partkey % 100 AS INT) AS mcc, min(concat(' ', p_type, ' ', p_brand, ' ')) AS category
  FROM part GROUP BY CAST(p_partkey % 100 AS INT))"""

RAW_FRAUD = """
SELECT CAST(tid AS VARCHAR) AS transaction_id, fraud_label FROM (
  SELECT l_orderkey * 10 + l_linenumber AS tid,
    min(CASE WHEN l_partkey % 251 = 0 THEN 'yes' WHEN l_returnflag = 'R' THEN 'Yes' ELSE 'No' END) AS fraud_label
  FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey * 10 + l_linenumber)"""

USERS_COLS = [
    "id", "current_age", "retirement_age", "birth_year", "birth_month", "gender", "address", "latitude",
    "longitude", "per_capita_income", "yearly_income", "total_debt", "credit_score", "num_credit_cards",
]
USERS_TYPED = f"""
SELECT TRY_CAST(id AS BIGINT) AS id, TRY_CAST(current_age AS INT) AS current_age,
  TRY_CAST(retirement_age AS INT) AS retirement_age, TRY_CAST(birth_year AS INT) AS birth_year,
  TRY_CAST(birth_month AS INT) AS birth_month, gender, address,
  TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude,
  {_money_parse('per_capita_income')} AS per_capita_income, {_money_parse('yearly_income')} AS yearly_income,
  {_money_parse('total_debt')} AS total_debt, TRY_CAST(credit_score AS INT) AS credit_score,
  TRY_CAST(num_credit_cards AS INT) AS num_credit_cards
FROM raw_users"""

CARDS_COLS = [
    "id", "client_id", "credit_limit", "num_cards_issued", "acct_open_date", "expires", "has_chip",
    "card_on_dark_web",
]
CARDS_TYPED = f"""
SELECT TRY_CAST(id AS BIGINT) AS id, TRY_CAST(client_id AS BIGINT) AS client_id,
  {_money_parse('credit_limit')} AS credit_limit, TRY_CAST(num_cards_issued AS INT) AS num_cards_issued,
  CAST(try_strptime(acct_open_date, '%m/%Y') AS DATE) AS acct_open_date,
  CAST(try_strptime(expires, '%m/%Y') AS DATE) AS expires,
  {_yes_no('has_chip')} AS has_chip, {_yes_no('card_on_dark_web')} AS card_on_dark_web
FROM raw_cards"""

TXN_COLS = [
    "id", "client_id", "card_id", "amount", "use_chip", "merchant_id", "merchant_city", "merchant_state",
    "zip", "mcc", "transaction_timestamp", "transaction_date", "transaction_year", "transaction_month",
    "transaction_month_name", "transaction_type", "transaction_amount",
]
TXN_TYPED = f"""
SELECT *, CAST(transaction_timestamp AS DATE) AS transaction_date,
  CAST(year(transaction_timestamp) AS INT) AS transaction_year,
  CAST(month(transaction_timestamp) AS INT) AS transaction_month,
  monthname(transaction_timestamp) AS transaction_month_name,
  CASE WHEN amount < 0 THEN 'Credit' WHEN amount > 0 THEN 'Debit' ELSE 'Zero' END AS transaction_type,
  abs(amount) AS transaction_amount
FROM (
  SELECT TRY_CAST(id AS BIGINT) AS id, TRY_CAST(client_id AS BIGINT) AS client_id,
    TRY_CAST(card_id AS BIGINT) AS card_id, {_money_parse('amount')} AS amount, use_chip,
    TRY_CAST(merchant_id AS BIGINT) AS merchant_id, merchant_city, merchant_state,
    CAST(zip AS VARCHAR) AS zip, TRY_CAST(mcc AS INT) AS mcc,
    try_strptime(date, '%m-%d-%Y %H:%M') AS transaction_timestamp
  FROM raw_transactions)"""

MCC_TYPED = """
SELECT TRY_CAST(mcc AS INT) AS mcc, trim(CAST(category AS VARCHAR)) AS category FROM raw_mcc_codes"""

FRAUD_TYPED = """
SELECT TRY_CAST(transaction_id AS BIGINT) AS transaction_id, CAST(fraud_label AS VARCHAR) AS fraud_label,
  CASE WHEN fraud_label = 'Yes' THEN 1 ELSE 0 END AS is_fraud
FROM raw_fraud_labels"""

SILVER_USERS = _dedup(USERS_TYPED, "id", USERS_COLS)
SILVER_CARDS = _dedup(CARDS_TYPED, "id", CARDS_COLS)
SILVER_TXN = _dedup(TXN_TYPED, "id", TXN_COLS)
SILVER_MCC = _dedup(
    f"SELECT * FROM ({MCC_TYPED}) WHERE mcc IS NOT NULL AND category IS NOT NULL", "mcc", ["mcc", "category"]
)
SILVER_FRAUD = _dedup(FRAUD_TYPED, "transaction_id", ["transaction_id", "fraud_label", "is_fraud"])

GOLD_USERS = """
SELECT *, CASE
    WHEN credit_score >= 750 AND yearly_income >= 75000 AND debt_to_income_ratio < 0.40 THEN 'High-Value'
    WHEN credit_score < 600 OR debt_to_income_ratio > 0.75 THEN 'At-Risk'
    ELSE 'Medium-Value' END AS customer_segment
FROM (SELECT *, CASE WHEN yearly_income > 0 THEN total_debt / yearly_income END AS debt_to_income_ratio
      FROM silver_users)"""

CARD_TOTALS = f"""
SELECT client_id, {_money_sum('credit_limit')} AS total_credit_limit, count(DISTINCT id) AS total_cards
FROM silver_cards GROUP BY client_id"""

GOLD_UTIL = """
SELECT *, CASE WHEN credit_utilization < 0.30 THEN 'Low (<30%)'
               WHEN credit_utilization <= 0.70 THEN 'Medium (30%-70%)'
               ELSE 'High (>70%)' END AS utilization_band
FROM (
  SELECT u.id AS customer_id, u.current_age, u.gender, u.yearly_income, u.total_debt, u.credit_score,
    c.total_credit_limit, c.total_cards,
    CASE WHEN c.total_credit_limit > 0 THEN u.total_debt / c.total_credit_limit END AS credit_utilization
  FROM silver_users u LEFT JOIN card_totals c ON u.id = c.client_id)"""

_TXN_CORE = """
  t.id AS transaction_id, t.client_id, t.card_id, t.transaction_timestamp, t.transaction_date,
  t.transaction_year, t.transaction_month, t.transaction_month_name, t.amount, t.transaction_amount,
  CASE WHEN t.amount < 0 THEN abs(t.amount) ELSE CAST(0 AS DOUBLE) END AS debited_amount,
  CASE WHEN t.amount > 0 THEN t.amount ELSE CAST(0 AS DOUBLE) END AS credited_amount,
  t.use_chip, t.merchant_city, t.merchant_state, t.zip, t.mcc, m.category"""

GOLD_TXN = f"""
SELECT {_TXN_CORE}
FROM silver_transactions t LEFT JOIN silver_mcc_codes m ON t.mcc = m.mcc"""

GOLD_FRAUD = f"""
SELECT {_TXN_CORE}, f.fraud_label, f.is_fraud
FROM silver_transactions t
  LEFT JOIN silver_fraud_labels f ON t.id = f.transaction_id
  LEFT JOIN silver_mcc_codes m ON t.mcc = m.mcc"""

LAYERS = [
    ("raw_users", RAW_USERS),
    ("raw_cards", RAW_CARDS),
    ("raw_transactions", RAW_TRANSACTIONS),
    ("raw_mcc_codes", RAW_MCC),
    ("raw_fraud_labels", RAW_FRAUD),
    ("silver_users", SILVER_USERS),
    ("silver_cards", SILVER_CARDS),
    ("silver_transactions", SILVER_TXN),
    ("silver_mcc_codes", SILVER_MCC),
    ("silver_fraud_labels", SILVER_FRAUD),
    ("card_totals", CARD_TOTALS),
    ("gold_users", GOLD_USERS),
    ("gold_credit_utilization", GOLD_UTIL),
    ("gold_transactions", GOLD_TXN),
    ("gold_fraud_monitoring", GOLD_FRAUD),
]


def with_layers(select: str, overrides: dict[str, str] | None = None) -> str:
    """``WITH`` all layers, then ``select``; ``overrides`` replaces a layer's SQL
    (tests use it to feed skewed raw data through the same definitions)."""
    o = overrides or {}
    ctes = ",\n".join(f"{name} AS ({o.get(name, sql)})" for name, sql in LAYERS)
    return f"WITH {ctes}\n{select}"


TXN_A = (
    "transaction_id, client_id, card_id, transaction_timestamp, transaction_date, transaction_year, "
    "transaction_month, transaction_month_name, amount, transaction_amount, use_chip, merchant_city, "
    "merchant_state, zip, mcc, category"
)
TXN_B = (
    "transaction_id, client_id AS customer_id, card_id, transaction_year, transaction_month, "
    "transaction_month_name, transaction_amount, debited_amount, credited_amount, merchant_city, "
    "merchant_state, mcc, category"
)
FRAUD_A = (
    "transaction_id, client_id, card_id, transaction_timestamp, transaction_date, amount, transaction_amount, "
    "use_chip, merchant_city, merchant_state, mcc, category, fraud_label, is_fraud"
)
FRAUD_B = (
    "transaction_id, client_id, card_id, transaction_date, transaction_amount, debited_amount, "
    "credited_amount, merchant_city, merchant_state, mcc, category, fraud_label, is_fraud"
)
UTIL_VIEW = (
    "customer_id, current_age, gender, yearly_income, total_debt, credit_score, total_credit_limit, "
    "CAST(total_cards AS INT) AS total_cards, credit_utilization, utilization_band"
)
AGE_BAND = (
    "CASE WHEN current_age < 25 THEN '<25' WHEN current_age < 35 THEN '25-34' "
    "WHEN current_age < 45 THEN '35-44' WHEN current_age < 55 THEN '45-54' "
    "WHEN current_age < 65 THEN '55-64' WHEN current_age IS NOT NULL THEN '65+' END"
)

_REJECT_COLUMNS = {
    "users": (
        "raw_users",
        {
            "id": "TRY_CAST(id AS BIGINT)", "current_age": "TRY_CAST(current_age AS INT)",
            "retirement_age": "TRY_CAST(retirement_age AS INT)", "birth_year": "TRY_CAST(birth_year AS INT)",
            "birth_month": "TRY_CAST(birth_month AS INT)", "latitude": "TRY_CAST(latitude AS DOUBLE)",
            "longitude": "TRY_CAST(longitude AS DOUBLE)",
            "per_capita_income": _money_parse("per_capita_income"),
            "yearly_income": _money_parse("yearly_income"), "total_debt": _money_parse("total_debt"),
            "credit_score": "TRY_CAST(credit_score AS INT)",
            "num_credit_cards": "TRY_CAST(num_credit_cards AS INT)",
        },
    ),
    "cards": (
        "raw_cards",
        {
            "id": "TRY_CAST(id AS BIGINT)", "client_id": "TRY_CAST(client_id AS BIGINT)",
            "credit_limit": _money_parse("credit_limit"),
            "num_cards_issued": "TRY_CAST(num_cards_issued AS INT)",
            "acct_open_date": "try_strptime(acct_open_date, '%m/%Y')",
            "expires": "try_strptime(expires, '%m/%Y')",
            "has_chip": _yes_no("has_chip"), "card_on_dark_web": _yes_no("card_on_dark_web"),
        },
    ),
    "transactions": (
        "raw_transactions",
        {
            "id": "TRY_CAST(id AS BIGINT)", "client_id": "TRY_CAST(client_id AS BIGINT)",
            "card_id": "TRY_CAST(card_id AS BIGINT)", "merchant_id": "TRY_CAST(merchant_id AS BIGINT)",
            "mcc": "TRY_CAST(mcc AS INT)", "amount": _money_parse("amount"), "zip": "CAST(zip AS VARCHAR)",
            "date": "try_strptime(date, '%m-%d-%Y %H:%M')",
        },
    ),
    "mcc_codes": (
        "raw_mcc_codes",
        {"mcc": "TRY_CAST(mcc AS INT)", "category": "trim(CAST(category AS VARCHAR))"},
    ),
    "fraud_labels": (
        "raw_fraud_labels",
        {"transaction_id": "TRY_CAST(transaction_id AS BIGINT)", "fraud_label": "CAST(fraud_label AS VARCHAR)"},
    ),
}


def _reject_sql(only: str | None = None, source: str | None = None) -> str:
    parts = []
    for table, (src, cols) in _REJECT_COLUMNS.items():
        if only and table != only:
            continue
        src = source or src
        for col, typed in cols.items():
            bad = (
                f"{col} IS NOT NULL AND trim(CAST({col} AS VARCHAR)) <> '' AND ({typed}) IS NULL"
            )
            parts.append(
                f"SELECT '{table}' AS table_name, '{col}' AS column_name, "
                f"CAST(sum(CASE WHEN {bad} THEN 1 ELSE 0 END) AS BIGINT) AS rejected_rows FROM {src}"
            )
    return "\nUNION ALL\n".join(parts)


_ROW_KEYS = {"users": "id", "cards": "id", "transactions": "id", "mcc_codes": "mcc", "fraud_labels": "transaction_id"}


def _reject_rows_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{col}' AS column_name, CAST({_ROW_KEYS[table]} AS VARCHAR) AS row_key, "
        f"CAST({col} AS VARCHAR) AS raw_text FROM {src} "
        f"WHERE {col} IS NOT NULL AND trim(CAST({col} AS VARCHAR)) <> '' AND ({typed}) IS NULL"
        for table, (src, cols) in _REJECT_COLUMNS.items() for col, typed in cols.items())


_FRAUD_RATE = """
SELECT merchant_state, category, CAST(sum(is_fraud) AS BIGINT) AS fraud_transactions,
  count(is_fraud) AS labelled_transactions, avg(is_fraud) AS fraud_rate
FROM gold_fraud_monitoring WHERE merchant_state IS NOT NULL GROUP BY merchant_state, category"""

SELECTS = {
    # silver (cleaned, typed, one row per key)
    "silver_users": "SELECT * FROM silver_users",
    "silver_cards": "SELECT * FROM silver_cards",
    "silver_transactions": "SELECT * FROM silver_transactions",
    "silver_mcc_codes": "SELECT * FROM silver_mcc_codes",
    "silver_fraud_labels": "SELECT * FROM silver_fraud_labels",
    "dedup_transactions": (
        "SELECT "
        + ", ".join(["id", "date", "client_id", "card_id", "amount", "use_chip", "merchant_id", "merchant_city",
                     "merchant_state", "zip", "mcc"])
        + " FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY "
        + ", ".join(f"{c} ASC NULLS FIRST" for c in ["date", "client_id", "card_id", "amount", "use_chip",
                                                      "merchant_id", "merchant_city", "merchant_state", "zip",
                                                      "mcc"])
        + ") AS rn__ FROM raw_transactions) WHERE rn__ = 1"
    ),
    "reject_report": None,  # filled below
    "card_totals": "SELECT * FROM card_totals",
    # gold
    "gold_users": "SELECT * FROM gold_users",
    "gold_transactions": "SELECT * FROM gold_transactions",
    "gold_transactions_a": f"SELECT {TXN_A} FROM gold_transactions",
    "gold_transactions_b": f"SELECT {TXN_B} FROM gold_transactions",
    "gold_credit_utilization": "SELECT * FROM gold_credit_utilization",
    "gold_fraud_monitoring": "SELECT * FROM gold_fraud_monitoring",
    "gold_fraud_a": f"SELECT {FRAUD_A} FROM gold_fraud_monitoring",
    "gold_fraud_b": f"SELECT {FRAUD_B} FROM gold_fraud_monitoring",
    # serving views
    "vw_customer_segmentation": (
        "SELECT id AS customer_id, current_age, gender, yearly_income, total_debt, credit_score, "
        f"debt_to_income_ratio, {AGE_BAND} AS age_band, customer_segment FROM gold_users"
    ),
    "vw_spending_transactions": (
        "SELECT transaction_id, client_id, card_id, transaction_timestamp, transaction_date, amount, "
        "transaction_amount, use_chip, merchant_city, merchant_state, mcc, category FROM gold_transactions"
    ),
    "vw_credit_utilization": f"SELECT {UTIL_VIEW} FROM gold_credit_utilization",
    "vw_fraud_monitoring": f"SELECT {FRAUD_A} FROM gold_fraud_monitoring",
    "preview_fraud_monitoring": f"SELECT {FRAUD_A} FROM gold_fraud_monitoring ORDER BY transaction_id LIMIT 10",
    # measures
    "measure_average_credit_score": "SELECT avg(credit_score) AS average_credit_score FROM gold_credit_utilization",
    "measure_fraud_transactions": (
        "SELECT count(CASE WHEN is_fraud = 1 THEN 1 END) AS fraud_transactions FROM gold_fraud_monitoring"
    ),
    "measure_transaction_count": "SELECT count(transaction_id) AS total_transactions FROM gold_transactions",
    "measure_distinct_customers": "SELECT count(DISTINCT id) AS total_customers FROM gold_users",
    # report visuals
    "report_total_customers": "SELECT count(DISTINCT id) AS total_customers FROM gold_users",
    "report_total_transactions": "SELECT count(transaction_id) AS total_transactions FROM gold_transactions",
    "report_total_fraud_transactions": (
        "SELECT count(CASE WHEN is_fraud = 1 THEN 1 END) AS fraud_transactions FROM gold_fraud_monitoring"
    ),
    "report_average_credit_score": (
        "SELECT avg(credit_score) AS average_credit_score FROM gold_credit_utilization"
    ),
    "report_transactions_by_band": (
        "SELECT u.utilization_band, count(t.client_id) AS transaction_count FROM gold_transactions t "
        "LEFT JOIN gold_credit_utilization u ON t.client_id = u.customer_id GROUP BY u.utilization_band"
    ),
    "report_transactions_by_segment": (
        "SELECT g.customer_segment, count(t.client_id) AS transaction_count FROM gold_transactions t "
        "LEFT JOIN gold_users g ON t.client_id = g.id GROUP BY g.customer_segment"
    ),
    "report_scored_customers_by_segment": (
        "SELECT g.customer_segment, count(u.credit_score) AS scored_customers FROM gold_users g "
        "LEFT JOIN gold_credit_utilization u ON g.id = u.customer_id GROUP BY g.customer_segment"
    ),
    "report_monthly_debit_credit": (
        f"SELECT transaction_month_name, {_money_sum('debited_amount')} AS total_debited, "
        f"{_money_sum('credited_amount')} AS total_credited FROM gold_transactions GROUP BY transaction_month_name"
    ),
    "report_spend_by_category": (
        f"SELECT category, {_money_sum('debited_amount')} AS total_debited FROM gold_transactions GROUP BY category"
    ),
    "report_labelled_by_state_category": (
        "SELECT merchant_state, category, count(is_fraud) AS labelled_transactions FROM gold_fraud_monitoring "
        "WHERE merchant_state IS NOT NULL GROUP BY merchant_state, category"
    ),
    "report_high_risk_customers": (
        "SELECT DISTINCT u.customer_id, g.credit_score, g.yearly_income, g.total_debt, u.total_credit_limit, "
        "u.utilization_band FROM gold_credit_utilization u JOIN gold_users g ON g.id = u.customer_id "
        "WHERE u.utilization_band IN ('High (>70%)')"
    ),
    "report_fraud_investigation": (
        "SELECT DISTINCT t.transaction_id, t.transaction_month_name, t.client_id AS customer_id, f.is_fraud, "
        "f.merchant_city FROM gold_transactions t "
        "JOIN gold_fraud_monitoring f ON t.transaction_id = f.transaction_id "
        "JOIN gold_credit_utilization u ON t.client_id = u.customer_id "
        "WHERE u.utilization_band IN ('High (>70%)') AND f.is_fraud = 1"
    ),
    "report_companion_customers_by_band": (
        "SELECT u.utilization_band, count(DISTINCT t.client_id) AS distinct_customers FROM gold_transactions t "
        "LEFT JOIN gold_credit_utilization u ON t.client_id = u.customer_id GROUP BY u.utilization_band"
    ),
    "report_companion_customers_by_segment": (
        "SELECT g.customer_segment, count(DISTINCT t.client_id) AS distinct_customers FROM gold_transactions t "
        "LEFT JOIN gold_users g ON t.client_id = g.id GROUP BY g.customer_segment"
    ),
    "report_companion_fraud_rate": _FRAUD_RATE,
    "report_companion_monthly_by_number": (
        f"SELECT transaction_month, transaction_month_name, {_money_sum('debited_amount')} AS total_debited, "
        f"{_money_sum('credited_amount')} AS total_credited FROM gold_transactions "
        "GROUP BY transaction_month, transaction_month_name"
    ),
}
SELECTS["reject_report"] = SELECTS["reject_report_observed"] = _reject_sql()
SELECTS["reject_rows"] = _reject_rows_sql()
SELECTS["table_published"] = "SELECT * FROM gold_users"
SELECTS["measure_distinct_customers_by_month"] = (
    "SELECT CAST(year(transaction_date) AS INT) AS transaction_year, CAST(month(transaction_date) AS INT) AS transaction_month, "
    "count(DISTINCT client_id) AS distinct_customers, 'month' AS span FROM gold_transactions WHERE client_id IS NOT NULL "
    "GROUP BY 1, 2 UNION ALL SELECT CAST(NULL AS INT), CAST(NULL AS INT), count(DISTINCT client_id), 'all' FROM gold_transactions"
)

_GOLD_USERS_REST = (
    "retirement_age, birth_year, birth_month, address, latitude, longitude, per_capita_income, "
    "yearly_income, total_debt, num_credit_cards, debt_to_income_ratio, customer_segment"
)
SELECTS.update({
    "ingest_csv_users": "SELECT * FROM raw_users",
    "ingest_csv_cards": "SELECT * FROM raw_cards",
    "ingest_csv_transactions": "SELECT * FROM raw_transactions",
    "ingest_silver_transactions": "SELECT * FROM silver_transactions",
    "ingest_mcc_map": "SELECT mcc, category FROM raw_mcc_codes",
    "ingest_mcc_json": "SELECT mcc, category FROM raw_mcc_codes WHERE category IS NOT NULL",
    "ingest_fraud_split": "SELECT CAST(transaction_id AS BIGINT) AS transaction_id, fraud_label FROM raw_fraud_labels",
    "ingest_fraud_lines": "SELECT CAST(transaction_id AS BIGINT) AS transaction_id, fraud_label FROM raw_fraud_labels",
    "ingest_fraud_whole": "SELECT CAST(transaction_id AS BIGINT) AS transaction_id, fraud_label FROM raw_fraud_labels",
    "raw_landing_csv": "SELECT * FROM raw_users",
    "raw_landing_json": "SELECT CAST(transaction_id AS BIGINT) AS transaction_id, fraud_label FROM raw_fraud_labels",
    "table_overwrite": "SELECT * FROM silver_users",
    "table_merge_schema": (
        "SELECT id, current_age, gender, credit_score, CAST(NULL AS VARCHAR) AS legacy_note, "
        + _GOLD_USERS_REST + " FROM gold_users"
    ),
    "external_table": f"SELECT {UTIL_VIEW} FROM gold_credit_utilization",
    "serving_view": f"SELECT {UTIL_VIEW} FROM gold_credit_utilization",
})


_LABELS = "SELECT CAST(transaction_id AS BIGINT) AS transaction_id, {} AS fraud_label FROM raw_fraud_labels"
_ODD_LABEL = (
    "CASE WHEN CAST(transaction_id AS BIGINT) % 89 = 4 THEN NULL "
    "WHEN CAST(transaction_id AS BIGINT) % 97 = 5 THEN 'No, disputed' "
    "WHEN CAST(transaction_id AS BIGINT) % 83 = 6 THEN 'Yes \"sic\"' ELSE fraud_label END"
)
_DIRTY_USERS = (
    "(SELECT * REPLACE (CASE WHEN id % 17 = 2 THEN concat(CAST(id AS VARCHAR), 'x') ELSE CAST(id AS VARCHAR) END AS id, "
    "CASE WHEN id % 11 = 3 THEN 'n/a' ELSE CAST(credit_score AS VARCHAR) END AS credit_score, "
    "CASE WHEN id % 13 = 5 THEN 'two' ELSE CAST(num_credit_cards AS VARCHAR) END AS num_credit_cards) FROM raw_users)"
)
SELECTS.update({
    "ingest_fraud_split_odd": _LABELS.format(_ODD_LABEL),
    "ingest_fraud_lines_odd": _LABELS.format(_ODD_LABEL),
    "ingest_fraud_split_layouts": _LABELS.format(_ODD_LABEL),
    "ingest_fraud_split_one_line": _LABELS.format(_ODD_LABEL),
    "ingest_csv_cards_extra": (
        "SELECT c.*, o.o_orderpriority AS card_brand, o.o_orderstatus AS card_type "
        "FROM raw_cards c JOIN orders o ON c.id = o.o_orderkey"
    ),
    "ingest_csv_mixed_headers": "SELECT *, CASE WHEN id % 3 = 2 THEN concat('n', CAST(id AS VARCHAR)) END AS note FROM raw_users",
    "raw_landing_csv_odd": (
        "SELECT * REPLACE (CASE id % 9 WHEN 0 THEN address || chr(10) || address WHEN 1 THEN '\\N' WHEN 2 THEN address || '\"' "
        "WHEN 3 THEN address || '\\' WHEN 4 THEN '' WHEN 5 THEN NULL "
        "WHEN 6 THEN '\"' || address || '\",' || chr(13) || chr(10) || '\\\"' ELSE address END AS address) FROM raw_users"
    ),
    "reject_report_files": _reject_sql("users", _DIRTY_USERS),
    "silver_transactions_iso": "SELECT * FROM silver_transactions",
    "silver_transactions_inferred": "SELECT * FROM silver_transactions",
    "raw_landing_csv_cards": "SELECT * FROM raw_cards",
    "raw_landing_csv_transactions": "SELECT * FROM raw_transactions",
    "raw_landing_mcc": "SELECT mcc, category FROM raw_mcc_codes",
    "scan_by_extension": "SELECT id, address, 'csv' AS extension FROM raw_users",
    "table_overwrite_in_place": "SELECT * FROM silver_users",
})
for _view, _name in (("vw_customer_segmentation", "customer_segmentation"),
                     ("vw_spending_transactions", "spending_transactions"),
                     ("vw_fraud_monitoring", "fraud_monitoring")):
    SELECTS[f"external_{_name}"] = SELECTS[f"serving_view_{_name}"] = SELECTS[_view]


def oracle_queries(overrides: dict[str, str] | None = None) -> dict[str, str]:
    return {name: with_layers(sel, overrides) for name, sel in SELECTS.items()}
