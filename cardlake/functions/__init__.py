"""Column-level building blocks (no DataFrame in, Column out)."""

from cardlake.functions.parse import (  # noqa: F401
    money,
    to_long,
    to_int,
    month_year_date,
    yes_no,
    parse_timestamp,
    calendar_parts,
    trimmed,
)
from cardlake.functions.rules import (  # noqa: F401
    SegmentThresholds,
    BandEdges,
    transaction_type,
    absolute_amount,
    fraud_flag,
    guarded_ratio,
    customer_segment,
    utilization_band,
    debited_amount,
    credited_amount,
    age_band,
    money_sum,
)
