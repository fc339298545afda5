"""Business rules of the gold layer as Column expressions.

Thresholds and labels below must equal the source workload's for identical
results; they are kept together and passed as parameters where a caller may
want other edges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Labels and thresholds of the workload.
CREDIT_LABEL = "Credit"
DEBIT_LABEL = "Debit"
ZERO_LABEL = "Zero"
FRAUD_YES = "Yes"
HIGH_VALUE = "High-Value"
AT_RISK = "At-Risk"
MEDIUM_VALUE = "Medium-Value"
BAND_LOW = "Low (<30%)"
BAND_MEDIUM = "Medium (30%-70%)"
BAND_HIGH = "High (>70%)"


@dataclass(frozen=True)
class SegmentThresholds:
    # Segment edges (first matching rule wins).
    high_value_min_score: int = 750
    high_value_min_income: float = 75000.0
    high_value_max_ratio: float = 0.40
    at_risk_below_score: int = 600
    at_risk_above_ratio: float = 0.75


@dataclass(frozen=True)
class BandEdges:
    # Utilization band edges, low is strict, medium inclusive.
    low_below: float = 0.30
    medium_upto: float = 0.70


# Age bands are not defined by the source workload (the served column has no
# rule there); these edges are this library's own choice, overridable.
DEFAULT_AGE_EDGES = (25, 35, 45, 55, 65)


def transaction_type(amount: str | Column) -> Column:
    """amount < 0 -> Credit, amount > 0 -> Debit, else (0 or NULL) -> Zero."""
    a = _col(amount)
    return F.when(a < 0, CREDIT_LABEL).when(a > 0, DEBIT_LABEL).otherwise(ZERO_LABEL)


def absolute_amount(amount: str | Column) -> Column:
    return F.abs(_col(amount))


def fraud_flag(label: str | Column) -> Column:
    """Exactly ``Yes`` -> 1, anything else including NULL -> 0 (no trim, no case fold)."""
    return F.when(_col(label) == FRAUD_YES, F.lit(1)).otherwise(F.lit(0))


def guarded_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den when den > 0, else NULL."""
    d = _col(den)
    return F.when(d > 0, _col(num) / d)


def customer_segment(
    score: str | Column = "credit_score",
    income: str | Column = "yearly_income",
    ratio: str | Column = "debt_to_income_ratio",
    t: SegmentThresholds = SegmentThresholds(),
) -> Column:
    """Ordered rules; SQL three-valued logic decides NULL inputs (NULL ratio can
    never be High-Value, is At-Risk only by score, else Medium-Value)."""
    s, i, r = _col(score), _col(income), _col(ratio)
    return (
        F.when(
            (s >= t.high_value_min_score) & (i >= t.high_value_min_income) & (r < t.high_value_max_ratio),
            HIGH_VALUE,
        )
        .when((s < t.at_risk_below_score) | (r > t.at_risk_above_ratio), AT_RISK)
        .otherwise(MEDIUM_VALUE)
    )


def utilization_band(
    utilization: str | Column = "credit_utilization",
    edges: BandEdges = BandEdges(),
    null_band: str | None = BAND_HIGH,
) -> Column:
    """Three bands. A NULL utilization (no card, or zero total limit) falls
    through to ``null_band``, by default the High band like the source workload."""
    u = _col(utilization)
    banded = F.when(u < edges.low_below, BAND_LOW).when(u <= edges.medium_upto, BAND_MEDIUM)
    if null_band == BAND_HIGH:
        return banded.otherwise(BAND_HIGH)
    return banded.when(u.isNotNull(), BAND_HIGH).otherwise(F.lit(null_band))


def debited_amount(amount: str | Column) -> Column:
    """abs(amount) for amount < 0, else 0.0 (NULL amount -> 0.0)."""
    a = _col(amount)
    return F.when(a < 0, F.abs(a)).otherwise(F.lit(0.0))


def credited_amount(amount: str | Column) -> Column:
    """amount for amount > 0, else 0.0 (NULL amount -> 0.0)."""
    a = _col(amount)
    return F.when(a > 0, a).otherwise(F.lit(0.0))


def age_band(age: str | Column = "current_age", edges: tuple[int, ...] = DEFAULT_AGE_EDGES) -> Column:
    """``<25``, ``25-34``, ..., ``65+``; NULL age -> NULL."""
    a = _col(age)
    expr = F.when(a < edges[0], F.lit(f"<{edges[0]}"))
    for lo, hi in zip(edges, edges[1:]):
        expr = expr.when(a < hi, F.lit(f"{lo}-{hi - 1}"))
    return expr.when(a.isNotNull(), F.lit(f"{edges[-1]}+"))


# Magnitudes below which a double holds ten, six and two decimal places (2**53 steps of each), and a long any whole number.
TEN_PLACES, SIX_PLACES, TWO_PLACES, LONG_RANGE = (f"{x!r}D" for x in (2**53 / 1e10, 2**53 / 1e6, 2**53 / 1e2, 2.0**63))
LIMB_BITS = 21  # no limb's sum overflows below 2**41 rows


def _limbs(x: str, limbs: int) -> list[str]:
    """SQL: a whole number in ``limbs`` pieces, which add up as longs."""
    return [f"shiftright({x}, {i * LIMB_BITS})" + (f" & {2**LIMB_BITS - 1}L" if i < limbs - 1 else "") for i in range(limbs)]


def _limb_sum(sums: list[str]) -> str:
    """SQL: the sum of whole numbers as a decimal without places, from the sums of their pieces."""
    return " + ".join(f"CAST({s} AS DECIMAL(19,0)) * {2 ** (i * LIMB_BITS)}BD" for i, s in enumerate(sums))


def money_sum(c: str | Column) -> Column:
    """Order-independent sum of a column, rounded to a double once: the same on every partitioning. Every value is
    rounded to the decimal places its double holds (ten below 900,719, six below 9e9, two below 9e13; beyond it is
    taken as it is) and cut into limbs of whole numbers, which are summed as longs. Values from 2**63 on are
    summed as doubles, so none is dropped. Non-finite values count as missing.

    Written as SQL text: one call to the engine in place of some hundred. A column that has no name enters the
    same text as the variable of a lambda."""
    v = f"CAST(`{c}` AS DOUBLE)" if isinstance(c, str) else "CAST(x AS DOUBLE)"
    small = f"CASE WHEN abs({v}) < {LONG_RANGE} THEN {v} END"
    whole = f"CAST({small} AS BIGINT)"

    def by_size(ten: str, six: str, two: str) -> str:
        return f"CASE WHEN abs({v}) < {TEN_PLACES} THEN {ten} WHEN abs({v}) < {SIX_PLACES} THEN {six} " \
               f"WHEN abs({v}) < {TWO_PLACES} THEN {two} ELSE {ten} END"

    places = (f"CAST(rint(({small}) % 1D * {by_size('1E10D', '1E6D', '1E2D')}) AS BIGINT)"
              f" * {by_size('1L', '10000L', '100000000L')}")
    pieces = [*_limbs(whole, 3), *_limbs(places, 2),
              f"CASE WHEN abs({v}) >= {LONG_RANGE} AND abs({v}) < double('Infinity') THEN {v} END"]

    def total(sums: list[str]) -> str:
        wholes, huge = _limb_sum(sums[:3]), sums[5]
        units = f"try_add(try_multiply({wholes}, 10000000000BD), {_limb_sum(sums[3:5])})"
        exact = f"coalesce(CAST(concat(CAST({units} AS STRING), 'E-10') AS DOUBLE), CAST({wholes} AS DOUBLE))"
        return f"CASE WHEN {sums[0]} IS NOT NULL THEN {exact} + coalesce({huge}, 0D) ELSE {huge} END"

    if isinstance(c, str):
        return F.expr(total([f"sum({p})" for p in pieces]))
    named = ", ".join(f"'s{i}', {p}" for i, p in enumerate(pieces))
    cut = F.call_function("transform", F.array(c), F.expr(f"x -> named_struct({named})"))[0]
    sums = F.struct(*[F.sum(cut[f"s{i}"]).alias(f"s{i}") for i in range(len(pieces))])
    return F.call_function("transform", F.array(sums), F.expr(f"x -> {total([f'x.s{i}' for i in range(len(pieces))])}"))[0]
