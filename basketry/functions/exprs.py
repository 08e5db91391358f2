"""Pure ``Column -> Column`` helpers.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (labels and bin edges).
# ---------------------------------------------------------------------------
AGE_EDGES = [17, 25, 35, 45, 55, 65, 100]
AGE_LABELS = ["18-25", "26-35", "36-45", "46-55", "56-65", "65+"]
DISCOUNT_EDGES = [-1, 0, 10, 20, 100]
DISCOUNT_LABELS = ["No Discount", "Low (1-10%)", "Mid (11-20%)", "High (21%+)"]
PROBABILITY_EDGES = [-0.01, 0.3, 0.6, 1.01]
RISK_LABELS = ["Low Risk", "Medium Risk", "High Risk"]
RFM_SEGMENTS = [(13, "Champions"), (10, "Loyal Customers"), (7, "Potential Loyalists"),
                (5, "At Risk")]
RFM_SEGMENT_ELSE = "Lost"
IDLE_RISK = [(365, "High Risk"), (180, "Medium Risk")]
IDLE_RISK_ELSE = "Low Risk"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------------------
# Binning (P11, P12, P13): pandas ``cut`` semantics, right-closed (a, b],
# values outside every bin (and NULL) map to NULL.  Bucketizer would be
# left-closed, so a CASE chain is used instead.
# ---------------------------------------------------------------------------
def bin_right(col, edges: Sequence[float], labels: Sequence[str]) -> Column:
    if len(edges) != len(labels) + 1:
        raise ValueError("need len(labels) + 1 edges")
    c = _c(col)
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def age_group(col="age") -> Column:
    return bin_right(col, AGE_EDGES, AGE_LABELS)


def discount_bucket(col="discount_percent") -> Column:
    return bin_right(col, DISCOUNT_EDGES, DISCOUNT_LABELS)


def churn_risk_bin(col="churn_probability") -> Column:
    return bin_right(col, PROBABILITY_EDGES, RISK_LABELS)


# ---------------------------------------------------------------------------
# Text normalisation (P16): Python ``str.strip`` + ``str.title``.
# ---------------------------------------------------------------------------
def strip_ws(col) -> Column:
    """Strip every kind of leading/trailing whitespace (``trim`` only strips spaces)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def title_case(col) -> Column:
    """Python ``str.title``: upper-case the first letter of every run of letters.

    ``initcap`` only starts words after spaces ("O'neil"); here the string is
    split into alternating letter / non-letter runs and each letter run is
    capitalised, which matches Python for apostrophes, hyphens and digits.
    """
    runs = F.regexp_extract_all(_c(col), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)),
                                             F.lower(F.substr(r, F.lit(2))))),
        "")


def normalise_text(col) -> Column:
    return title_case(strip_ws(col))


# ---------------------------------------------------------------------------
# Numeric helpers.
# ---------------------------------------------------------------------------
def clip_keep_null(col, lo, hi) -> Column:
    """pandas ``clip``: NULL stays NULL (``least``/``greatest`` skip NULLs)."""
    c = _c(col)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def _idiv(a: Column, b: Column) -> Column:
    """Integral quotient of non-negative decimals, all digits kept (``div`` would
    give a BIGINT, which wraps beyond 9.2e18)."""
    return ((a - a % b) / b).cast("decimal(38,0)")


def round_ratio(num, den, digits: int = 2, mode: str = "half_up") -> Column:
    """Exact ``round(num / den, digits)`` for integral ``num``/``den``.

    The quotient is never materialised as a binary float, so ties are real
    ties: ``half_up`` rounds them away from zero (SQL ``ROUND``), ``half_even``
    to the even neighbour (Python/pandas ``round``).  Result is DOUBLE;
    NULL when ``den`` is NULL or 0.
    """
    scale = 10 ** digits
    n = _c(num).cast("decimal(38,0)")
    d = _c(den).cast("decimal(38,0)")
    t = F.abs(n) * F.lit(scale).cast("decimal(38,0)")
    if mode == "half_up":
        q = _idiv(t * 2 + d, d * 2)
    elif mode == "half_even":
        q0 = _idiv(t, d)
        r = t - q0 * d
        q = q0 + F.when((r * 2 > d) | ((r * 2 == d) & (q0 % 2 == 1)), 1).otherwise(0)
    else:
        raise ValueError(mode)
    signed = F.when(n < 0, -q).otherwise(q)
    return F.when(d.isNull() | (d == 0), F.lit(None).cast("double")) \
        .otherwise(signed.cast("double") / F.lit(float(scale)))


def cents(col) -> Column:
    """Money (2-decimal) as an exact integer number of cents.

    18 digits per value keep the per-row arithmetic on longs; sums widen by
    themselves (decimal(28,0), then decimal(38,0)).
    """
    return (_c(col) * 100).cast("decimal(18,0)")


def mean_double(total, n) -> Column:
    """Unrounded mean as one IEEE division of two exact integers; like the BI
    ``DIVIDE`` it is NULL, not an error, on a zero denominator (P20)."""
    return F.try_divide(_c(total).cast("double"), _c(n).cast("double"))


# ---------------------------------------------------------------------------
# Dates (P2-P10, P18).
# ---------------------------------------------------------------------------
def month_key(col) -> Column:
    return F.date_format(_c(col), "yyyy-MM")


def month_name(col) -> Column:
    return F.date_format(_c(col), "MMM")


def day_name(col) -> Column:
    return F.date_format(_c(col), "EEEE")


def is_weekend(col) -> Column:
    """Monday = 0 ... Sunday = 6; weekend is >= 5."""
    return F.weekday(_c(col)) >= 5


def weekend_label(col) -> Column:
    """``STRFTIME('%w')`` in ('0','6') -> 'Weekend' (Sunday=1, Saturday=7 in Spark)."""
    return F.when(F.dayofweek(_c(col)).isin(1, 7), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def as_date(value) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    return F.lit(value)


def date_days_between(end, start) -> Column:
    return F.datediff(_c(end), _c(start))


# ---------------------------------------------------------------------------
# Labels (P14, P15, P21, P23).
# ---------------------------------------------------------------------------
def rfm_segment(score) -> Column:
    c = _c(score)
    expr = None
    for threshold, label in RFM_SEGMENTS:
        expr = F.when(c >= threshold, label) if expr is None else expr.when(c >= threshold, label)
    return expr.otherwise(RFM_SEGMENT_ELSE)


def idle_risk_flag(days) -> Column:
    """NULL days (never purchased) fall through to the last label, as in SQL."""
    c = _c(days)
    expr = None
    for threshold, label in IDLE_RISK:
        expr = F.when(c > threshold, label) if expr is None else expr.when(c > threshold, label)
    return expr.otherwise(IDLE_RISK_ELSE)


def recency_churn_label(recency, days: int = 180) -> Column:
    return (_c(recency) > days).cast("int")
