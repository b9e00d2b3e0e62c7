"""Scalar expressions shared by marts: guarded division, money, buckets, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x) -> Column:
    """Money values are carried as DECIMAL(18,2) so sums are exact and
    independent of row order; marts expose them as DOUBLE."""
    return _c(x).cast("decimal(18,2)")


def safe_div(num, den) -> Column:
    """CASE WHEN den > 0 THEN num / den ELSE NULL END, in double arithmetic."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(d > 0, n / d)


def div_or_zero(num, den) -> Column:
    """CASE WHEN den > 0 THEN num / den ELSE 0 END (also DAX DIVIDE(a, b, 0)
    for the non-negative denominators used by the measures)."""
    return F.coalesce(safe_div(num, den), F.lit(0.0))


def pct(num, den) -> Column:
    """(num * 100.0) / den guarded to 0 when den <= 0."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(d > 0, (n * F.lit(100.0)) / d).otherwise(F.lit(0.0))


# Age buckets of the aging report (upper bound in days, label).
AGE_BUCKETS_5 = [(30, "0-30 Days"), (60, "31-60 Days"), (90, "61-90 Days"), (120, "91-120 Days")]
AGE_BUCKET_5_LAST = "120+ Days"
AGE_BUCKETS_4 = [(30, "0-30 Days"), (60, "31-60 Days"), (90, "61-90 Days")]
AGE_BUCKET_4_LAST = "Over 90 Days"


def age_bucket(age_days, buckets=AGE_BUCKETS_5, last=AGE_BUCKET_5_LAST) -> Column:
    a = _c(age_days)
    expr = None
    for hi, label in buckets:
        expr = F.when(a <= hi, label) if expr is None else expr.when(a <= hi, label)
    return expr.otherwise(last)


def age_bucket_sort(age_days, buckets=AGE_BUCKETS_5) -> Column:
    a = _c(age_days)
    expr = None
    for i, (hi, _) in enumerate(buckets, start=1):
        expr = F.when(a <= hi, i) if expr is None else expr.when(a <= hi, i)
    return expr.otherwise(len(buckets) + 1)


def bad_phone(phone) -> Column:
    """Missing phone, or fewer than 10 digits once non-digits are removed."""
    p = _c(phone)
    return F.when(p.isNull() | (F.length(F.regexp_replace(p, "[^0-9]", "")) < 10), 1).otherwise(0)


def bad_email(email) -> Column:
    """Missing e-mail, or not shaped like something@domain.tld."""
    e = _c(email)
    return F.when(e.isNull() | ~e.like("%@%.%"), 1).otherwise(0)
