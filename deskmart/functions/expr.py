"""Column builders shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- numbers -----------------------------------------------------------------


def div0(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a / b``; 0 when ``b`` is 0 (whatever ``a`` is); otherwise NULL when either is NULL."""
    a, b = col(a), col(b)
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a / b`` as double, NULL when ``b`` is 0."""
    return col(a).cast("double") / F.nullifzero(col(b).cast("double"))


# --- dates -------------------------------------------------------------------


def month_of(c: ColumnOrName) -> Column:
    """First day of the month as a DATE, independent of the session time zone."""
    return F.trunc(col(c).cast("date"), "MM")


# --- null-tolerant tests -----------------------------------------------------


def not_true(flag: ColumnOrName) -> Column:
    """True for FALSE and for NULL."""
    return ~F.coalesce(col(flag).cast("boolean"), F.lit(False))


def in_or_null(c: ColumnOrName, values: Sequence[str]) -> Column:
    return col(c).isin(*values) | col(c).isNull()


def not_in_or_null(c: ColumnOrName, values: Sequence[str]) -> Column:
    return ~col(c).isin(*values) | col(c).isNull()


def unless(condition: Column) -> Column:
    """Keep a row unless ``condition`` is true (NULL keeps it)."""
    return ~F.coalesce(condition, F.lit(False))


# --- buckets and labels ------------------------------------------------------
# The labels and bounds below must equal those of the reports.


def sku_bucket(sku: ColumnOrName = "sku", capacity: ColumnOrName = "capacity") -> Column:
    cap = col(capacity)
    return (
        F.when(col(sku) == "DD", "DD")
        .when(cap <= 9, "1-9P")
        .when(cap <= 49, "10-49P")
        .when(cap >= 50, "50P+")
    )


def deal_size_band(desks: ColumnOrName) -> Column:
    """Zero, negative and unknown totals fall to the open-ended band."""
    return F.when(col(desks).between(1, 9), "1-9P").when(col(desks).between(10, 49), "10-49P").otherwise("50P+")


def occupancy_band(share: ColumnOrName) -> Column:
    s = col(share)
    return (
        F.when(s < 0.6, "<60%")
        .when(s < 0.7, "60-69%")
        .when(s < 0.8, "70-79%")
        .when(s < 0.9, "80-89%")
        .when(s >= 0.9, "90%+")
    )


def discount_term_bucket(months: ColumnOrName) -> Column:
    """Commitment length in months -> the term under which discounts are listed."""
    m = col(months)
    return (
        F.when((m >= 2) & (m < 7), 6)
        .when((m >= 7) & (m < 13), 12)
        .when((m >= 13) & (m < 25), 24)
        .when(m >= 25, 36)
        .otherwise(1)
    )


def policy_label(difference: ColumnOrName) -> Column:
    """Out of policy when the granted discount exceeds the listed one by over 0.2 points."""
    return F.when(col(difference) < -0.002, "OOP").otherwise("In Policy")


def term_key(term_id: ColumnOrName, month: ColumnOrName) -> Column:
    """The term id, or a month-to-month key when the space has no term."""
    return F.coalesce(col(term_id).cast("string"), F.concat(F.lit("M2M"), col(month).cast("string")))


def flagged_label(reason: ColumnOrName, key_found: Column, wanted: str, other: str) -> Column:
    return F.when(key_found & (col(reason) == wanted), wanted).otherwise(other)


def memberships(
    full: ColumnOrName = "commitment_full_duration",
    remaining: ColumnOrName = "commitment_remaining_duration",
    capacity: ColumnOrName = "capacity",
) -> Column:
    """Capacity in the first month of a commitment, else 0."""
    return F.when(col(full) == col(remaining), col(capacity)).otherwise(0)


def building_label(code: ColumnOrName, name: ColumnOrName) -> Column:
    return F.concat(col(code), F.lit(" - "), col(name))


def floor_price(price: ColumnOrName, discount: ColumnOrName, months: ColumnOrName | None = None) -> Column:
    out = col(price).cast("double") * (F.lit(1.0) - F.coalesce(col(discount), F.lit(0.0)))
    return out if months is None else out * col(months)
