"""Column functions: money, rounding, time, JSON fields, safe division, level cut-offs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, places: int) -> Column:
    """x rounded half up by way of six decimal places, so that the last binary digits of a sum decide nothing."""
    return F.round(x.cast("decimal(18,6)"), places)


def money(x: Column) -> Column:
    return rounded(x, 2).cast("decimal(15,2)")


def safe_divide(a: Column, b: Column) -> Column:
    """a / b in double, null where b is zero or null."""
    return F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0)))


def amount_key(amount: Column, step: str) -> Column:
    """The largest multiple of step that is not above the amount: with a step of a cent the amount in cents."""
    if step == "0.01":
        return amount.cast("decimal(15,2)")
    return (F.floor(amount.cast("decimal(15,2)") / F.lit(step).cast("decimal(15,2)")) * F.lit(step).cast("decimal(15,2)")).cast("decimal(15,2)")


def seconds_between(a: Column, b: Column) -> Column:
    """Seconds from a to b as double, of either kind of timestamp."""
    micros = lambda t: F.unix_micros(t.cast("timestamp"))
    return (micros(b) - micros(a)) / F.lit(1_000_000.0)


def json_field(column: str, name: str, kind: str = "string") -> Column:
    """A field of a JSON column, null where it isn't of that kind."""
    return F.get_json_object(F.col(column), f"$.{name}").try_cast(kind)


def fact(column: str, name: str, kind: str = "string") -> Column:
    """A field of a VARIANT column, null where it isn't of that kind; the JSON was parsed when the column was made."""
    return F.try_variant_get(F.col(column), f"$.{name}", kind)


def pii_hash(x: Column) -> Column:
    """SHA-256 in hex; a missing value counts as the empty text."""
    return F.sha2(F.coalesce(x, F.lit("")), 256)


def risk_level(score: Column, excellent: int = 90, good: int = 70, moderate: int = 50) -> Column:
    return F.when(score >= excellent, "EXCELLENT").when(score >= good, "GOOD").when(score >= moderate, "MODERATE").otherwise("HIGH")


def risk_tier(ratio: Column) -> Column:
    """Tier of a day's alerts per invoice."""
    return F.when(ratio > 0.5, "CRITICAL").when(ratio > 0.2, "HIGH").when(ratio > 0, "MEDIUM").otherwise("CLEAN")
