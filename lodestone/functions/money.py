"""Numbers, money and time as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(c: Column) -> Column:
    """Integer cents of an amount in dollars, half up."""
    return F.floor(c * 100 + 0.5).cast("long")


def dollars_to_cents(c: Column) -> Column:
    """Cents of a price string; null where it's blank, malformed or not above zero."""
    bare = F.regexp_replace(F.trim(c), r"[$,\s]", "")
    value = F.when(bare.rlike(r"^-?\d+(\.\d+)?$"), F.floor(bare.try_cast("double") * 100 + 0.5).cast("long"))
    return F.when(value > 0, value)


def tolerant_number(c: Column) -> Column:
    return F.regexp_replace(c, r"[$,\s]", "").try_cast("double")


def flag(c: Column) -> Column:
    """1 for true and 1 in any spelling, else 0."""
    return F.when(F.lower(c.cast("string")).isin("true", "1"), 1).otherwise(0)


def currency_factor(currency: Column, yen_per_dollar: Column) -> Column:
    """struct(factor, reason): dollars and blanks 1, yen by a rate from 50 to 1000, anything else a reason to skip."""
    code = F.coalesce(F.nullif(F.upper(F.trim(currency)), F.lit("")), F.lit("USD"))
    rate = F.when(yen_per_dollar.between(50, 1000), yen_per_dollar)
    factor = F.when(code == "USD", F.lit(1.0)).when(code == "JPY", 1 / rate)
    reason = F.when(factor.isNotNull(), F.lit(None).cast("string")).when(code == "JPY", "no-rate").otherwise("unsupported")
    return F.struct(factor.alias("factor"), reason.alias("reason"))


def convert(value: Column, factor: Column) -> Column:
    """An amount times a factor, half up to cents."""
    return F.floor(value * factor * 100 + 0.5) / 100


def epoch_seconds(c: Column) -> Column:
    """Seconds from seconds, milliseconds or an ISO time."""
    number = c.try_cast("double")
    return F.when(number > 1e12, F.floor(number / 1000)).when(number.isNotNull(), F.floor(number)).otherwise(F.unix_timestamp(F.try_to_timestamp(c))).cast("long")


def backoff_due(status: Column, attempts: Column, last: Column, now: Column, base: int = 7200, most: int = 5, stale: int = 21600) -> Column:
    """Whether a work row may be taken: pending, claimed too long ago, or failed with its doubled delay over and attempts left."""
    due = now - last >= F.lit(base) * F.expr("1L") * F.pow(F.lit(2.0), attempts).cast("long")
    return (status == "pending") | ((status == "processing") & (now - last >= stale)) | ((status == "error") & (attempts < most) & due)
