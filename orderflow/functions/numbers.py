"""Tolerant number reading, exact money sums and money texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow.functions.text import trimmed

_MONEY = "decimal(28,6)"


def int_from_text(text: Column) -> Column:
    """32-bit integer from JSON text: ``1``, ``"1"`` and ``1.7`` are read, fractions are cut."""
    number = text.try_cast("double")
    whole = F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number))
    fits = (number > -2147483649.0) & (number < 2147483648.0)
    return F.when(fits, whole).try_cast("int")


def double_from_text(text: Column) -> Column:
    """Number from JSON text; blank gives null."""
    return text.try_cast("double")


def _is_quoted_fraction(value: Column) -> Column:
    """A JSON text where an integer belongs that is no whole number; blank is no number at all."""
    text = variant_text(value)
    return (F.schema_of_variant(value) == "STRING") & ~text.rlike(r"^\s*(?:[+-]?[0-9]+|null)?\s*$")


def variant_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def int_from_variant(value: Column) -> Column:
    """32-bit integer from a JSON value: fractions of numbers are cut, those in quotes are refused."""
    return F.when(~F.coalesce(_is_quoted_fraction(value), F.lit(False)), int_from_text(variant_text(value)))


def double_from_variant(value: Column) -> Column:
    return double_from_text(variant_text(value))


def _is_content(text: Column) -> Column:
    """Whether there is anything to read: blank and ``null`` mean that there is no number."""
    return ~text.rlike(r"^\s*(?:null)?\s*$")


def is_bad_int(value: Column) -> Column:
    text = variant_text(value)
    return text.isNotNull() & int_from_variant(value).isNull() & _is_content(text)


def is_bad_double(value: Column) -> Column:
    text = variant_text(value)
    return text.isNotNull() & double_from_text(text).isNull() & _is_content(text)


def lenient_double(text: Column) -> Column:
    """Number or 0; a text that is no number also counts as 0."""
    return F.coalesce(trimmed(text.cast("string")).try_cast("double"), F.lit(0.0))


def lenient_long(text: Column) -> Column:
    number = lenient_double(text)
    whole = F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number))
    return F.coalesce(whole.try_cast("bigint"), F.lit(0).cast("bigint"))


def is_not_number(text: Column) -> Column:
    """Non-blank text that is no number (callers that must not guess send such rows away)."""
    bare = trimmed(text.cast("string"))
    return (bare != "") & bare.try_cast("double").isNull()


def exact_money(amount: Column) -> Column:
    """The amount as a decimal, so that sums do not depend on the order rows arrive in."""
    return F.coalesce(amount, F.lit(0.0)).try_cast(_MONEY)


def beyond_money(amount: Column) -> Column:
    """The part of a sum no decimal can hold (above 10^22, or not finite); 0 as a rule."""
    return F.when(amount.isNotNull() & exact_money(amount).isNull(), amount).otherwise(F.lit(0.0))


def money_sum(amount: Column) -> Column:
    """Aggregate: sum of doubles, exact for money-sized values, whole for any other."""
    exact = F.coalesce(F.sum(exact_money(amount)).cast("double"), F.lit(0.0))
    return exact + F.coalesce(F.sum(beyond_money(amount)), F.lit(0.0))


def to_cents(amount: Column) -> Column:
    """Whole cents, halves rounded up (also for negative amounts).

    Null for what is no number or is not finite. Amounts beyond 64 bits count as the largest number there is.
    """
    number = trimmed(amount).try_cast("double")
    return F.when(F.abs(number) < float("inf"), F.floor(number * 100 + 0.5))


def cents_text(cents: Column) -> Column:
    """``31205`` as ``312.05``; the sign is written once, in front."""
    sign = F.when(cents < 0, F.lit("-")).otherwise(F.lit(""))
    bare = F.abs(cents).cast("string")
    digits = F.when(F.length(bare) < 3, F.lpad(bare, 3, "0")).otherwise(bare)
    whole = F.substring(digits, F.lit(1), F.length(digits) - 2)
    return F.concat(sign, whole, F.lit("."), F.right(digits, F.lit(2)))
