"""RFC-3339 and ISO date checks, and their conversion to Spark types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_YEAR = r"(?:\d{4}|\+\d{5,10}|-\d{4,10})"
_MONTH_DAY = (
    r"(?:(?:0[13578]|1[02])-(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[469]|11)-(?:0[1-9]|[12]\d|30)"
    r"|02-(?:0[1-9]|[12]\d))"
)
_CLOCK = r"(?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d{0,9})?)?"
_OFFSET = r"(?:Z|[+-](?:(?:0\d|1[0-7])(?::[0-5]\d(?::[0-5]\d)?)?|18(?::00(?::00)?)?))"

_RFC3339 = rf"(?i)^{_YEAR}-{_MONTH_DAY}T{_CLOCK}{_OFFSET}$"
_ISO_DATE = rf"^{_YEAR}-{_MONTH_DAY}$"
_LEAP_DAY = rf"^({_YEAR})-02-29"


def _no_false_leap_day(text: Column) -> Column:
    year = F.abs(F.regexp_extract(text, _LEAP_DAY, 1).try_cast("bigint"))
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return ~text.contains("-02-29") | ~text.rlike(_LEAP_DAY) | leap


def is_rfc3339(text: Column) -> Column:
    """Date and time with a mandatory offset; seconds and up to nine fraction digits optional.

    A cast is no substitute: it takes texts without offset or with a space, and refuses
    ``22:14Z`` and a lower-case ``t`` or ``z``.
    """
    return text.isNotNull() & text.rlike(_RFC3339) & _no_false_leap_day(text)


def is_iso_date(text: Column) -> Column:
    """Strict ``yyyy-MM-dd`` that exists in the calendar."""
    return text.isNotNull() & text.rlike(_ISO_DATE) & _no_false_leap_day(text)


def to_timestamp(text: Column) -> Column:
    """Time text to TIMESTAMP, null where a table could not hold it.

    Takes all RFC-3339 forms, and whatever else the cast takes. Tables hold the years 0001 to
    9999, fewer than the wire format allows. The rarer forms (lower case, no seconds) are brought
    into shape only if the plain cast fails.
    """
    upper = F.upper(text)
    with_seconds = F.regexp_replace(upper, r"T(\d\d:\d\d)(Z|[+-])", "T$1:00$2")
    plain = F.regexp_replace(with_seconds, r"\.(Z|[+-])", "$1")
    bare = F.ltrim(text)
    four_digit_year = (F.substring(bare, 5, 1) == "-") & ~bare.startswith("0000")
    return F.when(four_digit_year, F.coalesce(text.try_cast("timestamp"), plain.try_cast("timestamp")))


def to_date(text: Column) -> Column:
    """ISO date text to DATE, null where it is none."""
    return F.when(is_iso_date(text) & text.rlike(r"^\d{4}-"), text.try_cast("date"))


def to_iso(time: Column) -> Column:
    """TIMESTAMP to RFC-3339 in UTC; like an instant's text, the fraction has 0, 3 or 6 digits."""
    micros = F.unix_micros(time) % 1000000
    return (
        F.when(micros == 0, F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(micros % 1000 == 0, F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )


def iso_if_time(field: T.StructField) -> Column:
    """The column as it is, or as RFC-3339 text if it is a TIMESTAMP."""
    column = F.col(field.name)
    return to_iso(column).alias(field.name) if isinstance(field.dataType, T.TimestampType) else column


def to_iso_millis(time: Column) -> Column:
    """TIMESTAMP to RFC-3339 in UTC with exactly three fraction digits."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
