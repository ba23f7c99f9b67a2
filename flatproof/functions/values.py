"""Number, flag and date expressions. Everything is ``try_*``: bad text gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import NOT_DATE_CHAR, keep

MONEY = "decimal(18,2)"

TRUE_WORDS = ("TRUE", "T", "YES", "1")
FALSE_WORDS = ("NO", "FALSE", "F", "0")

# Accepted date shapes. A value fits at most one shape, which picks the one pattern
# to parse it with: a value is parsed once, bad text costs no exceptions, and the common shapes
# come first.
DATE_FORMATS = (
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"(?i)^\d{2}-[a-z]{3}-\d{4}$", "dd-MMM-yyyy"),
    (r"^\d{8} \d{2}:\d{2}:\d{2}$", "yyyyMMdd HH:mm:ss"),
    (r"^\d{8} \d{6}$", "yyyyMMdd HHmmss"),
    (r"(?i)^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2} [ap]m$", "M/d/yyyy h:mm a"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"),
    (r"(?i)^\d{2}-[a-z]{3}-\d{4} \d{2}:\d{2}:\d{2} [ap]m$", "dd-MMM-yyyy hh:mm:ss a"),
    (r"(?i)^\d{2}-[a-z]{3}-\d{2} \d{2}:\d{2}:\d{2} [ap]m$", "dd-MMM-yy hh:mm:ss a"),
    (r"(?i)^\d{1,2}-\d{1,2}-\d{4} \d{2}:\d{2}:\d{2} [ap]m$", "d-M-yyyy hh:mm:ss a"),
)

ISO_DATE, ISO_DATETIME = "yyyyMMdd", "yyyyMMdd HHmmss"
US_DATE, US_DATETIME = "MM/dd/yyyy", "MM/dd/yyyy hh:mm a"


def strip_number(c: Column) -> Column:
    return F.translate(c, ", ", "")


# The shape of a whole number. Testing it is cheap; a cast that fails is not.
WHOLE = "^[+-]?[0-9]{1,19}$"


def to_int(c: Column) -> Column:
    return F.when(F.trim(c).rlike(WHOLE), F.trim(c).try_cast("bigint"))


def to_money(c: Column) -> Column:
    return F.trim(c).try_cast(MONEY)


def money_or_zero(c: Column) -> Column:
    return F.coalesce(to_money(strip_number(c)), F.lit(0).cast(MONEY))


def to_flag(c: Column) -> Column:
    """TRUE/T/YES/1 and NO/FALSE/F/0 as a boolean, anything else NULL."""
    word = F.upper(F.trim(c))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def to_bool(c: Column) -> Column:
    """As :func:`to_flag`, with everything else false."""
    return F.coalesce(to_flag(c), F.lit(False))


def to_timestamp(c: Column) -> Column:
    """The timestamp by the shape that fits, or NULL."""
    out = None
    for shape, pattern in DATE_FORMATS:
        test, value = c.rlike(shape), F.try_to_timestamp(c, F.lit(pattern))
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def to_date(c: Column) -> Column:
    return to_timestamp(c).cast("date")


def iso_date(c: Column) -> Column:
    return F.date_format(c, ISO_DATE)


def us_date(c: Column) -> Column:
    return F.date_format(c, US_DATE)
