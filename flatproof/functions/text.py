"""Text cleaners as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that each cleaner drops.
NOT_DIGIT = r"[^0-9]"
NOT_ALNUM_OR_SPACE = r"[^a-zA-Z0-9\s]"
NOT_ALNUM_OR_DASH = r"[^a-zA-Z0-9\-]"
NOT_ALPHA = r"[^a-zA-Z]"
NOT_ALPHA_OR_DASH = r"[^a-zA-Z\-]"
NOT_DIGIT_OR_DASH = r"[^0-9\-]"
NOT_DATE_CHAR = r"[^a-zA-Z0-9\s:\-/]"

# Characters of the two sides of an address.
EMAIL_CHARS = r"^[A-Za-z0-9!#$%&'*+/=?^_`{|}~.\-]+@[A-Za-z0-9.\-]+\z"
# A label is not empty: no dot at an end of a side, and no two in a row.
EMAIL_EMPTY_LABEL = r"^\.|\.\.|\.@|@\.|\.\z"


def text(c: Column | str) -> Column:
    """The value as text with NULL read as blank."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def is_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def keep(c: Column, dropped: str) -> Column:
    return F.regexp_replace(c, dropped, "")


def digits(c: Column) -> Column:
    return keep(c, NOT_DIGIT)


def zip_code(c: Column, max_len: int) -> Column:
    return F.left(digits(c), F.lit(max_len))


def phone(c: Column, max_len: int) -> Column:
    return F.right(digits(c), F.lit(max_len))


def pad_left(c: Column, width: int, fill: str = "0") -> Column:
    """Left pad short values; ``lpad`` alone would cut long ones."""
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def ssn_clean(c: Column, width: int) -> Column:
    return pad_left(keep(c, NOT_ALNUM_OR_SPACE), width)


def ssn_digits(c: Column) -> Column:
    return digits(F.trim(text(c)))


def ssn_dashed(c: Column) -> Column:
    d = pad_left(ssn_digits(c), 9)
    dashed = F.concat_ws("-", F.left(d, F.lit(3)), F.substring(d, 4, 2), F.right(d, F.lit(4)))
    return F.when(is_blank(c), "").otherwise(dashed)


def mid(c: Column, start: int, length: int | None = None) -> Column:
    """Characters from ``start`` (1 = first)."""
    return F.substring(c, start, 2**31 - 1 if length is None else length)


def csv_quote(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def csv_quote_if_needed(c: Column) -> Column:
    return F.when(c.contains(",") | c.contains('"'), csv_quote(c)).otherwise(c)


def match_key(c: Column) -> Column:
    """Key for matching names: upper case, trimmed, letters and digits only."""
    return keep(F.upper(F.trim(text(c))), r"[^A-Z0-9]")


def display_name(c: Column) -> Column:
    """Upper case, trimmed and without ampersands."""
    return F.replace(F.trim(F.upper(c)), F.lit("&"), F.lit(""))


def file_name_clean(c: Column) -> Column:
    """A file name without separators and characters that downstream systems refuse."""
    for old, new in (
        # Replacements in the order they apply.
        ("--", "_"), ("-", "_"), ("  ", ""), (" ", "_"), ("__", "_"), ("'", ""), (",", ""), ('"', ""),
        ("//", ""), ("[", ""), ("]", ""),
    ):
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.trim(c)
