"""Text rules shared by all jobs.

String equality ignores case and trailing blanks, so every comparison runs on
a key column made once with ``match_key``; joins on keys stay hash joins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def match_key(c: Column) -> Column:
    """Key under which two strings are equal regardless of case and trailing blanks."""
    return F.lower(F.rtrim(c))


def contact_key(c: Column) -> Column:
    """``match_key`` with blank text read as missing."""
    key = match_key(c)
    return F.when(F.length(key) > 0, key)


def phone_key(c: Column) -> Column:
    """Phone without brackets, blanks and dashes; blank text is missing."""
    return contact_key(F.translate(c, "() -", ""))


def address_line(street: Column, city: Column, state: Column, zip_code: Column) -> Column:
    """One address line: missing parts read as empty text, commas are dropped."""
    parts = [F.coalesce(c, F.lit("")) for c in (street, city, state, zip_code)]
    spaced = [p for part in parts for p in (F.lit(" "), part)][1:]
    return F.translate(F.concat(*spaced), ",", "")


def number_after_first_char(c: Column) -> Column:
    """Identifier without its first character as a number; null if it is none."""
    return F.substring(F.rtrim(c), 2, 2147483647).try_cast("bigint")


def number_without_p(c: Column) -> Column:
    """Identifier without any letter P as a number; null if it is none."""
    return F.translate(c, "Pp", "").try_cast("bigint")


def trimmed_length(c: Column) -> Column:
    return F.length(F.rtrim(c))


def date_of(year: Column, month: Column, day: Column) -> Column:
    """Date from its parts; null if a part is missing or the date does not exist."""
    zero = F.lit(0)
    stamp = F.try_make_timestamp_ntz(year, month, day, zero, zero, zero)
    return F.when(year.between(1, 9999), stamp.cast("date"))


def no_such_date(year: Column, month: Column, day: Column) -> Column:
    """True where all three parts are given but form no date."""
    given = year.isNotNull() & month.isNotNull() & day.isNotNull()
    return given & date_of(year, month, day).isNull()
