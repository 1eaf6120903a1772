"""Small column helpers for values that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parts(value: str | Column, separator: str) -> Column:
    """Split at a pattern without empty parts."""
    return F.filter(F.split(_column(value), separator), lambda x: x != "")


def lenient_bool(value: str | Column) -> Column:
    """True or false; text that is neither, such as "None", is false."""
    text = F.lower(_column(value))
    return F.coalesce(text == "true", F.lit(False))


def whole(value: str | Column) -> Column:
    """The whole part of a number written as text, such as "1445416821000.0"; null for other text, such as "None".

    The digits before the point are read as they are, so numbers above 2**53 keep their value. Only exponents go through
    a floating-point number.
    """
    text = F.trim(_column(value))
    digits = F.regexp_extract(text, r"^([+-]?[0-9]+)(\.[0-9]*)?$", 1)
    return F.coalesce(digits.try_cast("long"), F.when(digits == "", text.try_cast("double").try_cast("long")))


def api_date_ms(value: str | Column) -> Column:
    """Epoch milliseconds of ``Wed Oct 21 08:40:21 +0000 2015``. The weekday says nothing new and is cut off."""
    return F.unix_millis(F.to_timestamp(F.substr(_column(value), F.lit(5)), "MMM dd HH:mm:ss Z yyyy"))


def from_hex(value: str | Column) -> Column:
    """The number of hexadecimal digits, with or without 0x in front."""
    return F.conv(F.regexp_replace(_column(value), "^0[xX]", ""), 16, 10).cast("long")


def to_hex(value: str | Column) -> Column:
    return F.lower(F.hex(_column(value)))


def drop_last(value: str | Column, n: int = 1) -> Column:
    text = _column(value)
    return F.left(text, F.length(text) - n)


def ring_slot(slot: str | Column, slots: int) -> Column:
    """The slot after this one on a ring."""
    return F.pmod(_column(slot) + 1, F.lit(slots))


def days_before(value_ms: str | Column, days: int) -> Column:
    return _column(value_ms) - F.lit(86_400_000 * days)
