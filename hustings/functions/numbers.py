"""Numeric expressions."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"

_DIGITS = [chr(i) for i in range(128, sys.maxunicode + 1) if unicodedata.category(chr(i)) == "Nd"]
OTHER_DIGITS = "".join(_DIGITS)
PLAIN_DIGITS = "".join(str(unicodedata.digit(d)) for d in _DIGITS)


def number_or_zero(c: Column) -> Column:
    """Text to a double; anything that is not a plain number, null and NaN included, is 0."""
    text = c.cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double")).otherwise(F.lit(0.0))


def money(c: Column) -> Column:
    """Declared amount as a number: all digits before the first ``~``, joined.

    Null, blank, ``Nil`` and texts without digits are 0.  Units and decimal points are not interpreted, so
    ``Rs 1 Crore 20 Lacs`` is 120 and ``Rs 10.50`` is 1050.
    """
    head = F.split_part(c, F.lit("~"), F.lit(1))
    digits = F.regexp_replace(F.translate(head, OTHER_DIGITS, PLAIN_DIGITS), "[^0-9]", "")
    known = c.isNotNull() & ~F.contains(c, F.lit("Nil")) & (digits != "")
    return F.when(known, digits.cast("double")).otherwise(F.lit(0.0))


def percent(c: Column) -> Column:
    return F.format_string("%.2f%%", c.cast("double") * 100)


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the row's key and the seed, the same in every run and layout."""
    word = F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 8)
    return F.conv(word, 16, 10).cast("double") / F.lit(4294967296.0)


def ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))
