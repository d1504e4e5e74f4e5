"""What counts as "no value" in the source texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that say "empty". '0' is a value.
PLACEHOLDERS = ("", "-", "n/a", "N/A", "s/d", "...", "(vazio)", "(vide)", "None")

#: Characters trimmed around a value: every blank of Unicode, also no-break ones.
BLANKS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """``c`` without blanks of any kind at both ends; null stays null."""
    return F.trim(c, F.lit(BLANKS))


def filled(c: Column) -> Column:
    """True where ``c`` holds a value, never null."""
    return F.coalesce(~strip(c).isin(*PLACEHOLDERS), F.lit(False))


def value(c: Column) -> Column:
    """``c`` where it holds a value, else null."""
    return F.when(filled(c), c)
