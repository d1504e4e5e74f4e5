"""Dates written in several notations, without a per-row Python step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caudalix.functions.fold import fold, let

# Portuguese months, in order.
MONTHS = (
    "janeiro", "fevereiro", "marco", "abril", "maio", "junho",
    "julho", "agosto", "setembro", "outubro", "novembro", "dezembro",
)


def _made(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def parse_date(c: Column) -> Column:
    """The date ``c`` names: ``dd-mm-yyyy``, ``dd/mm/yyyy``, ``dd.mm.yyyy``, ``yyyy-mm-dd`` (also with a time after
    it), ``yyyy/mm/dd`` or ``d de <month> de yyyy``. Null, other text and impossible dates give null."""
    return let(fold(c), _parsed)


def _parsed(text: Column) -> Column:
    day_first = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?:[ t].*)?$"
    year_first = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[ t].*)?$"
    words = r"^(\d{1,2})(?:\.?o)? de ([a-z]{3,9})\.? de (\d{4})$"
    names = F.array(*[F.lit(m[:3]) for m in MONTHS])
    part = lambda pattern, i: F.regexp_extract(text, pattern, i)
    named_month = F.array_position(names, F.substring(part(words, 2), 1, 3)).cast("string")
    return (
        F.when(text.rlike(day_first), _made(part(day_first, 3), part(day_first, 2), part(day_first, 1)))
        .when(text.rlike(year_first), _made(part(year_first, 1), part(year_first, 2), part(year_first, 3)))
        .when(text.rlike(words), _made(part(words, 3), named_month, part(words, 1)))
    )


def iso_text(c: Column) -> Column:
    """``dd-mm-yyyy`` at the start as ``yyyy-mm-dd`` text without a calendar check, else empty text."""
    found = r"^\s*(\d{2})[-/](\d{2})[-/](\d{4})"
    return F.when(
        c.rlike(found),
        F.concat_ws("-", F.regexp_extract(c, found, 3), F.regexp_extract(c, found, 2), F.regexp_extract(c, found, 1)),
    ).otherwise("")


def order_number(c: Column) -> Column:
    """``dd-mm-yyyy`` as the integer yyyymmdd, anything else 0."""
    iso = iso_text(c)
    return F.coalesce(F.replace(iso, F.lit("-"), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))
