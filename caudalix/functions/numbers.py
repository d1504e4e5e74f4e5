"""Numbers written as text, limits, distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(c: Column) -> Column:
    """Decimal comma or point to double; anything else null."""
    return F.trim(F.replace(c, F.lit(","), F.lit("."))).try_cast("double")


def as_integer(c: Column) -> Column:
    """Rounded to the even neighbour at a half, as text; empty text where there is no number."""
    return F.coalesce(F.bround(number(c), 0).cast("bigint").cast("string"), F.lit(""))


def as_decimal(c: Column) -> Column:
    """At most six decimals without trailing zeros, with a comma; empty text where there is no number."""
    text = F.format_string("%.6f", number(c))
    short = F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")
    return F.when(number(c).isNotNull(), F.replace(short, F.lit("."), F.lit(","))).otherwise("")


def limit_bounds(c: Column) -> tuple[Column, Column]:
    """(min, max) of a limit text: a range gives both, a single figure an upper limit, no figure nulls."""
    text = F.replace(c, F.lit(","), F.lit("."))
    found = r"(-?\d+(?:\.\d+)?)\s*(?:a|-|–|ate|até)\s*(-?\d+(?:\.\d+)?)"
    single = F.regexp_extract(text, r"-?\d+(?:\.\d+)?", 0).try_cast("double")
    is_range = F.coalesce(text.rlike(found), F.lit(False))
    low = F.when(is_range, F.regexp_extract(text, found, 1).try_cast("double"))
    return low, F.when(is_range, F.regexp_extract(text, found, 2).try_cast("double")).otherwise(single)


def limit_texts(c: Column) -> tuple[Column, Column]:
    """The same without signs and as text: both figures where there are two and a dash or `` a ``, else the first as
    upper limit; empty text where there is none."""
    text = F.replace(F.coalesce(c, F.lit("")), F.lit(","), F.lit("."))
    all_ = F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?)"), 1)
    both = (F.size(all_) >= 2) & text.rlike("-| a ")
    none = F.size(all_) == 0
    return F.when(both, all_[0]).otherwise(""), F.when(none, "").when(both, F.get(all_, 1)).otherwise(F.get(all_, 0))


def clean_limit(c: Column) -> Column:
    """``6,0 a 9,0`` as ``6,0 - 9,0``; letters elsewhere stay."""
    text = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return F.regexp_replace(text, r"(?<=[\d,.])\s*a\s*(?=[\d,.])", " - ")


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance, earth radius 6371 km; null where a coordinate is null."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), 2)
    h = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    # least() passes over nulls, so the angle is only asked for where there is one.
    return F.when(h.isNotNull(), F.lit(12742.0) * F.asin(F.least(F.lit(1.0), F.sqrt(h))))
