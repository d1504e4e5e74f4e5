"""Aggregates under a filter context.

A measure is a named aggregate expression; a context is a filter and a set of grouping columns. Several measures over
one context are one grouped aggregate, so a report reads its table once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Measure = Callable[[Column], Column]


def evaluate(df: DataFrame, by: list[str], measures: dict[str, Column], keep: Column | None = None) -> DataFrame:
    """``measures`` per group of ``by`` (none: one row) over the rows of ``keep``."""
    rows = df if keep is None else df.where(keep)
    return rows.groupBy(*by).agg(*[e.alias(n) for n, e in measures.items()])


def date_measures(valid: Column, as_of: Column, months: int = 8) -> dict[str, Column]:
    """Counts and days around a date column, seen from ``as_of``: total, later than the window, before, inside, without
    date, shares, next date and days to it, mean days, inside twelve months."""
    limit = F.add_months(as_of, months)
    ahead = valid >= as_of
    later, before, inside = F.count_if(valid > limit), F.count_if(valid < as_of), F.count_if(valid.between(as_of, limit))
    total = F.count("*")
    share = lambda n: F.round(F.try_divide(F.lit(100.0) * n, total), 1)
    return {
        "total": total,
        "depois": later,
        "antes": before,
        "na_janela": inside,
        "sem_data": F.count_if(valid.isNull()),
        "pct_depois": share(later),
        "pct_antes": share(before),
        "pct_na_janela": share(inside),
        "proxima": F.min(F.when(ahead, valid)),
        "dias_ate_proxima": F.min(F.when(ahead, F.datediff(valid, as_of))).cast("bigint"),
        "dias_medios": F.round(F.avg(F.when(ahead, F.datediff(valid, as_of))), 2),
        "em_12_meses": F.count_if(valid.between(as_of, F.add_months(as_of, 12))),
    }


def distinct_with_blank(c: Column) -> Column:
    """Distinct values, blank counted as one."""
    return F.count_distinct(F.coalesce(c, F.lit("")))


def selected(c: Column, otherwise: str) -> Column:
    """The one value of the context (null is a value), else ``otherwise``."""
    packed = F.coalesce(c.cast("string"), F.lit("\u0000"))
    one = (F.min(packed) == F.max(packed)) & F.max(c.isNotNull().cast("int")).eqNullSafe(F.lit(1))
    return F.when(one, F.max(c.cast("string"))).otherwise(otherwise)


def only_value(c: Column) -> Column:
    """The one value of the context, null where there are several (null is a value) or none."""
    return F.when((F.count_distinct(c) == 1) & (F.count_if(c.isNull()) == 0), F.max(c))


def ladder(c: Column, steps: tuple[tuple[float, str], ...], otherwise: str) -> Column:
    """The name of the first step, in ascending order, that ``c`` does not exceed; null stays null."""
    found = F.lit(otherwise)
    for limit, name in sorted(steps, reverse=True):
        found = F.when(c <= limit, name).otherwise(found)
    return F.when(c.isNotNull(), found)


def share_without(df: DataFrame, by: list[str], removed: list[str], name: str = "percentagem") -> DataFrame:
    """Rows per group of ``by``, and their share of the rows of the context without the grouping ``removed``.

    The counts are aggregated first; the denominator is summed over the few groups, not over the rows.
    """
    counts = df.groupBy(*by).agg(F.count("*").alias("n"))
    rest = [c for c in by if c not in removed]
    totals = counts.groupBy(*rest).agg(F.sum("n").alias("_t")) if rest else counts.agg(F.sum("n").alias("_t"))
    joined = counts.join(totals, rest) if rest else counts.join(F.broadcast(totals))
    return joined.select(*by, "n", F.round(F.lit(100.0) * F.col("n") / F.col("_t"), 2).alias(name))


def restricted(df: DataFrame, column: str, values: DataFrame, other: str) -> DataFrame:
    """Rows whose ``column`` occurs in ``values.other``: a filter carried over from another table."""
    return df.join(values.select(F.col(other).alias(column)).distinct(), column, "left_semi")
