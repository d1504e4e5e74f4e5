"""Projections over whole tables: column order, cleaning, completeness."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudalix.functions.placeholders import PLACEHOLDERS, filled, strip


def ordered(df: DataFrame, order: list[str]) -> DataFrame:
    """The columns of ``order`` that exist, in that order, then the others as they come."""
    known = [c for c in order if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known])


def inserted(df: DataFrame, after: str, new: dict[str, Column]) -> DataFrame:
    """``df`` with new columns behind ``after``, or at the end where that column is missing."""
    names = list(df.columns)
    at = names.index(after) + 1 if after in names else len(names)
    keep = [F.col(f"`{c}`") for c in names if c not in new]
    at -= sum(c in new for c in names[:at])
    return df.select(*keep[:at], *[e.alias(c) for c, e in new.items()], *keep[at:])


def without(df: DataFrame, pattern: str) -> DataFrame:
    """``df`` without the columns whose name matches ``pattern`` from its start."""
    return df.drop(*[c for c in df.columns if re.match(pattern, c)])


def placeholders_emptied(df: DataFrame) -> DataFrame:
    """Every text column with placeholders and nulls as empty text; other columns stay."""
    texts = {c for c, kind in df.dtypes if kind == "string"}
    clean = lambda c: F.when(strip(F.col(c)).isin(*PLACEHOLDERS) | F.col(c).isNull(), "").otherwise(F.col(c)).alias(c)
    return df.select(*[clean(c) if c in texts else F.col(c) for c in df.columns])


def union_widened(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns one side lacks are empty text (texts) or null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.fillna("", [c for c, kind in out.dtypes if kind == "string"])


def completeness(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """by, coluna, n, preenchidos, percentagem (one decimal), veredicto: how far each column is filled per group.

    One pass: every column is counted in the same aggregate, then the counts are turned to rows.
    """
    counts = [F.count_if(filled(F.col(c).cast("string"))).alias(f"n_{i}") for i, c in enumerate(columns)]
    wide = df.groupBy(by).agg(F.count("*").alias("n"), *counts)
    rows = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(f"n_{i}").alias("preenchidos")) for i, c in enumerate(columns)])
    share = F.round(F.lit(100.0) * F.col("preenchidos") / F.col("n"), 1)
    return (
        wide.select(by, "n", F.inline(rows))
        .withColumn("percentagem", share)
        .withColumn("veredicto", F.when(share >= 99, "completo").when(share >= 90, "quase").otherwise("com falhas"))
    )


def missing_list(columns: list[str]) -> tuple[Column, Column]:
    """(names of the columns a row lacks, joined by ``, ``; their number)."""
    names = F.array_compact(F.array(*[F.when(~filled(F.col(c).cast("string")), F.lit(c)) for c in columns]))
    return F.array_join(names, ", "), F.size(names).cast("bigint")


def _apart(names: list[str], keys: list[str]) -> list[str]:
    """Column names for ``names``: one that differs from a key or an earlier name in case only, which column names
    ignore, gets the next free number behind it."""
    same = lambda n: n.upper().casefold()
    given, taken, out = set(map(same, names)), set(map(same, keys)), []
    for n in names:
        new, i = n, 2
        while same(new) in taken or (new != n and same(new) in given):
            new, i = f"{n} ({i})", i + 1
        taken.add(same(new))
        out.append(new)
    return out


def pivot_in_order(df: DataFrame, keys: list[str], name: str, value: Column, first: tuple[str, ...], most: int = 5_000) -> DataFrame:
    """One row per key and one column per value of ``name``: those of ``first`` in their order, then all others in theirs.

    The values are counted before they become columns: more than ``most`` raise ValueError, as no table has so many.
    Cells without a row are null; rows whose ``name`` is null make no column. Values that differ in case only have a
    column each, the later ones with a number: ``Nt``, ``nt (2)``. Only the cells there are travel in a shuffle; a row
    is as wide as the table first where it is written.
    """
    found = [r[0] for r in df.select(name).where(F.col(name).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} values of {name} cannot be columns")
    names = [*first, *sorted(set(found) - set(first))]
    cells = df.groupBy(*keys, name).agg(value.alias("_cell"))
    packed = cells.groupBy(*keys).agg(F.collect_list(F.when(F.col(name).isNotNull(), F.struct(name, "_cell"))).alias("_cells"))
    by_name = packed.select(*keys, F.map_from_entries("_cells").alias("_by_name"))
    wide = zip(names, _apart([str(n) for n in names], keys))
    return by_name.select(*keys, *[F.col("_by_name")[n].alias(new) for n, new in wide])
