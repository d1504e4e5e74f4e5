"""First, last, ordinal and version logic over rows, always with a stated order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudalix.operators.skew import salted_join
from caudalix.session import cut


def pick(df: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """The first row of each key in ``order`` (which must leave no ties), by an aggregate with map-side combine.

    Unlike a window, a hot key is reduced before it is shuffled. ``order`` may hold ascending expressions only; negate
    or reverse a value to ask for the last.
    """
    rest = [c for c in columns if c not in keys]
    by = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), by).alias("_r")).select(*keys, *[F.col(f"_r.{c}") for c in rest])


def pick_last(df: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """The last row of each key in ``order`` (nulls first), by an aggregate with map-side combine."""
    rest = [c for c in columns if c not in keys]
    by = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_r")).select(*keys, *[F.col(f"_r.{c}") for c in rest])


def ordinals(df: DataFrame, group: list[str], order: list[str], name: str = "ordem") -> DataFrame:
    """``df`` with each row's position (from 1) in its group, whatever share of the rows a group has.

    Rows are range-partitioned by group and order, so a hot group spreads over many tasks; each counts its own rows,
    and the counts of the tasks before it are added. ``group`` may be empty (positions over the whole table). The
    order must leave no ties.
    """
    # The ranges are sampled: they must be the same for both uses below.
    parts = cut(df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*group, "_part").orderBy(*order)
    numbered = parts.withColumn("_at", F.row_number().over(inside))
    on = [numbered[c].eqNullSafe(offsets[c]) for c in [*group, "_part"]]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    joined = numbered.join(offsets, condition).select(*[numbered[c] for c in df.columns], (F.col("_at") + F.col("_before")).alias(name))
    return joined


def zipped(left: DataFrame, right: DataFrame, order: str, same: list[str]) -> DataFrame:
    """Two sheets of one table put side by side by the place of their rows: the columns of ``left`` and the others of
    ``right``. ``order`` (unique on each side) is taken from the left. A row without a partner, or one whose ``same``
    columns differ, raises ValueError: the sheets are not of one table."""
    a, b = ordinals(left, [], [order], "_place"), ordinals(right, [], [order], "_place")
    more = [c for c in right.columns if c != order and c not in same]
    named = b.select("_place", F.lit(True).alias("_there"), *[F.col(c).alias(f"_r_{c}") for c in (*same, *more)])
    both = cut(a.withColumn("_here", F.lit(True)).join(named, "_place", "full"))
    apart = F.col("_here").isNull() | F.col("_there").isNull()
    for c in same:
        apart = apart | ~F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    if (n := both.where(apart).count()) > 0:
        raise ValueError(f"{n} rows of the two sheets do not belong together")
    return both.select(*left.columns, *[F.col(f"_r_{c}").alias(c) for c in more])


def versions(df: DataFrame, asset: str, start: Column, row_id: str) -> DataFrame:
    """``df`` with ``vigencia``: the version of an asset with the newest start is Atual, others Histórico.

    Undated versions come last, ties go to the lowest ``row_id``; a row without an asset stands alone and is Atual.
    """
    newest = pick(
        df.where(F.col(asset).isNotNull()).withColumn("_s", -F.coalesce(F.unix_date(start), F.lit(-(10**6)))),
        [asset],
        [F.col("_s"), F.col(row_id)],
        [asset, row_id],
    ).withColumnRenamed(row_id, "_newest")
    joined = salted_join(df, newest, [asset], row_id)
    alone = F.col(asset).isNull() | (F.col(row_id) == F.col("_newest"))
    return joined.withColumn("vigencia", F.when(alone, "Atual").otherwise("Histórico")).select(*df.columns, "vigencia")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def dependency_violations(df: DataFrame, key: str, dependent: str) -> DataFrame:
    """Keys that map to more than one value of ``dependent`` (null counts as a value): key, n_valores."""
    pairs = df.select(key, dependent).distinct()
    return pairs.groupBy(key).agg(F.count("*").alias("n_valores")).where("n_valores > 1")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows whose key is not in the new table, and all new rows; columns one side lacks are null."""
    kept = old.join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All old rows, and the new ones whose key is not there yet."""
    fresh = new.join(old.select(*keys).distinct(), keys, "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True)


def fill_cells(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """MERGE of single cells: a filled new value replaces the old one, keys only in ``new`` are added."""
    n = new.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = old.join(n, keys, "full")
    return joined.select(
        *keys, *[F.coalesce(F.nullif(F.col(f"_{c}"), F.lit("")), F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns if c not in keys]
    )
