"""Continuous periods and gaps per entity, by dyadic blocks.

Each closed interval of days becomes the few canonical dyadic blocks that tile it (at most two a level). Blocks are
made distinct before they are gathered by entity, so an entity with any number of repeated or nested intervals
contributes at most as many blocks as the calendar has, and no hot entity overloads a task. Blocks covered by an
ancestor go, sibling pairs merge upward, and adjacent blocks coalesce, all over one ordering by (entity, first day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Days are counted from this many before 1970-01-01, so that every date Spark parses has a number of 0 or more.
_SHIFT = 719_528
#: 2**22 days reach beyond the year 9999.
_LEVELS = 22
#: Sibling pairs merge up to blocks of 2**16 days (179 years); larger neighbours are left to the coalescing.
_MERGED = 16


def _blocks(first: str, last: str):
    """Canonical dyadic blocks of [first, last]: at level k the blocks ceil(first/2^k) (if odd) and
    floor((last+1)/2^k)-1 (if even), as long as the remaining range is not empty."""

    def at(level: int) -> list:
        size = 1 << level
        low = F.floor((F.col(first) + (size - 1)) / size).cast("bigint")
        high = F.floor((F.col(last) + 1) / size).cast("bigint")
        left = F.when((low < high) & (low % 2 == 1), F.struct((low * size).alias("start"), F.lit(level).alias("level")))
        right = F.when(
            (low < high) & (high % 2 == 1), F.struct(((high - 1) * size).alias("start"), F.lit(level).alias("level"))
        )
        return [left, right]

    return F.array_compact(F.array(*[b for k in range(_LEVELS + 1) for b in at(k)]))


def blocks(df: DataFrame, entity: str, first: str, last: str) -> DataFrame:
    """The distinct dyadic blocks of each entity's intervals: entity, start (day number), level."""
    days = lambda c: (F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) + _SHIFT).cast("bigint")
    return (
        df.where(F.col(entity).isNotNull() & (F.col(first) <= F.col(last)))
        .select(F.col(entity).alias("entity"), days(first).alias("first"), days(last).alias("last"))
        .select("entity", F.explode(_blocks("first", "last")).alias("b"))
        .select("entity", "b.start", "b.level")
        .distinct()
    )


def periods(df: DataFrame, entity: str, first: str, last: str) -> DataFrame:
    """Continuous periods of each entity: entity, inicio, fim (dates), one row per period.

    Both days belong to an interval; one that begins the day after another ends continues it. Intervals with a null
    entity, a null date, or an end before their start are left out. An empty table gives no row.
    """
    size = lambda: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("level"))
    before = (
        Window.partitionBy("entity").orderBy("start", F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    )

    # Dyadic blocks nest or are disjoint: in this order an ancestor stands before every block it covers.
    kept = (
        blocks(df, entity, first, last)
        .withColumn("reached", F.max(F.col("start") + size()).over(before))
        .where(F.col("reached").isNull() | (F.col("start") >= F.col("reached")))
        .select("entity", "start", "level")
    )
    by_start = Window.partitionBy("entity").orderBy("start")
    # The first block's start never changes when it takes in its sibling, so the ordering holds at every level.
    for level in range(_MERGED):
        width = 1 << level
        here = F.col("level") == level
        even = (F.col("start") / width).cast("bigint") % 2 == 0
        next_start, next_level = F.lead("start").over(by_start), F.lead("level").over(by_start)
        last_start, last_level = F.lag("start").over(by_start), F.lag("level").over(by_start)
        takes = here & even & (next_level == level) & (next_start == F.col("start") + width)
        taken = here & ~even & (last_level == level) & (last_start == F.col("start") - width)
        kept = (
            kept.withColumn("takes", F.coalesce(takes, F.lit(False)))
            .withColumn("taken", F.coalesce(taken, F.lit(False)))
            .where(~F.col("taken"))
            .select("entity", "start", F.when(F.col("takes"), level + 1).otherwise(F.col("level")).alias("level"))
        )
    ends = kept.withColumn("end", F.col("start") + size())
    opens = F.coalesce(F.lag("end").over(by_start) < F.col("start"), F.lit(True))
    day = lambda c: F.date_add(F.lit("1970-01-01").cast("date"), (c - _SHIFT).cast("int"))
    return (
        ends.withColumn("opens", opens.cast("int"))
        .withColumn("island", F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("entity", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select(F.col("entity").alias(entity), day(F.col("start")).alias("inicio"), day(F.col("end") - 1).alias("fim"))
    )


def gaps(periods_: DataFrame, entity: str) -> DataFrame:
    """The gaps between the periods of each entity: entity, inicio, fim (both days lie in the gap)."""
    w = Window.partitionBy(entity).orderBy("inicio")
    return (
        periods_.withColumn("next", F.lead("inicio").over(w))
        .where(F.col("next").isNotNull())
        .select(entity, F.date_add("fim", 1).alias("inicio"), F.date_sub("next", 1).alias("fim"))
    )


def periods_and_gaps(df: DataFrame, entity: str, first: str, last: str) -> DataFrame:
    """Periods (tipo ``periodo``) and gaps (tipo ``lacuna``) of each entity in one pass, days as yyyy-mm-dd."""
    found = periods(df, entity, first, last)
    next_start = F.lead("inicio").over(Window.partitionBy(entity).orderBy("inicio"))
    both = F.array_compact(
        F.array(
            F.struct(F.lit("periodo").alias("tipo"), F.col("inicio").alias("a"), F.col("fim").alias("b")),
            F.when(
                F.col("next").isNotNull(),
                F.struct(
                    F.lit("lacuna").alias("tipo"), F.date_add("fim", 1).alias("a"), F.date_sub("next", 1).alias("b")
                ),
            ),
        )
    )
    text = lambda c: F.date_format(c, "yyyy-MM-dd")
    return (
        found.withColumn("next", next_start)
        .select(entity, F.explode(both).alias("x"))
        .select(entity, "x.tipo", text("x.a").alias("inicio"), text("x.b").alias("fim"))
    )
