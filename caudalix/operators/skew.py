"""Joins whose big side may have one key in a third of its rows.

A frequent-items sketch finds the hot keys in one narrow pass, with map-side merging and a result of fixed size. Only
those keys are spread over tasks, each by its own share of the rows, so nothing is copied where no key is hot.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more rows than a task's share; beyond so many tasks the share shrinks no further, which
#: bounds the hot keys, too.
MOST_TASKS = 1_000


def task_count(df: DataFrame) -> int:
    """How many tasks a shuffle of ``df`` has, within bounds."""
    return min(MOST_TASKS, max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def hot_keys(df: DataFrame, on: list[str]) -> dict[int, int]:
    """Hash of each hot key of ``df`` and the number of tasks its rows fill (2 or more). Nulls are no keys."""
    tasks = task_count(df)
    keys = df.where(" and ".join(f"`{c}` is not null" for c in on)).select(F.xxhash64(*on).alias("h"))
    counted = keys.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h, {tasks}, {16 * tasks})").alias("top")).first()
    share = counted["n"] / tasks
    return {r["item"]: math.ceil(r["count"] / share) for r in counted["top"] or [] if r["count"] > share}


def hot_counted(counts: DataFrame, on: list[str], n: str) -> dict[int, int]:
    """``hot_keys`` of rows whose number by key is known: ``counts`` has each key once with its ``n``."""
    tasks = task_count(counts)
    total = counts.agg(F.sum(n).alias("n")).first()["n"] or 0
    # A key above a task's share is among the ``tasks`` largest.
    top = counts.where(F.col(n) > total / tasks).select(F.xxhash64(*on).alias("h"), n).orderBy(F.desc(n)).limit(tasks).collect()
    return {r["h"]: math.ceil(r[n] * tasks / total) for r in top}


def salted_join(big: DataFrame, other: DataFrame, on: list[str], spread: str, how: str = "left", hot: dict[int, int] | None = None) -> DataFrame:
    """``big`` joined to ``other`` (inner or left), the rows of hot keys of ``big`` spread over several tasks.

    A hot key's rows are told apart by the column ``spread`` of the big side, and the other side's rows of that key are
    copied once a part. Nulls in keys match nothing. Columns besides the keys must differ in name. ``hot`` saves the
    pass over the keys where the hot ones are known.
    """
    hot = hot_keys(big, on) if hot is None else hot
    if not hot:
        return big.join(other, on, how)
    key = F.xxhash64(*on)
    sizes = F.create_map(*[F.lit(x) for item in hot.items() for x in item])
    parts = F.when(key.isin(list(hot)), F.try_element_at(sizes, key)).otherwise(F.lit(1))
    a = big.withColumn("_salt", F.pmod(F.xxhash64(spread), parts).cast("int"))
    b = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    return a.join(b, [*on, "_salt"], how).drop("_salt")
