"""Lookup joins: many to one, by period with fallback, by containment, by words, by name and then distance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudalix.functions.numbers import distance_km
from caudalix.operators.records import pick
from caudalix.operators.skew import salted_join


def many_to_one(left: DataFrame, right: DataFrame, on: list[str], order: list[str], columns: list[str], row_id: str) -> DataFrame:
    """Left join after the right side is made unique by key (first in ``order`` wins); misses are null. Hot keys of the
    left side are spread by ``row_id``."""
    unique = pick(right, on, [F.col(c) for c in order], [*on, *columns])
    return salted_join(left, unique, on, row_id)


def with_fallback(left: DataFrame, right: DataFrame, on: list[str], period: str, default: str, columns: list[str]) -> DataFrame:
    """``columns`` of the right row of the same key and period, all from the ``default`` period's row where there is
    none. The right side must be unique by key and period; its few periods of a key are one map, so one join does."""
    by_period = F.map_from_entries(F.collect_list(F.struct(F.col(period).alias("k"), F.struct(*columns).alias("v"))))
    periods = right.where(F.col(period).isNotNull()).groupBy(*on).agg(by_period.alias("_periods"))
    joined = left.join(periods, on, "left")
    chosen = F.coalesce(F.try_element_at("_periods", F.col(period)), F.try_element_at("_periods", F.lit(default)))
    return joined.withColumn("_chosen", chosen).select(*left.columns, *[F.col(f"_chosen.{c}").alias(c) for c in columns])


def _pieces(df: DataFrame, key: str, least: int) -> DataFrame:
    """key and each different run of ``least`` characters of it."""
    at = F.sequence(F.lit(1), F.length(key) - least + 1)
    return df.select(key, F.explode(F.array_distinct(F.transform(at, lambda i: F.substring(F.col(key), i, F.lit(least))))).alias("_g"))


def _held(holders: DataFrame, key: str, held: DataFrame, other: str, least: int) -> DataFrame:
    """Pairs of which ``key`` contains ``other``: they meet on the piece of ``other`` that fewest holders have."""
    places = _pieces(holders, key, least)
    common = places.groupBy("_g").agg(F.count("*").alias("_n"))
    rarest = _pieces(held, other, least).join(common, "_g", "left").groupBy(other).agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_g")).alias("_r"))
    # A piece that no holder has rules its key out.
    asked = rarest.where("_r.n > 0").select(other, F.col("_r._g").alias("_g"))
    return places.join(asked, "_g").where(F.col(key).contains(F.col(other))).select(key, other)


def containing(left: DataFrame, key: str, right: DataFrame, other: str, least: int = 5) -> DataFrame:
    """Pairs of distinct keys of which one contains the other, both of ``least`` characters or more: (key, other).

    The holder has every piece of ``least`` characters of the held key, so the two meet on the rarest of them, both
    ways, and are then checked: no pair is missed, and a piece that many keys share ("santa") brings none together.
    """
    a = left.select(key).where(F.length(key) >= least).distinct()
    b = right.select(other).where(F.length(other) >= least).distinct()
    return _held(a, key, b, other, least).union(_held(b, other, a, key, least).select(key, other)).distinct()


def by_words(left: DataFrame, right: DataFrame, param: str, words: str, value: str) -> DataFrame:
    """For each distinct (param, words) of the left: the distinct values of right rows with the same param that share
    a word, of all rows with the same param where none does; joined by ``; `` in order. No param match gives
    ``not found``. The right side is a catalogue; words are arrays.

    Rows meet on a shared word, and the list of all values is made once a param, so a param with many rows on both
    sides brings no two of them together in vain.
    """
    asked = left.select(param, words).distinct()
    offered = right.select(param, F.col(words).alias("_w"), value).distinct()
    by_word = offered.select(param, F.explode("_w").alias("_g"), value).distinct()
    shared = asked.select(param, words, F.explode(F.array_distinct(words)).alias("_g")).join(by_word, [param, "_g"])
    overlap = shared.groupBy(param, words).agg(F.array_join(F.sort_array(F.collect_set(value)), "; ").alias("_overlap"))
    every = offered.groupBy(param).agg(F.array_join(F.sort_array(F.collect_set(value)), "; ").alias("_all"))
    missed = asked.join(overlap, [param, words], "left_anti").join(every, param, "left").select(param, words, F.coalesce("_all", F.lit("not found")).alias(value))
    return overlap.select(param, words, F.col("_overlap").alias(value)).unionByName(missed)


def inherited(left: DataFrame, rules: DataFrame, param: str, text: str, note: str, value: str, least: int = 40) -> DataFrame:
    """The value of the rule for each distinct (param, text): same note first, else the longest note of ``least``
    characters or more of which one contains the other; null where no rule fits. Notes must be unique by param.

    Containment is joined on the rarest piece of ``least`` characters, as in ``containing``.
    """
    a = left.select(param, text).where(F.col(text) != "").distinct()
    exact = a.join(rules.select(param, F.col(note).alias(text), F.col(value).alias("_v"), F.col(note).alias("_n")), [param, text])
    long_rules = rules.where(F.length(note) >= least)
    pairs = containing(a, text, long_rules, note, least)
    near = a.join(pairs, text).join(long_rules.select(param, note, F.col(value).alias("_v")), [param, note]).select(param, text, "_v", F.col(note).alias("_n"))
    both = exact.select(param, text, "_v", "_n", F.lit(0).alias("_rank")).unionByName(near.withColumn("_rank", F.lit(1)))
    best = both.groupBy(param, text).agg(F.min(F.struct("_rank", -F.length("_n"), "_n", "_v")).alias("_b"))
    return a.join(best.select(param, text, F.col("_b._v").alias(value)), [param, text], "left")


def nearest(left: DataFrame, right: DataFrame, left_id: str, right_id: str, most_km: float = 2.0) -> DataFrame:
    """The nearest right row within ``most_km``: left_id, right_id, km. Both sides have lat and lon (doubles).

    Rows meet in the cells of a grid wide enough for ``most_km`` up to 60 degrees of latitude, the right side copied to
    the neighbouring cells, so every pair within reach is seen and no other one is compared. Ties go to the lower id.
    The rows of a crowded cell are spread over tasks.
    """
    high, wide = most_km / 111.0, most_km / 55.5
    row = lambda c: F.floor(F.col(c) / high)
    col = lambda c: F.floor(F.col(c) / wide)
    a = left.where("lat is not null and lon is not null").select(left_id, F.col("lat").alias("_la"), F.col("lon").alias("_lo"), row("lat").alias("_r"), col("lon").alias("_c"))
    near = F.array(*[F.struct((row("lat") + i).alias("_r"), (col("lon") + j).alias("_c")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    b = right.where("lat is not null and lon is not null").select(right_id, F.col("lat").alias("_lb"), F.col("lon").alias("_lob"), F.inline(near))
    pairs = salted_join(a, b, ["_r", "_c"], left_id, "inner").withColumn("km", distance_km(F.col("_la"), F.col("_lo"), F.col("_lb"), F.col("_lob")))
    best = pairs.where(F.col("km") <= most_km).groupBy(left_id).agg(F.min(F.struct("km", right_id)).alias("_b"))
    return best.select(left_id, F.col(f"_b.{right_id}"), F.col("_b.km"))


def name_then_nearest(left: DataFrame, right: DataFrame, left_id: str, right_id: str, most_km: float = 2.0) -> DataFrame:
    """left_id, right_id, metodo: by equal ``name_key`` (of several the nearest, then the lowest id), what is left by
    distance. A right row called superseded (``old``) gives way to the current one of the same ``base``.

    left: left_id, name_key, lat, lon. right: right_id, name_key, lat, lon, old, base.
    """
    a = left.select(left_id, "name_key", F.col("lat").alias("_la"), F.col("lon").alias("_lo"))
    b = right.where("name_key <> ''").select(right_id, "name_key", F.col("lat").alias("_lb"), F.col("lon").alias("_lob"))
    km = F.coalesce(distance_km(F.col("_la"), F.col("_lo"), F.col("_lb"), F.col("_lob")), F.lit(9e9))
    named = salted_join(a, b, ["name_key"], left_id, "inner").groupBy(left_id).agg(F.min(F.struct(km.alias("km"), F.col(right_id).alias("r"))).alias("b"))
    by_name = named.select(left_id, F.col("b.r").alias(right_id), F.lit("name").alias("metodo"))
    rest = left.join(by_name.select(left_id), left_id, "left_anti")
    by_place = nearest(rest, right, left_id, right_id, most_km).select(left_id, right_id, F.lit("coord").alias("metodo"))
    current = pick(right.where("not old"), ["base"], [F.col(right_id)], ["base", right_id]).select("base", F.col(right_id).alias("_current"))
    moved = right.where("old").join(current, "base").select(right_id, "_current")
    found = by_name.unionByName(by_place).join(moved, right_id, "left")
    return found.select(left_id, F.coalesce("_current", right_id).alias(right_id), "metodo")


def keyword_list(df: DataFrame, column: str, header: str = "") -> DataFrame:
    """palavra: the distinct filled texts of one column of a scanned sheet, trimmed, without the header's word."""
    word = F.trim(column)
    return df.select(word.alias("palavra")).where((F.col("palavra") != "") & (F.lower("palavra") != header.lower())).distinct()


def forward_filled(df: DataFrame, group: str, order: str, column: str, name: str) -> DataFrame:
    """``column``'s last value that is not null at or before each row of its group (a document's lines)."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(column, ignorenulls=True).over(w))
