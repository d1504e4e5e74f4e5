"""Texts cut off by field limits or broken transfers.

A backward character n-gram model is trained on the column itself, per language and column: for the last characters of
every fragment position it counts how often the text ends there (end of the value, of a sentence, or before a bracket)
and how often it goes on. A value's final context is compared at the longest length with evidence, one occurrence of its
own left out; it counts as cut where going on is likelier by the threshold. A full stop is a character like others, so a
note that stops at an abbreviation is told from a whole one. Open brackets and cut marks are added as evidence of their
own.

Limit: counts are by row, so further copies of one cut text count as ends of it. Where they are many beside the rows
that go on there (from about a quarter of all copies of a sentence), all of them are called whole.

Counts cover all rows. Values are first reduced to distinct texts with figures as one digit, and these to distinct
sentences, so repeated text is counted once. Only contexts that some value ends in are asked for: all others are dropped
before anything is shuffled, and contexts travel as 64-bit hashes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudalix.functions.fold import plain
from caudalix.functions.placeholders import BLANKS, filled
from caudalix.operators.prefilter import bitmap, maybe_in
from caudalix.operators.skew import hot_counted, salted_join
from caudalix.session import cut

#: Lengths of the contexts, in characters; the longest with evidence decides.
ORDERS = (3, 4, 5, 6, 8, 10, 12, 16, 20, 28)
# Marks that stand where a text was cut.
_MARK = r"(?:\s*(?:\.\.\.|…|\(\.\.\.\)|\(…\)|\[\.\.\.\]|\[…\]|>>|�+))+$"
#: How every marked text ends; only those are searched for the mark.
_MARK_ENDS = ("...", "…", "...)", "…)", "...]", "…]", ">>", "\ufffd")
_START = "\u0002"


@dataclass(frozen=True)
class Field:
    """A column and what may follow a complete text inside it, as a pattern at the next character."""

    name: str
    boundary: str
    sentences: bool
    #: Log-odds above which a value counts as cut; by column, and by language where ``thresholds`` names it.
    threshold: float = 1.0
    thresholds: tuple[tuple[str, float], ...] = ()


#: A parameter's name is complete in front of a bracket, dash, comma, star or full stop, its unit at the bracket's end
#: or in front of a substance (a bracket left open counts by itself); a note is complete at its sentence's end.
PARAMETER = r"\s*[(\[*,.;:)\]]|[A-Z]?\d[)\]]|\s+-\s|\s[A-Z][A-Za-z0-9]{0,3}(?:[)\]]|$)"
SENTENCE = r"[.!?](?:\s+[^\p{Ll}\d\s]|$)"
# Where sentences are set apart: a stop in front of a small letter or a figure may belong to an abbreviation.
_BETWEEN = r"(?<=[.!?])\s+(?=[^\p{Ll}\d\s])"


def _may_be_marked(c: Column) -> Column:
    end = F.rtrim(c)
    return reduce(or_, [end.endswith(x) for x in _MARK_ENDS])


def _stripped(c: Column) -> Column:
    return F.rtrim(F.when(_may_be_marked(c), F.regexp_replace(c, _MARK, "")).otherwise(c), F.lit(BLANKS))


def _open_bracket(c: Column) -> Column:
    opened = F.regexp_count(c, F.lit(r"[(\[]"))
    return (opened > F.regexp_count(c, F.lit(r"[)\]]"))) | c.rlike(r"[(\[][^)\]]*$")


def _cells(df: DataFrame, row_id: str, fields: tuple[Field, ...], lang: Column | None, source: str | None) -> DataFrame:
    """One row per filled cell: id, lang, source, campo, value."""
    each = F.array(*[F.struct(F.lit(f.name).alias("campo"), F.col(f.name).alias("value")) for f in fields])
    kept = [
        F.col(row_id).alias("id"),
        (F.lit("pt") if lang is None else lang).alias("lang"),
        (F.col(source) if source else F.lit(None).cast("string")).alias("source"),
    ]
    return df.select(*kept, F.inline(each)).where(filled(F.col("value")))


def _texts(cells: DataFrame) -> DataFrame:
    """``cells`` with text (the value in plain characters, without cut mark, figures as one digit), marked, and key (a
    hash of what a verdict depends on)."""
    # Few values have a character beyond Latin-1; only those are mapped to plain ones.
    value = F.col("value")
    mapped = F.when(value.rlike(r"[^\x00-\xff]|[\xa0\xad]"), plain(value)).otherwise(value)
    # Rows of one array, so that each step is worked out once and not copied to every use of what it gives.
    read = cells.withColumn("plain", F.explode(F.array(mapped)))
    read = read.withColumn("text", F.explode(F.array(F.regexp_replace(_stripped(F.col("plain")), r"\d+", "0")))).drop("plain")
    return read.where("text <> ''").withColumn("marked", _may_be_marked(value) & value.rlike(_MARK)).withColumn("key", F.xxhash64("lang", "campo", "text", "marked"))


def kinds_of(cells: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """key, lang, campo, text, marked, n (rows), pieces (its fragments, from a start mark on), final (hash of the last
    one) of every distinct text, written once, as the model and the verdicts both start from it."""
    sentences = F.col("campo").isin([f.name for f in fields if f.sentences])
    pieces = F.transform(F.when(sentences, F.split("text", _BETWEEN)).otherwise(F.array("text")), lambda x: F.concat(F.lit(_START), x))
    counted = _texts(cells).groupBy("key", "lang", "campo", "text", "marked").agg(F.count("*").alias("n")).withColumn("pieces", pieces)
    return cut(counted.withColumn("final", F.xxhash64("lang", "campo", F.element_at("pieces", -1))))


def _contexts(head: str, orders: tuple[int, ...]) -> Column:
    """array<struct<k, c>> of the ends of ``head``, c as a hash: one of each length, and short heads as a whole."""
    hashed = lambda text: F.xxhash64("lang", "campo", text)
    ends = [F.when(F.length(head) >= k, F.struct(F.lit(k).alias("k"), hashed(F.expr(f"right({head}, {k})")).alias("c"))) for k in orders]
    whole = F.when(F.length(head) <= max(orders), F.struct(F.lit(1000).alias("k"), hashed(F.concat(F.lit(_START), F.col(head))).alias("c")))
    return F.array_compact(F.array(*ends, whole))


def asked_contexts(kinds: DataFrame, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """final, k, c: the contexts that the distinct last fragments end in."""
    finals = kinds.groupBy("final", "lang", "campo").agg(F.first(F.element_at("pieces", -1)).alias("head"))
    return finals.select("final", F.explode(_contexts("head", orders)).alias("x")).select("final", "x.k", "x.c")


def train(kinds: DataFrame, asked: DataFrame, fields: tuple[Field, ...], orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """The model: k, c -> ends, goes_on (row-weighted counts over all values) of the contexts asked for."""
    rest = F.expr("substring(t, at + 1)")
    ends_here = F.lit(False)
    for f in fields:
        ends_here = F.when(F.col("campo") == f.name, rest.rlike(f"^(?:{f.boundary})")).otherwise(ends_here)
    fragments = kinds.select("lang", "campo", "n", F.explode("pieces").alias("t")).groupBy("lang", "campo", "t").agg(F.sum("n").alias("n"))
    # Short as they are, the fragments grow to a row per character and order: spread them before that.
    fragments = fragments.repartition(_tasks(kinds))
    at = fragments.select("lang", "campo", "t", "n", F.explode(F.sequence(F.lit(2), F.length("t"))).alias("at"))
    at = at.select("lang", "campo", "n", F.expr("substring(t, 1, at)").alias("head"), ((rest == "") | ends_here).alias("end"))
    met = maybe_in(at.select("n", "end", F.explode(_contexts("head", orders)).alias("x")).select("n", "end", "x.k", "x.c"), "c", bitmap(asked, "c"))
    ends = F.sum(F.when(F.col("end"), F.col("n")).otherwise(0))
    return met.groupBy("k", "c").agg(ends.alias("ends"), F.sum(F.when(F.col("end"), 0).otherwise(F.col("n"))).alias("goes_on"))


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def verdicts(kinds: DataFrame, fields: tuple[Field, ...], complete: list[str] | None = None, orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """key, lang, campo, text, marked, log_odds, cut for every distinct text."""
    asked = asked_contexts(kinds, orders)
    # One end of the value's own is left out of its evidence; those of its copies are not.
    seen = asked.join(train(kinds, asked, fields, orders), ["k", "c"]).withColumn("ends", F.col("ends") - 1).where("ends + goes_on > 0")
    best = seen.groupBy("final").agg(F.max_by(F.struct("ends", "goes_on"), "k").alias("m"))
    odds = best.select("final", F.log((F.col("m.goes_on") + 0.5) / (F.col("m.ends") + 0.5)).alias("odds"))
    known = F.lower("text").isin(sorted({re.sub(r"\d+", "0", c) for c in complete})) if complete else F.lit(False)
    evidence = F.coalesce(F.col("odds"), F.lit(0.0)) + F.when(_open_bracket(F.col("text")), 20.0).otherwise(0.0) + F.when(F.col("marked"), 10.0).otherwise(0.0)
    log_odds = F.when(known & ~F.col("marked"), -20.0).otherwise(evidence)
    threshold = F.lit(0.0)
    for f in fields:
        limit = F.lit(f.threshold)
        for language, own in f.thresholds:
            limit = F.when(F.col("lang") == language, own).otherwise(limit)
        threshold = F.when(F.col("campo") == f.name, limit).otherwise(threshold)
    judged = salted_join(kinds.drop("pieces", "n"), odds, ["final"], "key").withColumn("log_odds", log_odds)
    return judged.select("key", "lang", "campo", "text", "marked", "log_odds", (F.col("log_odds") > threshold).alias("cut"))


def judge(
    df: DataFrame,
    row_id: str,
    fields: tuple[Field, ...],
    source: str | None = None,
    lang: Column | None = None,
    complete: list[str] | None = None,
    only_cut: bool = False,
    orders: tuple[int, ...] = ORDERS,
) -> DataFrame:
    """Every filled value with its log-odds of being cut: row_id, campo, source, lang, value, log_odds, cut.

    ``complete`` holds texts known to be whole (lower case, figures may differ), which are never cut; ``only_cut`` gives
    the rows of cut values alone. Nulls, empty texts and placeholders give no row; repeated rows count each for
    themselves. Without rows there is no model and no result. A context never seen elsewhere, at any length, gives
    log-odds of 0 and no cut, unless a bracket is open or a mark stands after the text.
    """
    cells = _cells(df, row_id, fields, lang, source)
    kinds = kinds_of(cells, fields)
    found = verdicts(kinds, fields, complete, orders)
    rows = _texts(cells)
    if only_cut:
        found = found.where("cut")
        rows = maybe_in(rows, "key", bitmap(found, "key"))
    on = ["key", "lang", "campo", "text", "marked"]
    return salted_join(rows, found, on, "id", "inner", hot_counted(kinds, on, "n")).select(
        F.col("id").alias(row_id), "campo", "source", "lang", "value", "log_odds", "cut"
    )
