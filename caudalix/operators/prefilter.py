"""A filter in front of a join: rows whose key cannot be on the other side are dropped before they are shuffled.

The other side's keys set bits of a bitmap of fixed size, which is broadcast. A set bit proves nothing, so the join still
decides; with very many keys the filter lets all pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits: at most 262,144 rows of two numbers are broadcast, however many keys there are.
WORDS = 1 << 18


def _word(hashed: Column) -> Column:
    return F.pmod(F.shiftright(hashed, 6), F.lit(WORDS)).cast("int")


def _bit(hashed: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(hashed, F.lit(64)).cast("int"))


def bitmap(df: DataFrame, hashed: str) -> DataFrame:
    """The bitmap of the hashes (bigint) in a column: _word, _bits."""
    return df.groupBy(_word(F.col(hashed)).alias("_word")).agg(F.bit_or(_bit(F.col(hashed))).alias("_bits"))


def maybe_in(df: DataFrame, hashed: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose hash may be one of the bitmap ``keys``. Null hashes are dropped."""
    met = df.withColumn("_word", _word(F.col(hashed))).join(F.broadcast(keys), "_word")
    return met.where(F.col("_bits").bitwiseAND(_bit(F.col(hashed))) != 0).drop("_word", "_bits")
