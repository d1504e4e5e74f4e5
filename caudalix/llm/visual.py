"""Texts that look alike but differ in their characters.

One form for all: compatibility-normalised and composed, look-alike letters and odd blanks and hyphens mapped to the
plain ones, default-ignorable characters removed, case folded. It is worked out once per distinct value of a batch, so
repeated values cost nothing and nothing is shuffled.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudalix.functions.placeholders import filled
from caudalix.functions.pytext import per_distinct, plain_text

# Signs whose compatibility form differs but which are usual where they stand.
SIGNS = set("ºª²³¹µ°…½¼¾™´¨¸¯ ")
#: Alpha and beta are usual in front of, or after, a substance's name, set off by a hyphen or blank.
_BETA_IN_WORD = re.compile(r"(?<=[A-Za-zÀ-ÿ])β|β(?=[A-Za-zÀ-ÿ])")
_ORDINAL_IN_WORD = re.compile(r"(?<=[a-zà-ÿ]{2})[ºª](?=[a-zà-ÿ])|(?<=[^\W\d_])[ºª](?=[a-zà-ÿ]{2})")
_DASH_IN_WORD = re.compile(r"(?<=[^\W\d_])[–—](?=[^\W\d_])")


def usual(s: str) -> str:
    """``s`` as it is usually written: compatibility-normalised, composed, and in plain letters, hyphens and blanks,
    without invisible characters; signs in their usual place, case and the number of blanks stay."""
    s = _DASH_IN_WORD.sub("-", _BETA_IN_WORD.sub("ß", plain_text(s)))
    s = _ORDINAL_IN_WORD.sub(lambda m: "o" if m[0] == "º" else "a", s)
    if not s.isascii():
        s = "".join(c if c in SIGNS or ord(c) < 0x100 else unicodedata.normalize("NFKC", c) for c in s)
    return unicodedata.normalize("NFC", s)


def is_disguised(s: str) -> bool:
    """Whether ``s`` has a character or sequence that a reader takes for the usual spelling but that is not it."""
    return usual(s) != s


def one_form(s: str) -> str:
    """The form in which equal-looking texts are equal: the usual one without signs, case and repeated blanks."""
    s = unicodedata.normalize("NFKC", usual(s)).casefold()
    return " ".join(unicodedata.normalize("NFC", s).split())


def form(c: Column) -> Column:
    """The one form of each value; null stays null."""

    @F.pandas_udf("string")
    def made(values: pd.Series) -> pd.Series:
        return pd.Series(per_distinct(values, one_form), dtype=object)

    return made(c)


def disguised(c: Column) -> Column:
    """Whether each value differs from its usual form; null gives false."""

    @F.pandas_udf("boolean")
    def judged(values: pd.Series) -> pd.Series:
        return pd.Series([bool(x) for x in per_distinct(values, is_disguised)])

    return judged(c)


def unusual(c: Column) -> Column:
    """True where ``c`` has a character beyond Latin-1, a no-break blank or soft hyphen, or one whose place matters;
    false for null. Every disguised value is unusual; the pattern is kept plain, as each value passes it."""
    odd = r"[^\x00-\xff]|[\xa0\xad]|\p{L}[ºª]\p{L}"
    return F.coalesce(c.rlike(odd), F.lit(False))


def find(df: DataFrame, row_id: str, fields: tuple[str, ...]) -> DataFrame:
    """row_id, campo, valor of the disguised values of ``fields``.

    Nulls, empty values and placeholders are no cases; every row counts for itself. Only values with an unusual
    character go to Python. Other columns are not read.
    """
    each = F.array(*[F.struct(F.lit(f).alias("campo"), F.col(f).alias("valor")) for f in fields])
    rows = df.select(F.col(row_id), F.inline(each)).where(filled(F.col("valor")) & unusual(F.col("valor")))
    return rows.where(disguised(F.col("valor")))


def forms(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """campo, forma, n_escritas (spellings of the form, exact), n_linhas; nulls and placeholders are left out."""
    each = F.array(*[F.struct(F.lit(f).alias("campo"), F.col(f).alias("valor")) for f in fields])
    counted = df.select(F.inline(each)).where(filled(F.col("valor"))).groupBy("campo", "valor").agg(F.count("*").alias("n"))
    return (
        counted.select("campo", form(F.col("valor")).alias("forma"), "n")
        .groupBy("campo", "forma")
        .agg(F.count("*").alias("n_escritas"), F.sum("n").alias("n_linhas"))
    )
