"""Folding of text to comparable keys with built-in expressions only.

The tables below are built from rules where a rule exists: full-width forms are ASCII plus a fixed offset, accented
letters come from Unicode's own decompositions.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters of other scripts that look like a Latin letter, listed beside the letter they look like.
LOOK_ALIKES = {
    # Cyrillic
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "о": "o",
    "р": "p", "ԛ": "q", "ѕ": "s", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w", "г": "r", "ґ": "r", "п": "n", "т": "t",
    "м": "m", "н": "h", "ё": "ë", "ї": "ï",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P",
    "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V", "Ԍ": "G", "Ё": "Ë", "Ї": "Ï", "Ӏ": "I",
    # Greek
    "α": "a", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o",
    "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    # Latin and Armenian
    "ɑ": "a", "ɡ": "g", "ı": "i", "ȷ": "j", "ſ": "s", "օ": "o", "ѡ": "w", "ᴏ": "o", "ᴜ": "u", "ᴠ": "v",
    "ⅼ": "l", "Ⅼ": "L",
}

# Hyphens that look like the plain one.
HYPHENS = "\u2010\u2011\u2012\u2043\u2212\ufe63\uff0d"

#: Blanks that are not the plain one, the tab or a line end.
ODD_BLANKS = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

#: Invisible characters (default ignorable), as the inside of a character class; Java and Python read the escapes.
IGNORABLE = (
    r"\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164"
    r"\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8"
)

FULL_WIDTH = {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}


def _accents() -> dict[str, str]:
    """Letters of Latin-1 and Latin Extended-A beside their base letter, by Unicode decomposition."""
    return {
        chr(c): base[0]
        for c in range(0xC0, 0x180)
        if len(base := unicodedata.normalize("NFD", chr(c))) > 1 and base[0].isascii()
    }


ACCENTS = _accents()
#: Signs that compatibility decomposition maps to one ASCII character.
SIGNS = {"º": "o", "ª": "a", "²": "2", "³": "3", "¹": "1", "…": " "}


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``c`` with ``c`` worked out once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(c), body), 0)


def _translate(c: Column, table: dict[str, str]) -> Column:
    return F.translate(c, "".join(table), "".join(table.values()))


def plain(c: Column) -> Column:
    """Text in plain characters with case and signs kept: full-width, look-alike, odd blank and hyphen mapped,
    invisible characters dropped. Greek alpha and beta stay (substance names)."""
    table = {k: v for k, v in LOOK_ALIKES.items() if k != "α"} | FULL_WIDTH
    table |= dict.fromkeys(ODD_BLANKS, " ") | dict.fromkeys(HYPHENS, "-")
    return F.regexp_replace(_translate(c, table), f"[{IGNORABLE}]", "")


def fold(c: Column) -> Column:
    """Lower-case plain text without accents, blanks collapsed; null stays null. Greek alpha and beta are spelled."""
    text = _translate(plain(c), ACCENTS | SIGNS)
    text = F.regexp_replace(F.lower(text), r"\p{M}", "")
    text = F.replace(F.replace(text, F.lit("α"), F.lit("alfa ")), F.lit("β"), F.lit("beta "))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def fold_ascii(c: Column) -> Column:
    """Header folding: accents off, other non-ASCII dropped, blanks collapsed, lower case."""
    text = _translate(c, ACCENTS | SIGNS | dict.fromkeys(ODD_BLANKS, " "))
    text = F.regexp_replace(text, r"[^\x00-\x7f]", "")
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def key(c: Column) -> Column:
    """Fold and keep letters and digits only."""
    return F.regexp_replace(fold(c), r"[^\p{L}\p{N}]", "")


def slug(c: Column, default: str = "PARAM") -> Column:
    """Identifier part: folded, other characters become one underscore, upper case; nothing left gives ``default``."""
    text = F.upper(F.regexp_replace(F.regexp_replace(fold_ascii(c), r"[^a-z0-9]+", "_"), r"^_+|_+$", ""))
    return F.when(text == "", default).otherwise(text)
