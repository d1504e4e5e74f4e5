"""Scalar text functions of the licence feed, as column expressions.

The folding variants differ on purpose and are kept apart; each says what it keeps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caudalix.functions.fold import ACCENTS, ODD_BLANKS, SIGNS, fold_ascii, let

# Words left out of plant names and of asset names.
PLANT_WORDS = ("etar", "lic", "de", "da", "do", "das", "dos")
ARTICLES = ("DE", "DA", "DO", "DAS", "DOS", "D")
_ACCENTS = ACCENTS | dict.fromkeys(ODD_BLANKS, " ")


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, trimmed; null gives empty text."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))


def header_key(c: Column) -> Column:
    """Folded header without blanks."""
    return F.replace(fold_ascii(c), F.lit(" "), F.lit(""))


def plant_key(c: Column) -> Column:
    """Folded plant name without articles and ETAR, letters and digits only."""
    bare = F.regexp_replace(fold_ascii(c), r"\b(?:" + "|".join(PLANT_WORDS) + r")\b", " ")
    return F.regexp_replace(bare, r"[^a-z0-9]", "")


def _asset_words(c: Column, expand: bool) -> Column:
    words = F.split(F.trim(F.regexp_replace(F.upper(fold_ascii(c)), r"[^A-Z0-9 ]+", " ")), r"\s+")
    if expand:
        words = F.transform(words, lambda w: F.when(w == "STO", "SANTO").when(w == "STA", "SANTA").otherwise(w))
    return F.array_join(F.filter(words, lambda w: ~w.isin(*ARTICLES)), "")


def asset_key(c: Column) -> Column:
    """Folded asset name in upper case, articles dropped, no blanks; null gives empty text."""
    return F.coalesce(_asset_words(c, False), F.lit(""))


def asset_key_bare(c: Column) -> Column:
    """Asset key with STO and STA spelled out and a leading ETAR, ETA or EETAR dropped."""
    return F.regexp_replace(F.coalesce(_asset_words(c, True), F.lit("")), "^(?:ETAR|ETA|EETAR)", "")


def identity_norm(c: Column) -> Column:
    """Accents off, other characters kept, blanks collapsed, lower case; null gives empty text."""
    return F.lower(collapse(F.translate(c, "".join(_ACCENTS), "".join(_ACCENTS.values()))))


def parameter_norm(c: Column) -> Column:
    """Parameter without bracketed parts and punctuation, lower case, accents kept; four abbreviations spelled out."""
    bare = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s*\([^)]*\)", ""))
    # Abbreviations beside the names they stand for.
    full = (
        F.when(bare == "CBO5", "Carência Bioquímica de Oxigénio")
        .when(bare == "CQO", "Carência Química de Oxigénio")
        .when(bare == "O&G", "Óleos e Gorduras")
        .when(bare == "SST", "Sólidos Suspensos Totais")
        .otherwise(bare)
    )
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(full), r"[^\p{L}\p{N}_\s]", ""), r"\s+", " "))


def legal_norm(c: Column) -> Column:
    """Comparable legal text: identity form, ``n.º`` as ``n``, no blanks around punctuation, none at the end."""
    text = identity_norm(F.translate(c, "ºª", "oa"))
    text = F.regexp_replace(text, r"n\.?\s*[o°]\s*", "n")
    return F.regexp_replace(F.regexp_replace(text, r"\s*([.,;:])\s*", "$1"), r"[\s.,;:]+$", "")


def file_slug(c: Column) -> Column:
    """Letters and digits of a file name, lower case."""
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}]", ""))


def clean_code(c: Column) -> Column:
    """A code without any blanks."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", "")


def control_to_dash(c: Column) -> Column:
    """Control characters as dashes, blanks collapsed."""
    return collapse(F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "-"))


# Fixed value: white space as Python's strip knows it, no-break and typographic blanks among it.
WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def dewrap(c: Column) -> Column:
    """Physical lines joined: a line that ended in a blank ended a word, any other was split by the wrap. Runs of white
    space become one blank; null gives empty text."""
    bare = lambda x: F.regexp_replace(x, rf"^{WHITE}+|{WHITE}+\z", "")
    # A blank line neither adds a word boundary nor takes one away.
    ended = lambda x: F.when(x.rlike(rf"{WHITE}\z") & (bare(x) != ""), " ").otherwise("")
    lines = F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), lambda x: F.concat(bare(x), ended(x)))
    return F.trim(F.regexp_replace(F.array_join(lines, ""), rf"{WHITE}+", " "))


def checkbox(c: Column) -> Column:
    """``|X|`` is Sim, ``|_|`` is Não, other text stays."""
    return F.when(c.rlike(r"\|\s*[Xx]\s*\|"), "Sim").when(c.rlike(r"\|\s*_?\s*\|"), "Não").otherwise(c)


def sampling_note(kind: Column, note: Column) -> Column:
    """The phrase of ``note`` for the roman marker that ``kind`` carries; empty text without marker or phrase."""
    marker = F.regexp_extract(F.coalesce(kind, F.lit("")), r"\(([ivx]+)\)", 1)
    # Each phrase reaches to the next marker, a sentence end or the end.
    phrases = F.regexp_extract_all(F.coalesce(note, F.lit("")), F.lit(r"(\([ivx]+\)\s*.*?)(?=\s*;\s*\([ivx]+\)|\.\s|$)"), 1)
    own = F.filter(phrases, lambda p: p.startswith(F.concat(F.lit("("), marker, F.lit(")"))))
    text = F.regexp_replace(F.get(own, 0), r"[. ]+$", "")
    return F.when((marker != "") & text.isNotNull(), text).otherwise("")


def ordered_contains(c: Column, table: list[tuple[str, str]], default: Column) -> Column:
    """The label of the first fragment that ``c`` contains, in the order given."""

    def labelled(text: Column) -> Column:
        out = F.lit(None).cast("string")
        for fragment, label in reversed(table):
            out = F.when(text.contains(fragment), label).otherwise(out)
        return out

    return F.coalesce(let(c, labelled), default)


def split_two(c: Column, delimiter: str) -> tuple[Column, Column]:
    """The first two parts of ``c`` at a literal delimiter; further parts are dropped, a missing one is null."""
    parts = F.split(c, "\\Q" + delimiter + "\\E")
    return F.get(parts, 0), F.get(parts, 1)


def chained_replace(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements one after the other, each on the result of the one before."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def url_path(c: Column) -> Column:
    """Each segment of a path percent-encoded (blank as %20), slashes kept."""
    return F.array_join(F.transform(F.split(c, "/"), lambda s: F.replace(F.url_encode(s), F.lit("+"), F.lit("%20"))), "/")


def text_pair_key(*texts: Column) -> Column:
    """Short stable key of a tuple of legal texts."""
    return F.substring(F.sha1(F.concat_ws("\x1f", *[legal_norm(t) for t in texts])), 1, 16)


def third_place(c: Column) -> Column:
    """The middle part of ``a / b / c`` where there are two slashes or more, else null."""
    return F.when(F.regexp_count(c, F.lit("/")) >= 2, F.trim(F.split_part(c, F.lit("/"), F.lit(2))))


def region_code(c: Column) -> Column:
    """The river-basin code at the end of a licence number (``.RH5A``), empty text without one."""
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"\.(RH\w+)$", 1)


# Reporting periods by fragment -> label, in order, and the labels' sort codes (others 9).
PERIODS = [("trimestr", "Trimestral"), ("semestr", "Semestral"), ("anual", "Anual")]
PERIOD_ORDER = {"Mensal": 1, "Trimestral": 2, "Semestral": 3, "Anual": 4}
# Reporting formats by fragment -> label, in order.
FORMATS = [
    ("siliamb", "Plataforma SILiAmb"), ("autocontrolo", "Módulo de Autocontrolo"), ("periodicidade", "A verificar"),
    ("trimestral", "A verificar"), ("descrição", "A verificar"), ("mail", "E-mail"),
]


def reporting_period(c: Column) -> Column:
    """Label of a reporting period: monthly unless it says half-yearly, then by fragment, else A verificar; blank is
    Não especificada."""
    text = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    monthly = text.contains("mensal") & ~text.contains("semestral")
    return F.when(text == "", "Não especificada").when(monthly, "Mensal").otherwise(ordered_contains(text, PERIODS, F.lit("A verificar")))


def period_order(label: Column) -> Column:
    """Sort code of a reporting period's label."""
    out = F.lit(9)
    for name, n in PERIOD_ORDER.items():
        out = F.when(label == name, n).otherwise(out)
    return out


def reporting_format(c: Column) -> Column:
    """Label of a reporting format by fragment, else the text in title case; blank is Não especificado."""
    text = F.trim(F.coalesce(c, F.lit("")))
    return F.when(text == "", "Não especificado").otherwise(ordered_contains(F.lower(text), FORMATS, F.initcap(text)))


__all__ = [n for n in dir() if not n.startswith("_")] + ["SIGNS"]
