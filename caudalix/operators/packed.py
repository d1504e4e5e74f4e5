"""Fields that hold several values: one row per value, with its position.

The text is split on quotation marks. Odd pieces are literals and stay whole; even pieces are split on the delimiters
of the field's kind. A fold over the pieces puts the values together again, in the order written. Everything is a
built-in expression on the row, so the operator neither shuffles nor leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudalix.functions.fold import let
from caudalix.functions.placeholders import PLACEHOLDERS, strip

_CUT, _OPEN, _CLOSE = "\u0001", "\u0002", "\u0003"
_QUOTES = '["“”„«»]'

# Words a legal reference starts with.
LAW_STARTS = (
    "Decreto-Lei", "Decreto Regulamentar", "Decreto Legislativo", "Decreto", "Lei", "Portaria", "Despacho",
    "Regulamento", "Anexo", "Diretiva", "Directiva", "Resolução", "Aviso", "Declaração", "Deliberação", "Norma",
    "Artigo", "artigo", "Alínea", "alínea", "n.º", "Plano", "Edital", "Acórdão",
)
# Words after which a line break is a mere wrap.
_JOINERS = "de|do|da|dos|das|pelo|pela|pelos|pelas|e|ou|com|por|no|na|em|ao|à|n\\.º|nº|art\\.º|alterado|alterada"


@dataclass(frozen=True)
class Kind:
    """How one kind of field separates its values: a regular expression for each of its delimiters."""

    start: str
    more: tuple[str, ...] = ()

    def delimiters(self) -> str:
        # Bars and semicolons always separate; a line end does before the start of another value.
        wrap = rf"(?<!,)(?<!-)(?<!\b(?:{_JOINERS}))[ \t]*[\r\n]+(?=\s*(?:{self.start}))"
        return "|".join((r"\s*(?:;|\||¦|\s//\s|•)\s*", wrap, *self.more))


_LAW = "|".join(x.replace(".", r"\.") for x in LAW_STARTS)
_NUMBER = r"[≤≥<>=~±]*\s*(?:m[áa]x\.?|m[íi]n\.?)?\s*\d"
_LABEL = r"\p{Lu}[\p{L} ]{2,30}:\s*[≤≥<>=\d]"
_MARK = r"(?:[-*•–]\s|\(?[A-Za-z0-9]{1,2}[.)]\s)"

LAW = Kind(rf"{_MARK}|(?:{_LAW})\b", (rf",\s+(?=(?:{_LAW})\s)", rf"\s+e\s+(?=(?:{_LAW})\s)", rf"\s+/\s+(?=(?:{_LAW})\s)"))
ASSESSMENT = Kind(rf"{_MARK}|\p{{Lu}}", (r"\s+/\s+(?=\p{Lu})",))
LIMIT = Kind(
    rf"{_MARK}|{_NUMBER}|{_LABEL}",
    (rf"\s+/\s+(?={_NUMBER}|{_LABEL})", rf"\s+e\s+(?={_NUMBER}|{_LABEL})", rf",\s+(?={_NUMBER}|{_LABEL})", "(?<=\\d)//(?=\\d)"),
)

# A list mark, and the marks that may follow it inside the same line: only those of the first mark's form.
_MARKS = (
    (r"^\s*\([a-z]\)\s", r"\s+(?=\([b-z]\)\s)"),
    (r"^\s*\(\d{1,2}\)\s", r"\s+(?=\(\d{1,2}\)\s)"),
    (r"^\s*[a-z]\)\s", r"(?<!alínea)\s+(?=[b-z]\)\s(?!d[oa]s?\s+n\.))"),
    (r"^\s*\d{1,2}\)\s", r"\s+(?=\d{1,2}\)\s)"),
    (r"^\s*\d{1,2}\.\s", r"\s+(?=\d{1,2}\.\s+[\p{L}\"“«])"),
    (r"^\s*[*]\s", r"\s+(?=[*]\s)"),
    (r"^\s*[-–]\s", r"[\r\n]\s*(?=[-–]\s)"),
)
_ANY_MARK = r"^(?:\([a-z0-9]{1,2}\)|[a-z]\)|\d{1,2}\)|\d{1,2}\.(?=\s)|[-–*•](?=\s))\s+"


def values_of(c: Column, kind: Kind, least: int = 1) -> Column:
    """The values of ``c`` in the order written, as an array of text.

    Null, empty text and placeholders give an empty array. An unpaired quotation mark is an ordinary character.
    Each value comes without separators, list marks, quotation marks and white space around it; empty pieces are
    dropped. A final full stop stays. Where fewer than ``least`` values are of no use, a field that holds no more than
    one may give an empty array, too.
    """
    text = F.coalesce(c, F.lit(""))
    if least > 1:
        return F.when(text.rlike(_MAY_SEPARATE), _split(text, kind)).otherwise(F.array().cast("array<string>"))
    single = F.filter(F.array(_bare(text)), lambda v: ~v.isin(*PLACEHOLDERS))
    # Most fields hold one value: whatever has no separator, quotation mark or list mark at all skips the fold.
    return F.when(text.rlike(_MAY_SEPARATE), _split(text, kind)).otherwise(single)


def _split(text: Column, kind: Kind) -> Column:
    paired = F.size(F.split(text, _QUOTES)) % 2 == 1
    pieces = F.when(paired, F.split(text, _QUOTES)).otherwise(F.array(text))
    parts = let(pieces, lambda p: F.transform(F.split(_folded(text, p, kind), _CUT), _bare))
    return F.filter(parts, lambda v: ~v.isin(*PLACEHOLDERS))


def _folded(text: Column, pieces: Column, kind: Kind) -> Column:
    """The text with a cut between values; literals are fenced, so that a whole one can be told from one in a value."""

    def even(p: Column, i: Column) -> Column:
        # Beside a literal a comma or "e" separates too, and two literals are always two values.
        left, right = i > 0, i < F.size(pieces) - 1
        out = let(F.regexp_replace(_by_marks(text, p), kind.delimiters(), _CUT), lambda x: F.when(left, F.regexp_replace(x, r"^\s*,\s*|^\s+e\s+", _CUT)).otherwise(x))
        out = let(out, lambda x: F.when(right, F.regexp_replace(x, r"\s*,\s*$|\s+e\s+$", _CUT)).otherwise(x))
        return let(out, lambda x: F.when(left & right & (F.trim(x) == ""), _CUT).otherwise(x))

    fenced = F.transform(pieces, lambda p, i: F.when(i % 2 == 1, F.concat(F.lit(_OPEN), p, F.lit(_CLOSE))).otherwise(even(p, i)))
    return F.aggregate(fenced, F.lit(""), lambda acc, p: F.concat(acc, p))


#: Every delimiter and list mark has one of these.
_MAY_SEPARATE = (
    r'[;|¦•"“”„«»\r\n]|//|\s/\s|,\s+(?=\p{Lu}|\d|[≤≥<>=~±m]|alínea|artigo|n\.º)|\se\s+(?=\p{Lu}|\d|[≤≥<>=~±m]|alínea|artigo|n\.º)'
    r"|\s\(?[a-z0-9]{1,2}[.)]\s|\s\*\s"
)


def _by_marks(text: Column, piece: Column) -> Column:
    out = piece
    for first, following in reversed(_MARKS):
        out = F.when(text.rlike(first), F.regexp_replace(piece, following, _CUT)).otherwise(out)
    return out


def _bare(v: Column) -> Column:
    def unfenced(unmarked: Column) -> Column:
        whole = F.regexp_extract(unmarked, f"^{_OPEN}([^{_OPEN}{_CLOSE}]*){_CLOSE}$", 1)
        return F.when(unmarked.contains(_OPEN), F.coalesce(F.nullif(whole, F.lit("")), F.regexp_replace(unmarked, f"[{_OPEN}{_CLOSE}]", '"'))).otherwise(unmarked)

    return strip(let(F.regexp_replace(strip(v), _ANY_MARK, ""), unfenced))


def unpack(df: DataFrame, row_id: str, fields: dict[str, Kind], least: int = 2) -> DataFrame:
    """One row per value of each field with at least ``least`` values: row_id, campo, posicao (from 1), valor.

    Rows of an empty table, and fields without a value, give no row; repeated rows are unpacked each for itself.
    Columns besides ``row_id`` and the fields are not read, so their names cannot clash.
    """
    each = F.array(
        *[F.struct(F.lit(name).alias("campo"), values_of(F.col(name), kind, least).alias("valores")) for name, kind in fields.items()]
    )
    rows = df.select(F.col(row_id).alias("_id"), F.explode(each).alias("_f")).where(F.size("_f.valores") >= least)
    return rows.select(F.col("_id"), F.col("_f.campo").alias("campo"), F.posexplode("_f.valores")).select(
        F.col("_id").alias(row_id), "campo", (F.col("pos") + 1).cast("bigint").alias("posicao"), F.col("col").alias("valor")
    )
