"""Pieces of SQL that the oracles share; the tables are those of the column expressions."""

from __future__ import annotations

from caudalix.functions.fold import ACCENTS, ODD_BLANKS, SIGNS
from caudalix.functions.placeholders import PLACEHOLDERS

_FOLD = ACCENTS | SIGNS | dict.fromkeys(ODD_BLANKS, " ")
_PLAIN = ACCENTS | dict.fromkeys(ODD_BLANKS, " ")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(items) -> str:
    return ", ".join(quoted(x) for x in items)


def fold(c: str) -> str:
    """``fold_ascii`` in SQL."""
    plain = f"translate({c}, {quoted(''.join(_FOLD))}, {quoted(''.join(_FOLD.values()))})"
    ascii_only = f"regexp_replace({plain}, '[^\\x00-\\x7F]', '', 'g')"
    return f"lower(trim(regexp_replace({ascii_only}, '\\s+', ' ', 'g')))"


def identity(c: str) -> str:
    """``identity_norm`` in SQL."""
    plain = f"translate(coalesce({c}, ''), {quoted(''.join(_PLAIN))}, {quoted(''.join(_PLAIN.values()))})"
    return f"lower(trim(regexp_replace({plain}, '\\s+', ' ', 'g')))"


def filled(c: str) -> str:
    return f"coalesce(trim({c}) NOT IN ({values(PLACEHOLDERS)}), false)"


def date(c: str) -> str:
    """``parse_date`` in SQL."""
    t = fold(c)
    months = "['jan','fev','mar','abr','mai','jun','jul','ago','set','out','nov','dez']"
    dmy, ymd = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?:[ t].*)?$", r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[ t].*)?$"
    words = r"^(\d{1,2})(?:\.?o)? de ([a-z]{3,9})\.? de (\d{4})$"
    made = lambda p, y, m, d: f"try_strptime(regexp_extract({t}, '{p}', {y}) || '-' || {m} || '-' || regexp_extract({t}, '{p}', {d}), '%Y-%m-%d')::DATE"
    return (
        f"CASE WHEN regexp_matches({t}, '{dmy}') THEN {made(dmy, 3, f'regexp_extract({t}, {quoted(dmy)}, 2)', 1)} "
        f"WHEN regexp_matches({t}, '{ymd}') THEN {made(ymd, 1, f'regexp_extract({t}, {quoted(ymd)}, 2)', 3)} "
        f"WHEN regexp_matches({t}, '{words}') THEN {made(words, 3, f'list_position({months}, regexp_extract({t}, {quoted(words)}, 2)[1:3])::VARCHAR', 1)} END"
    )


def contains_case(c: str, table, default: str) -> str:
    """``ordered_contains`` in SQL."""
    whens = " ".join(f"WHEN contains({c}, {quoted(a)}) THEN {quoted(b)}" for a, b in table)
    return f"CASE {whens} ELSE {default} END"


def km(la: str, lo: str, lb: str, lob: str) -> str:
    h = f"pow(sin(radians({lb}-{la})/2),2)+cos(radians({la}))*cos(radians({lb}))*pow(sin(radians({lob}-{lo})/2),2)"
    return f"12742.0*asin(least(1.0, sqrt({h})))"
