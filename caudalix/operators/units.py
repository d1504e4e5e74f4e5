"""Quantities in one common unit.

Conversions are the edges of a graph with affine functions (target = scale * source + offset). The shortest
compositions between all connected units are worked out once, with exact fractions, and every cycle is checked for
consistency. The result is a small table keyed by (source, target), joined to the rows by equality.
"""

from __future__ import annotations

import re
from collections import deque
from fractions import Fraction as Fr

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudalix.functions.pytext import fold_text

# Direct conversions (from, to, scale, offset); ASCII unit keys as ``unit_key`` makes them.
EDGES: tuple[tuple[str, str, Fr, Fr], ...] = (
    ("g/l", "mg/l", Fr(1000), Fr(0)),
    ("mg/l", "ug/l", Fr(1000), Fr(0)),
    ("ug/l", "ng/l", Fr(1000), Fr(0)),
    ("mg/l", "g/m3", Fr(1), Fr(0)),
    ("g/m3", "mg/m3", Fr(1000), Fr(0)),
    ("kg/m3", "g/m3", Fr(1000), Fr(0)),
    ("ug/l", "mg/m3", Fr(1), Fr(0)),
    ("mg/100ml", "mg/l", Fr(10), Fr(0)),
    ("mg/dl", "mg/100ml", Fr(1), Fr(0)),
    ("mg/ml", "g/l", Fr(1), Fr(0)),
    ("ug/ml", "mg/l", Fr(1), Fr(0)),
    ("ppm", "mg/l", Fr(1), Fr(0)),
    ("ppb", "ug/l", Fr(1), Fr(0)),
    ("ufc/ml", "ufc/100ml", Fr(100), Fr(0)),
    ("ufc/100ml", "ufc/l", Fr(10), Fr(0)),
    ("ufc/dl", "ufc/100ml", Fr(1), Fr(0)),
    ("m3/h", "m3/d", Fr(24), Fr(0)),
    ("m3/s", "m3/h", Fr(3600), Fr(0)),
    ("m3/min", "m3/h", Fr(60), Fr(0)),
    ("m3/s", "l/s", Fr(1000), Fr(0)),
    ("l/s", "l/min", Fr(60), Fr(0)),
    ("l/min", "l/h", Fr(60), Fr(0)),
    ("m3/h", "l/h", Fr(1000), Fr(0)),
    ("m3/d", "l/d", Fr(1000), Fr(0)),
    ("hm3/d", "m3/d", Fr(1_000_000), Fr(0)),
    ("dam3/d", "m3/d", Fr(1000), Fr(0)),
    ("m3/year", "m3/d", Fr(1, 365), Fr(0)),
    ("s/m", "ms/m", Fr(1000), Fr(0)),
    ("ms/cm", "ms/m", Fr(100), Fr(0)),
    ("ms/cm", "us/cm", Fr(1000), Fr(0)),
    ("ms/m", "us/cm", Fr(10), Fr(0)),
    ("us/cm", "us/m", Fr(100), Fr(0)),
    ("k", "°c", Fr(1), Fr(-27315, 100)),
    ("°f", "°c", Fr(5, 9), Fr(-160, 9)),
    ("t/d", "kg/d", Fr(1000), Fr(0)),
    ("kg/d", "g/d", Fr(1000), Fr(0)),
    ("kg/h", "kg/d", Fr(24), Fr(0)),
    ("g/h", "kg/h", Fr(1, 1000), Fr(0)),
    ("kg/year", "kg/d", Fr(1, 365), Fr(0)),
)

# Spellings of unit words (patterns over folded text) beside their symbols, applied in this order.
_WORDS = (
    (r"unidades formadoras de colonias?", "ufc"),
    (r"\bcfu\b", "ufc"),
    (r"unidades? de ph|unid\.? de ph|unid\.? ph|escala de sorensen|\bsorensen\b|\bunidades? sorensen\b", "ph"),
    (r"graus? celsius|\bcelsius\b|° c", "°c"),
    (r"graus? fahrenheit|\bfahrenheit\b|° f", "°f"),
    (r"\bkelvins?\b", "k"),
    (r"microsiemens", "us"), (r"milisiemens", "ms"), (r"\bsiemens\b", "s"),
    (r"miligramas?", "mg"), (r"microgramas?|\bmcg\b", "ug"), (r"nanogramas?", "ng"),
    (r"quilogramas?|quilos?\b|\bkgs\b", "kg"), (r"\bgramas?", "g"), (r"toneladas?|\btons?\b", "t"),
    (r"hectometros? cubicos?", "hm3"), (r"decametros? cubicos?", "dam3"), (r"metros? cubicos?", "m3"),
    (r"mililitros?", "ml"), (r"decilitros?", "dl"), (r"\blitros?", "l"),
    (r"centimetros?", "cm"), (r"\bmetros?", "m"),
    (r"\bhoras?\b|\bhr\b", "h"), (r"\bminutos?\b", "min"), (r"\bsegundos?\b|\bsegs?\b", "s"),
    (r"\bdias?\b|\bday\b", "d"), (r"\banos?\b", "year"),
)


_PATTERNS = tuple((re.compile(p), symbol) for p, symbol in _WORDS)
_INVERSE = re.compile(r"(?<=[a-z])[ .·*]*(?<![a-z0-9])(ml|dl|l|m3|cm|m|s|h|d)\^?-1\b")
_CUBIC = re.compile(r"(?<=[a-z])[ .·*]+m\^?-3\b")
_UNIT = re.compile(r"°?[a-z]+3?(?:/\d*[a-z]+3?)?")


def unit_key(text: str | None) -> str | None:
    """The unit named at the start of ``text`` as a key; other spellings of one unit give one key, and a substance
    written after the unit is no part of it. None or no unit gives None."""
    if not text:
        return None
    u = fold_text(text.replace("º", "°").replace("µ", "u").replace("μ", "u"))
    for pattern, symbol in _PATTERNS:
        u = pattern.sub(symbol, u)
    u = re.sub(r"\s+por\s+", "/", u)
    u = _CUBIC.sub("/m3", _INVERSE.sub(r"/\1", u))
    u = re.sub(r"/(\d+)\s+(?=[a-z])", r"/\1", re.sub(r"\s*/\s*", "/", u)).strip()
    found = _UNIT.match(u)
    return {"c": "°c", "f": "°f"}.get(found[0], found[0]) if found else None


def compositions(edges=EDGES) -> dict[tuple[str, str], tuple[Fr, Fr]]:
    """(source, target) -> (scale, offset) over the shortest path of edges, for all connected pairs.

    Raises ValueError where two paths between the same units disagree (an inconsistent cycle).
    """
    out: dict[str, list[tuple[str, Fr, Fr]]] = {}
    for a, b, scale, offset in edges:
        out.setdefault(a, []).append((b, scale, offset))
        out.setdefault(b, []).append((a, 1 / scale, -offset / scale))
    table: dict[tuple[str, str], tuple[Fr, Fr]] = {}
    for start in out:
        seen = {start: (Fr(1), Fr(0))}
        queue = deque([start])
        while queue:
            here = queue.popleft()
            a, b = seen[here]
            for there, scale, offset in out[here]:
                made = (a * scale, b * scale + offset)
                if there not in seen:
                    seen[there] = made
                    queue.append(there)
                elif seen[there] != made:
                    raise ValueError(f"conversions from {start} to {there} disagree: {seen[there]} and {made}")
        table |= {(start, there): f for there, f in seen.items()}
    return table


def conversion_table(spark: SparkSession, edges=EDGES) -> DataFrame:
    """source, target, scale, offset: one row per connected pair of units (a few hundred, fixed by the edges)."""
    rows = [(s, t, float(a), float(b)) for (s, t), (a, b) in sorted(compositions(edges).items())]
    return spark.createDataFrame(rows, "source string, target string, scale double, offset double")


_N = r"\d{1,3}(?: \d{3})+(?:[.,]\d+)?|\d+(?:[.,]\d+)?"
_POWER = r"(?:\s*[x×*·]\s*10\s*\^?\s*(-?\d+))?"
_LIMIT = re.compile(
    rf"(?:[^\W\d_][^\W\d_ ]*(?: [^\W\d_]+)*\s*:)?[\s≤≥<>=~±]*(?:(?:m[aá]x|m[ií]n)(?:imo)?\.?\s*)?[\s≤≥<>=~±]*({_N}){_POWER}"
    rf"(?:\s*(?:-|–|—|\baté\b|\bate\b|\ba\b)\s*({_N}){_POWER})?\s*([^\d\s].*)?",
    re.IGNORECASE | re.DOTALL,
)


def parse_limit(text: str | None) -> tuple[float, float, str | None] | None:
    """low, high and the unit after the figures of one limit or range; None where there is no figure.

    Decimal comma or point, blanks between thousands, powers of ten; signs and labels before the figure are ignored.
    """
    found = _LIMIT.fullmatch(text.strip()) if text else None
    if not found:
        return None
    number = lambda n, p: float(n.replace(" ", "").replace(",", ".")) * 10.0 ** int(p or 0)
    low = number(found[1], found[2])
    return low, number(found[3], found[4]) if found[3] else low, found[5]


def thousandths(x: Column) -> Column:
    """``x`` in whole thousandths; half is rounded up. The inner rounding takes off binary noise."""
    return F.round(F.round(x, 7) * 1000).cast("bigint")
