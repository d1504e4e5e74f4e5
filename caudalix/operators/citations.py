"""Legal citations in texts: acts in order of first mention, amending acts attached to the act they amend.

One pattern cuts a text into the tokens that matter, acts with their number and whole amendment clauses; one fold over the
tokens keeps the acts found so far. All of it are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caudalix.functions.text import WHITE

# Kinds of act as cited (patterns) beside short and full name; the first that fits counts.
KINDS = (
    (r"Decreto[-\s]?Lei", "DL", "Decreto-Lei"),
    (rf"Decreto{WHITE}+Regulamentar", "DR", "Decreto Regulamentar"),
    (r"Portaria", "Portaria", "Portaria"),
    (r"Resolu[\p{L}\p{N}_]+", "Resolução", "Resolução"),
    (r"Lei", "Lei", "Lei"),
)
# Fixed value: amending acts are called by this short form, whatever their kind.
AMENDING = "DL"
# How a number and an act are written, and how an amendment clause starts and what ends it.
NUMBER = rf"\p{{Nd}}+{WHITE}*/{WHITE}*\p{{Nd}}{{2,4}}"
ACT = rf"(?:{'|'.join(p for p, _, _ in KINDS)}){WHITE}*n?(?:[.º°o]|{WHITE})*{NUMBER}"
OPENS = rf"(?:com{WHITE}+as{WHITE}+altera[\p{{L}}\p{{N}}_]+{WHITE}+introduzidas|alterad[oa]s?){WHITE}+pel[\p{{L}}\p{{N}}_]+{WHITE}"
CLOSES = rf"\(Quadro|,?{WHITE}+e{WHITE}+o{WHITE}+artigo\b|,?{WHITE}+e{WHITE}+o{WHITE}+Decreto[-\s]?Lei{WHITE}+n(?:[.º°o]|{WHITE})*\p{{Nd}}|[;|\n]|\.{WHITE}+[A-Z(]"

_ACTS = "array<struct<diploma:string,numero:string,tipo:string,alteracoes:array<string>>>"


def _squeezed(c: Column) -> Column:
    return F.regexp_replace(c, rf"{WHITE}+", "")


def _kind(token: Column, at: int) -> Column:
    """Short (1) or full (2) name of the act that a token starts with."""
    return F.coalesce(*[F.when(token.rlike(rf"(?i)^(?:{kind[0]})"), kind[at]) for kind in KINDS])


def citations(c: Column) -> Column:
    """array<struct<diploma, numero, tipo, alteracoes>> of each text; null and texts without an act give an empty array.

    Each short form is listed once, at its first mention. A number inside an amendment clause amends the act listed
    last before it, or the first one where none stands before; it is listed once, and not under its own name.
    """
    tokens = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(rf"(?i)({OPENS}(?s:.*?)(?={CLOSES}|\z)|{ACT})"), 1)
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("early"), F.array().cast(_ACTS).alias("acts"))

    def step(state: Column, token: Column) -> Column:
        early, acts = state["early"], state["acts"]
        is_clause = token.rlike(f"(?i)^{OPENS}")
        numbers = F.regexp_extract_all(token, F.lit(f"({NUMBER})"), 1)
        amending = F.transform(numbers, lambda n: F.concat(F.lit(AMENDING + " "), _squeezed(n)))
        number = _squeezed(F.regexp_extract(token, rf"{NUMBER}$", 0))
        name = F.concat(_kind(token, 1), F.lit(" "), number)
        last = F.element_at(acts, -1)

        def act(diploma: Column, numero: Column, tipo: Column, alteracoes: Column) -> Column:
            own = F.array_distinct(F.filter(alteracoes, lambda x: x != diploma))
            return F.struct(diploma.alias("diploma"), numero.alias("numero"), tipo.alias("tipo"), own.alias("alteracoes"))

        before = F.slice(acts, F.lit(1), F.greatest(F.size(acts) - 1, F.lit(0)))
        amended = F.array_append(before, act(last["diploma"], last["numero"], last["tipo"], F.concat(last["alteracoes"], amending)))
        listed = F.array_append(acts, act(name, number, _kind(token, 2), F.when(F.size(acts) == 0, early).otherwise(none)))
        known = F.exists(acts, lambda x: x["diploma"] == name)
        return F.struct(
            F.when(is_clause & (F.size(acts) == 0), F.concat(early, amending)).otherwise(early).alias("early"),
            F.when(is_clause, F.when(F.size(acts) == 0, acts).otherwise(amended)).when(known, acts).otherwise(listed).cast(_ACTS).alias("acts"),
        )

    return F.aggregate(tokens, start, step, lambda s: s["acts"])


def flat(c: Column, separator: str = " | ") -> Column:
    """The short forms of a citation array in one text."""
    return F.array_join(F.transform(c, lambda x: x["diploma"]), separator)
