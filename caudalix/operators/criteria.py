"""Conformity rules: flags from texts, and the star of catalogue, texts, facts, licences and parameters."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudalix.functions.fold import fold_ascii, slug
from caudalix.functions.placeholders import filled
from caudalix.operators.records import ordinals, pick
from caudalix.operators.skew import hot_counted, hot_keys, salted_join
from caudalix.session import cut

# The nine flags, in order.
FLAGS = ("f_vle", "f_reducao", "f_gama", "f_dobro", "f_150", "f_ordem", "f_mensal", "f_anual", "f_quadro")

# What the flags are called in comparisons, in the same order.
LABELS = (
    "VLE", "% mín. remoção", "Gama de valores", "≤100% VLE (dobro)", "≤150% VLE", "≤1 ordem de grandeza", "média mensal ≤ VLE", "média anual ≤ VLE",
    "Quadro III DL 152/97",
)


# The texts that set each flag. A flag is set by any one of its lists, a list by all of its phrases; "!"
# marks a phrase that must be absent and "~" a pattern. A list without phrases always holds. NO_SAMPLE is
# left out in one of the two copies of the rules.
NO_SAMPLE = ("nenhuma amostra",)
RULES: dict[str, tuple[tuple[str, ...], ...]] = {
    "f_vle": ((),),
    "f_reducao": (),
    "f_gama": ((r"~5[.,]0\s*-?\s*10[.,]0",), NO_SAMPLE),
    "f_dobro": (
        ("dobro do vle",), ("100%",), ("mais de 100",),
        ("artigo 69", "!152/97"), ("art. 69", "!152/97"), ("artigo n", "69", "!152/97"),
    ),
    "f_150": (("150%",),),
    "f_ordem": (("ordem de grandeza",),),
    "f_mensal": (("media mensal",),),
    "f_anual": (("media anual",),),
    "f_quadro": (
        ("152/97", "amostras nao conformes"), ("152/97", "minimo anual de amostras"), ("152/97", "quadro n"), ("152/97", "alinea d"),
    ),
}
# The same for the second regime's assessments, and the phrase that only names the law.
_FIRST, _SECOND = ("artigo 69", r"~n\.?\s*o?\s*6"), ("nenhuma amostra excede", "100")
LICENCE_RULES: dict[str, tuple[tuple[str, ...], ...]] = {
    "mensal": (_FIRST,),
    "dobro": (_FIRST, ("alinea d",), _SECOND),
    "quadro": (("alinea d",), (*_SECOND, "relacao estatistica"), (*_SECOND, "quadro")),
}
ONLY_LAW, LEAST_TEXT = "anexo xviii", 6


def holds(text: Column, lists: tuple[tuple[str, ...], ...]) -> Column:
    """Whether the folded ``text`` meets one of the lists of phrases."""

    def met(phrase: str) -> Column:
        if phrase.startswith("~"):
            return text.rlike(phrase[1:])
        return ~text.contains(phrase[1:]) if phrase.startswith("!") else text.contains(phrase)

    return reduce(or_, [reduce(and_, map(met, phrases), F.lit(True)) for phrases in lists], F.lit(False))


def _folded(c: Column) -> Column:
    return F.coalesce(fold_ascii(c), F.lit(""))


def flags(c: Column, no_sample_is_range: bool = True) -> list[Column]:
    """The nine 0/1 flags of an assessment text. ``no_sample_is_range``: whether "nenhuma amostra" means a range (the
    two copies of the rule in the feed differ there)."""
    text = _folded(c)
    left_out = () if no_sample_is_range else (NO_SAMPLE,)
    return [holds(text, tuple(x for x in RULES[f] if x not in left_out)).cast("int").alias(f) for f in FLAGS]


def labels(c: Column) -> Column:
    """The names of the flags that an assessment text sets; null where there is no text."""
    found = F.array_compact(F.array(*[F.when(x == 1, label) for x, label in zip(flags(c), LABELS)]))
    return F.when(filled(c), found)


def licence_flags(c: Column) -> list[Column]:
    """Flags of a LURH assessment text: mean by month, double, table III, and how they came about."""
    text = _folded(c)
    long = F.length(text) >= LEAST_TEXT
    found = {name: long & holds(text, lists) for name, lists in LICENCE_RULES.items()}
    derived = reduce(or_, found.values())
    state = F.when(~long, "").when(derived, "derivado").when(text.contains(ONLY_LAW), "só legislação").otherwise("sem critério")
    return [*[x.cast("int").alias(name) for name, x in found.items()], state.alias("estado")]


def limit_order(c: Column) -> list[Column]:
    """Sort key of limits: figures by value, then ranges and texts by spelling."""
    text = F.replace(F.trim(F.coalesce(c, F.lit(""))), F.lit(","), F.lit("."))
    is_number = text.rlike(r"^\d+(?:\.\d+)?$")
    return [F.when(is_number, 0).otherwise(1), F.when(is_number, text.try_cast("double")).otherwise(0.0), F.when(is_number, "").otherwise(text)]


@dataclass
class Star:
    catalogue: DataFrame
    texts: DataFrame
    facts: DataFrame
    licences: DataFrame
    parameters: DataFrame
    #: Licences with so many facts that their rows are spread in joins, as ``hot_keys`` gives them.
    hot_licences: dict[int, int] | None = None


def _numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    return ordinals(df, group, order, name)


def normalise(rows: DataFrame, source: str) -> Star:
    """The star of flat records: row_id, licenca, estabelecimento, parametro_doc, parametro, vle, nota, legislacao,
    avaliacao, and the flags.

    A rule is (parametro, vle, flags), numbered per parameter; a text is (legislacao, avaliacao), numbered over all.
    Numbers are given by distributed positions, so neither a hot parameter nor the texts end in one task.
    """
    key = ["parametro", "vle", *FLAGS]
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    filled = rows.withColumns({c: blank(c) for c in ("parametro", "vle", "legislacao", "avaliacao", "parametro_doc")})
    rank, value, text = limit_order(F.col("vle"))
    rules = filled.groupBy(*key).agg(F.count("*").alias("uso")).withColumns({"slug": slug(F.col("parametro")), "_r": rank, "_v": value, "_t": text})
    rules = _numbered(rules, ["slug"], ["parametro", "_r", "_v", "_t", "vle", *FLAGS], "n")
    # Both dimensions are written once: their uses tell the hot keys, and every join with the facts reads them again.
    catalogue = cut(rules.select(F.concat_ws("_", F.lit(source), "slug", F.col("n").cast("string")).alias("id_criterio"), *key, "uso"))
    texts = filled.groupBy("legislacao", "avaliacao").agg(F.count("*").alias("uso"))
    texts = _numbered(texts, [], ["legislacao", "avaliacao"], "n")
    number = F.when(F.col("n") < 100, F.lpad(F.col("n").cast("string"), 2, "0")).otherwise(F.col("n").cast("string"))
    texts = cut(texts.select(F.concat(F.lit(f"{source}_TX"), number).alias("id_texto"), "legislacao", "avaliacao", "uso"))
    pair = ["legislacao", "avaliacao"]
    ruled = salted_join(filled, catalogue.drop("uso"), key, "row_id", "inner", hot_counted(catalogue, key, "uso"))
    facts = salted_join(ruled, texts.drop("uso"), pair, "row_id", "inner", hot_counted(texts, pair, "uso")).select(
        "row_id", "licenca", "parametro_doc", "vle", "nota", "id_criterio", "id_texto"
    )
    licences = pick(filled, ["licenca"], [F.col("row_id")], ["licenca", "estabelecimento"])
    parameters = filled.select("parametro_doc", "parametro").distinct()
    return Star(catalogue, texts, facts, licences, parameters, hot_keys(filled, ["licenca"]))


def flatten(star: Star) -> DataFrame:
    """The flat view of a star: every fact with its rule, text and licence; hot keys of the facts are spread by row."""
    rules, texts = star.catalogue, star.texts
    flat = salted_join(star.facts, rules.drop("uso", "vle"), ["id_criterio"], "row_id", "inner", hot_counted(rules, ["id_criterio"], "uso"))
    flat = salted_join(flat, texts.drop("uso"), ["id_texto"], "row_id", "inner", hot_counted(texts, ["id_texto"], "uso"))
    flat = salted_join(flat, star.licences, ["licenca"], "row_id", "inner", star.hot_licences)
    return flat.select("row_id", "licenca", "estabelecimento", "parametro_doc", "parametro", "vle", "nota", "legislacao", "avaliacao", *FLAGS)


def integrity(star: Star) -> DataFrame:
    """verificacao, n: orphans and unused members of the star, and rule uses that do not add up; all 0 in a good one."""

    def orphans(name: str, a: DataFrame, b: DataFrame, on: str) -> DataFrame:
        return a.join(b.select(on).distinct(), on, "left_anti").agg(F.lit(name).alias("verificacao"), F.count("*").alias("n"))

    uses = star.catalogue.agg(F.sum("uso").alias("u")).join(F.broadcast(star.facts.agg(F.count("*").alias("f"))))
    checks = [
        orphans("factos sem criterio", star.facts, star.catalogue, "id_criterio"),
        orphans("factos sem texto", star.facts, star.texts, "id_texto"),
        orphans("criterios sem uso", star.catalogue, star.facts, "id_criterio"),
        orphans("textos sem uso", star.texts, star.facts, "id_texto"),
        uses.select(F.lit("usos a mais ou a menos").alias("verificacao"), F.abs(F.col("u") - F.col("f")).alias("n")),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out
