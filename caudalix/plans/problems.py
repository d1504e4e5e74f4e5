"""Queries p2, p5 and p7 over the domain tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudalix.functions.dates import parse_date
from caudalix.functions.placeholders import PLACEHOLDERS, filled
from caudalix.functions.pytext import Memo, plain_text
from caudalix.operators import intervals, packed, units, vocabulary
from caudalix.plans import sql
from caudalix.sources.tables import table

PACKED_FIELDS = {
    "legislacao_aplicavel": packed.LAW,
    "avaliacao_conformidade_legal": packed.ASSESSMENT,
    "vle": packed.LIMIT,
}


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each value of the packed fields of conditions with its position; fields with one value give no row."""
    return packed.unpack(table(spark, folder, "conditions", "cond_id", *PACKED_FIELDS), "cond_id", PACKED_FIELDS)


def p2_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """How many values the fields hold: campo, n_valores, n_linhas."""
    rows = table(spark, folder, "conditions", *PACKED_FIELDS)
    sizes = F.array(
        *[
            F.struct(F.lit(name).alias("campo"), F.size(packed.values_of(F.col(name), kind)).cast("bigint").alias("n_valores"))
            for name, kind in PACKED_FIELDS.items()
        ]
    )
    return (
        rows.select(F.inline(sizes)).groupBy("campo", "n_valores").agg(F.count("*").alias("n_linhas"))
    )


def licence_periods(spark: SparkSession, folder: str) -> DataFrame:
    """The dated periods of each codmaximo, each once: codmaximo, inicio, fim.

    Both sides are made distinct before they meet, so no file_name or codmaximo is hot in the join.
    """
    plants = (
        table(spark, folder, "licenses", "file_name", "codmaximo")
        .where(filled(F.col("codmaximo")) & F.col("file_name").isNotNull())
        .distinct()
    )
    dates = (
        table(spark, folder, "dados_gerais", "file_name", "data_de_inicio", "data_de_validade")
        .select(
            "file_name", parse_date(F.col("data_de_inicio")).alias("inicio"), parse_date(F.col("data_de_validade")).alias("fim")
        )
        .where(F.col("inicio") <= F.col("fim"))
        .distinct()
    )
    return plants.join(dates, "file_name").select("codmaximo", "inicio", "fim")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Continuous periods of each codmaximo's licences and the gaps between them."""
    return intervals.periods_and_gaps(licence_periods(spark, folder), "codmaximo", "inicio", "fim")


_BRACKET = re.compile(r"[(\[]([^()\[\]]*)[)\]]?\s*$")
_TAIL = re.compile(r"(?:\s-|,)\s+([^,()\[\]]+)$")
_LEAD = re.compile(r"^\s*(?:\*\s*)?(?:\d+[.)]\s*)?(?:Parâmetro:|Determinação de)?\s*")


def _written_unit(name: str) -> str | None:
    """The unit written after a parameter's name: in its last bracket, or after a dash or comma."""
    found = _BRACKET.search(name) or _TAIL.search(name)
    return found[1] if found else None


def _bare_name(name: str) -> str:
    """A parameter's name without bracket, unit, numbering, star and lead words."""
    return _LEAD.sub("", re.sub(r"\s*[(\[].*$", "", _TAIL.sub("", name), flags=re.DOTALL)).replace("*", "").strip()


def limit_reader(names: list[tuple[int, str]]):
    """A function over batches of (cond_id, limit, unidade, parametro_doc, parametro) to cond_id, ref_id, source, low,
    high, for ``mapInPandas``. Each part is worked out once per distinct text and worker; rows without a limit, a unit
    or a known parameter are left out."""
    lookup = vocabulary.Lookup(names)
    no_value = lambda s: s is None or s.strip() in PLACEHOLDERS

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = Memo(lambda s: None if no_value(s) else lookup(re.sub(r"\s*\(.*$", "", s)) or lookup(s))
        name = Memo(lambda s: None if no_value(s) else lookup(_bare_name(plain_text(s))))
        unit = Memo(lambda s: None if no_value(s) else units.unit_key(plain_text(s)))
        written = Memo(lambda s: None if no_value(s) else units.unit_key(_written_unit(plain_text(s))))
        limit = Memo(lambda s: units.parse_limit(plain_text(s)))
        for batch in batches:
            rows = []
            for i, v, u, d, p in zip(*[batch[c] for c in ("cond_id", "limit", "unidade", "parametro_doc", "parametro")]):
                if (found := limit[v]) is None:
                    continue
                ref = code[p]
                ref = name[d] if ref is None else ref
                source = unit[found[2]] or unit[u] or written[d]
                if ref is not None and source is not None:
                    rows.append((i, ref, source, found[0], found[1]))
            yield pd.DataFrame(rows, columns=["cond_id", "ref_id", "source", "low", "high"])

    return read


def common_units(spark: SparkSession, folder: str) -> DataFrame:
    """Every limit or range of conditions in the common unit of its parameter.

    cond_id, ref_id, source and target (unit keys), low and high in the common unit (null where the units do not
    connect). Rows with no limit or several, without any unit, or with a parameter outside the list give no row.
    """
    ref = table(spark, folder, "ref_valores", "ref_id", "lista", "valor", "codigo", "unidade_comum", "outros_nomes")
    parameters = ref.where("lista = 'parametro'")
    read = limit_reader(vocabulary.named(parameters, "ref_id", ("valor", "codigo"), "outros_nomes"))
    rows = table(spark, folder, "conditions", "cond_id", "parametro_doc", "parametro", "unidade", "vle")
    single = (
        rows.where(filled(F.col("vle")))
        .withColumn("limits", packed.values_of(F.col("vle"), packed.LIMIT))
        .where(F.size("limits") == 1)
        .select("cond_id", F.get("limits", 0).alias("limit"), "unidade", "parametro_doc", "parametro")
        .mapInPandas(read, "cond_id long, ref_id long, source string, low double, high double")
    )
    # Both sides below are constants of a few hundred rows: the canonical list and the closure of the unit graph.
    common = [(r.ref_id, units.unit_key(r.unidade_comum)) for r in vocabulary.small_rows(parameters)]
    targets = spark.createDataFrame(common, "ref_id long, target string")
    convert = lambda c: F.col(c) * F.col("scale") + F.col("offset")
    same = F.col("source") == F.col("target")
    return (
        single.join(F.broadcast(targets), "ref_id")
        .join(F.broadcast(units.conversion_table(spark)), ["source", "target"], "left")
        .select(
            "cond_id",
            "ref_id",
            "source",
            "target",
            F.when(same, F.col("low")).otherwise(convert("low")).alias("low"),
            F.when(same, F.col("high")).otherwise(convert("high")).alias("high"),
        )
    )


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Limits written in another unit than the parameter's common one, in thousandths of the common unit."""
    return (
        common_units(spark, folder)
        .where((F.col("source") != F.col("target")) & F.col("low").isNotNull())
        .select(
            "cond_id", units.thousandths(F.col("low")).alias("min_milesimos"), units.thousandths(F.col("high")).alias("max_milesimos")
        )
    )


def p5_unconnected(spark: SparkSession, folder: str) -> DataFrame:
    """Unit pairs that occur without a conversion: source, target, n_linhas."""
    return (
        common_units(spark, folder)
        .where(F.col("low").isNull())
        .groupBy("source", "target")
        .agg(F.count("*").alias("n_linhas"))
    )


QUERIES = {
    "p2_found": p2_found,
    "p2_sizes": p2_sizes,
    "p5_found": p5_found,
    "p5_unconnected": p5_unconnected,
    "p7_found": p7_found,
}

#: Queries that SQL can state over whole tables; the others are held against brute force in the tests.
ORACLES: dict[str, str] = {
    "p7_found": f"""WITH dates AS (SELECT file_name, {sql.date("data_de_inicio")} AS a, {sql.date("data_de_validade")} AS b FROM dados_gerais),
    iv AS (SELECT DISTINCT l.codmaximo, a, b FROM licenses l JOIN dates USING (file_name) WHERE {sql.filled("l.codmaximo")} AND a <= b),
    m AS (SELECT *, max(b) OVER (PARTITION BY codmaximo ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM iv),
    g AS (SELECT *, sum(CASE WHEN reached IS NULL OR a > reached + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY codmaximo ORDER BY a, b) AS island FROM m),
    p AS (SELECT codmaximo, island, min(a) AS a, max(b) AS b FROM g GROUP BY 1, 2), n AS (SELECT *, lead(a) OVER (PARTITION BY codmaximo ORDER BY a) AS next FROM p)
    SELECT codmaximo, 'periodo' AS tipo, CAST(a AS VARCHAR) AS inicio, CAST(b AS VARCHAR) AS fim FROM p
    UNION ALL SELECT codmaximo, 'lacuna', CAST(b + 1 AS VARCHAR), CAST(next - 1 AS VARCHAR) FROM n WHERE next IS NOT NULL""",
}
