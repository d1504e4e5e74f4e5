"""Queries over conditions, self-monitoring, documents and events, each with its SQL where SQL can state it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudalix.functions import numbers as N
from caudalix.functions import parameters as P
from caudalix.functions import text as X
from caudalix.functions.placeholders import filled
from caudalix.operators import citations, columns, compare, criteria, lookups, measures, parsing, quality, records
from caudalix.operators.skew import salted_join
from caudalix.plans import sql
from caudalix.plans.licences import _versions, _VERSIONS
from caudalix.sources.documents import license_flags_text
from caudalix.session import cut, shared_folder
from caudalix.sources.tables import table
from caudalix.streaming import inbox

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


_NAME = "regexp_replace({c}, '[^a-z0-9]+', '', 'g')".format(c=sql.fold("coalesce(x, '')"))
_COLLAPSED = "trim(regexp_replace(coalesce(parametro_doc, ''), '\\s+', ' ', 'g'))"


@query(
    f"""WITH t AS (SELECT cond_id, {_COLLAPSED} AS text FROM conditions), b AS (SELECT *, regexp_replace(text, '(?i)\\(\\s*per[íi]odo de estiagem\\s*\\)', ' ', 'g') AS bare FROM t),
    p AS (SELECT cond_id, text, contains({_NAME.replace("coalesce(x, '')", 'text')}, 'estiagem') AS dry, coalesce(list_extract(regexp_extract_all(bare, '\\(([^()]*)\\)', 1), -1), '') AS u,
      regexp_replace(trim(regexp_replace(regexp_replace(bare, '\\([^()]*\\)', ' ', 'g'), '\\s+', ' ', 'g')), '^[ –—-]+|[ –—-]+$', '', 'g') AS name FROM b)
    SELECT cond_id, CASE WHEN text = '' THEN '' ELSE {sql.contains_case(_NAME.replace("coalesce(x, '')", 'name'), P.SHORT_CODES, "trim(regexp_replace(name, '\\s+', ' ', 'g'))")} END AS codigo,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(u, '\\s+', ' ', 'g')), '(?i)\\bmg/l\\b', 'mg/L', 'g'), '(?i)\\bml\\b', 'mL', 'g'), '(?i)\\bufc\\b', 'ufc', 'g'), '(?i)\\bm3\\b', 'm³', 'g') AS unidade,
    CASE WHEN dry THEN 'Estiagem' ELSE 'Normal' END AS periodo FROM p"""
)
def split_parameter(spark, folder):
    """Short code, unit and period out of the parameter as written."""
    code, unit, period = P.split_parameter(F.col("parametro_doc"))
    return table(spark, folder, "conditions", "cond_id", "parametro_doc").select("cond_id", code.alias("codigo"), unit.alias("unidade"), period.alias("periodo"))


_F = sql.fold("coalesce(parametro_doc, '')")
_PADDED = "' ' || lower(regexp_replace(coalesce(parametro_doc, ''), '\\s+', ' ', 'g')) || ' '"


@query(
    f"""SELECT cond_id, CASE WHEN contains({_F}, 'bioqu') THEN 'CBO5' WHEN contains({_F}, 'quimica') OR {_F} = 'cqo' THEN 'CQO' WHEN contains({_F}, 'solidos') OR contains({_F}, 'suspenso') THEN 'SST'
    WHEN contains({_F}, 'oleos') OR contains({_F}, 'gordura') THEN 'O&G' WHEN contains({_F}, 'azoto') THEN 'N' WHEN contains({_F}, 'fosforo') THEN 'P' WHEN starts_with({_F}, 'ph') OR contains({_F}, 'sorensen') THEN 'pH' ELSE trim(parametro_doc) END AS laboratorio,
    {sql.contains_case(_PADDED, P.JOIN_KEYS, "trim(coalesce(parametro_doc, ''))[1:12]")} AS juncao,
    {sql.contains_case(_F, P.CATALOGUE, "coalesce(nullif(trim(parametro_doc), ''), 'Desconhecido')")} AS catalogo,
    {sql.contains_case("lower(coalesce(parametro_doc, ''))", P.COMPARED, "trim(coalesce(parametro_doc, ''))")} AS comparado,
    trim(split_part(coalesce(parametro_doc, ''), '(', 1)) AS base FROM conditions"""
)
def parameter_vocabularies(spark, folder):
    """The names of each parameter in the competing vocabularies."""
    c = F.col("parametro_doc")
    return table(spark, folder, "conditions", "cond_id", "parametro_doc").select(
        "cond_id", P.laboratory_key(c).alias("laboratorio"), P.join_key(c).alias("juncao"), P.catalogue_name(c).alias("catalogo"),
        P.compared_name(c).alias("comparado"), P.base_name(c).alias("base"),
    )


_DOT = "replace(vle, ',', '.')"
_RANGE = r"'(-?\d+(?:\.\d+)?)\s*(?:a|-|–|ate|até)\s*(-?\d+(?:\.\d+)?)'"


@query(
    f"""SELECT cond_id, CASE WHEN regexp_matches({_DOT}, {_RANGE}) THEN try_cast(regexp_extract({_DOT}, {_RANGE}, 1) AS DOUBLE) END AS minimo,
    CASE WHEN regexp_matches({_DOT}, {_RANGE}) THEN try_cast(regexp_extract({_DOT}, {_RANGE}, 2) AS DOUBLE) ELSE try_cast(regexp_extract({_DOT}, '-?\\d+(?:\\.\\d+)?', 0) AS DOUBLE) END AS maximo,
    CASE WHEN len(regexp_extract_all({_DOT}, '\\d+(?:\\.\\d+)?')) >= 2 AND regexp_matches({_DOT}, '-| a ') THEN regexp_extract_all({_DOT}, '\\d+(?:\\.\\d+)?')[1] ELSE '' END AS min_texto,
    coalesce(CASE WHEN len(regexp_extract_all({_DOT}, '\\d+(?:\\.\\d+)?')) >= 2 AND regexp_matches({_DOT}, '-| a ') THEN regexp_extract_all({_DOT}, '\\d+(?:\\.\\d+)?')[2] ELSE regexp_extract_all({_DOT}, '\\d+(?:\\.\\d+)?')[1] END, '') AS max_texto
    FROM conditions WHERE vle IS NOT NULL"""
)
def vle_bounds(spark, folder):
    """Lower and upper end of every limit, by both rules."""
    c = F.col("vle")
    (low, high), (low_t, high_t) = N.limit_bounds(c), N.limit_texts(c)
    rows = table(spark, folder, "conditions", "cond_id", "vle").where("vle is not null")
    return rows.select("cond_id", low.alias("minimo"), high.alias("maximo"), low_t.alias("min_texto"), high_t.alias("max_texto"))


@query(r"SELECT cond_id, regexp_replace(trim(regexp_replace(coalesce(vle, ''), '\s+', ' ', 'g')), '([\d,.])\s*a\s*([\d,.])', '\1 - \2', 'g') AS vle FROM conditions")
def clean_vle(spark, folder):
    """Ranges with a dash instead of the word."""
    return table(spark, folder, "conditions", "cond_id", "vle").select("cond_id", N.clean_limit(F.col("vle")).alias("vle"))


@query(
    "SELECT cond_id, " + ", ".join(f"CASE WHEN {c} IS NULL OR trim({c}) IN ({sql.values(sql.PLACEHOLDERS)}) THEN '' ELSE {c} END AS {c}" for c in ("vle", "unidade", "observacoes", "carga_max_admissivel")) + " FROM conditions"
)
def placeholder_clean(spark, folder):
    """Placeholders and nulls as empty text."""
    return columns.placeholders_emptied(table(spark, folder, "conditions", "cond_id", "vle", "unidade", "observacoes", "carga_max_admissivel"))


@query("SELECT ac_id, string_split(tipo_amostragem, '(')[1] AS tipo, string_split(tipo_amostragem, '(')[2] AS marca FROM autocontrolo WHERE tipo_amostragem IS NOT NULL")
def split_column_two_parts(spark, folder):
    """Sampling type and its marker as two columns."""
    first, second = X.split_two(F.col("tipo_amostragem"), "(")
    return table(spark, folder, "autocontrolo", "ac_id", "tipo_amostragem").where("tipo_amostragem is not null").select("ac_id", first.alias("tipo"), second.alias("marca"))


NOTE = "(i) com intervalos máximos de 1 hora; (ii) proporcional ao caudal; (iii) de 24 horas; (iv) no ponto de saída. Outras notas"
_PHRASES = [("i", "(i) com intervalos máximos de 1 hora"), ("ii", "(ii) proporcional ao caudal"), ("iii", "(iii) de 24 horas"), ("iv", "(iv) no ponto de saída")]


@query(
    "SELECT cond_id, CASE regexp_extract(coalesce(tipo_amostragem, ''), '\\(([ivx]+)\\)', 1) " + " ".join(f"WHEN '{m}' THEN {sql.quoted(p)}" for m, p in _PHRASES) + " ELSE '' END AS nota FROM conditions"
)
def sampling_notes(spark, folder):
    """The phrase of the footnote that each sampling type's marker points at."""
    rows = table(spark, folder, "conditions", "cond_id", "tipo_amostragem")
    return rows.select("cond_id", X.sampling_note(F.col("tipo_amostragem"), F.lit(NOTE)).alias("nota"))


_LEGAL = lambda c: (
    f"regexp_replace(regexp_replace(regexp_replace({sql.identity(f'translate({c}, {sql.quoted(chr(0xBA) + chr(0xAA))}, {sql.quoted(chr(111) + chr(97))})')}, 'n\\.?\\s*[o°]\\s*', 'n', 'g'), '\\s*([.,;:])\\s*', '\\1', 'g'), '[\\s.,;:]+$', '')"
)


@query(
    f"""SELECT substr(sha1({_LEGAL('legislacao_aplicavel')} || chr(31) || {_LEGAL('avaliacao_conformidade_legal')}), 1, 16) AS chave, count(*) AS n, min(cond_id) AS exemplo FROM conditions GROUP BY 1"""
)
def distinct_text_pairs(spark, folder):
    """The distinct pairs of comparable legal texts, how often each occurs, and an example."""
    cols = ["legislacao_aplicavel", "avaliacao_conformidade_legal"]
    return compare.text_pairs(table(spark, folder, "conditions", "cond_id", *cols), cols, "cond_id")


@query(
    f"""SELECT substr(sha1({_LEGAL('legislacao_aplicavel')} || chr(31) || {_LEGAL('avaliacao_conformidade_legal')}), 1, 16) AS chave, count(*) AS n, min(cond_id) AS exemplo, 'PENDENTE' AS resposta FROM conditions GROUP BY 1"""
)
def text_pairs_pending(spark, folder):
    """The text pairs with their stored answers; without a store all are pending."""
    answers = spark.createDataFrame([], "chave string, resposta string")
    return compare.answered(distinct_text_pairs(spark, folder), answers)


@query(
    """SELECT parametro, count(*) AS uso, count(DISTINCT vle) AS limites, array_to_string(list_sort(list(DISTINCT origem)), ' ; ') AS origens FROM conditions WHERE parametro IS NOT NULL GROUP BY 1"""
)
def usage_counts_concat(spark, folder):
    """Use of each code, its distinct limits and the sources it comes from."""
    rows = table(spark, folder, "conditions", "parametro", "vle", "origem").where("parametro is not null")
    return rows.groupBy("parametro").agg(
        F.count("*").alias("uso"), F.count_distinct("vle").alias("limites"), F.array_join(F.sort_array(F.collect_set("origem")), " ; ").alias("origens")
    )


@query("WITH p AS (SELECT DISTINCT parametro_doc, parametro FROM conditions) SELECT parametro_doc, count(*) AS n_valores FROM p GROUP BY 1 HAVING count(*) > 1")
def functional_dependency_check(spark, folder):
    """Parameter names that come with more than one code."""
    return records.dependency_violations(table(spark, folder, "conditions", "parametro_doc", "parametro"), "parametro_doc", "parametro")


@query("SELECT cond_id, n_tua, row_number() OVER (PARTITION BY n_tua ORDER BY cond_id) AS ordem FROM conditions")
def ordinal_in_group(spark, folder):
    """Each condition's position inside its licence, also in the collective one."""
    return records.ordinals(table(spark, folder, "conditions", "cond_id", "n_tua"), ["n_tua"], ["cond_id"])


@query("SELECT event_id, ((row_number() OVER (ORDER BY event_id) - 1) // 10)::BIGINT AS lote FROM events")
def batches_of_ten(spark, folder):
    """Events in batches of ten, in order."""
    numbered = records.ordinals(table(spark, folder, "events", "event_id"), [], ["event_id"], "n")
    return numbered.select("event_id", F.floor((F.col("n") - 1) / 10).cast("bigint").alias("lote"))


def _flat(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conditions", "cond_id", "n_tua", "origem", "parametro_doc", "parametro", "vle", "observacoes", "legislacao_aplicavel", "avaliacao_conformidade_legal")
    return rows.select(
        F.col("cond_id").alias("row_id"), F.coalesce("n_tua", F.lit("")).alias("licenca"), F.col("origem").alias("estabelecimento"), "parametro_doc",
        P.catalogue_name(F.col("parametro_doc")).alias("parametro"), "vle", F.col("observacoes").alias("nota"), F.col("legislacao_aplicavel").alias("legislacao"),
        F.col("avaliacao_conformidade_legal").alias("avaliacao"), *criteria.flags(F.col("avaliacao_conformidade_legal")),
    )


_T = sql.fold("coalesce(avaliacao_conformidade_legal, '')")
_FLAG_SQL = {
    "f_vle": "1",
    "f_reducao": "0",
    "f_gama": f"(regexp_matches(t, '5[.,]0\\s*-?\\s*10[.,]0') OR contains(t, 'nenhuma amostra'))::INT",
    "f_dobro": "(contains(t, 'dobro do vle') OR contains(t, '100%') OR contains(t, 'mais de 100') OR ((contains(t, 'artigo 69') OR contains(t, 'art. 69') OR (contains(t, 'artigo n') AND contains(t, '69'))) AND NOT contains(t, '152/97')))::INT",
    "f_150": "contains(t, '150%')::INT",
    "f_ordem": "contains(t, 'ordem de grandeza')::INT",
    "f_mensal": "contains(t, 'media mensal')::INT",
    "f_anual": "contains(t, 'media anual')::INT",
    "f_quadro": "(contains(t, '152/97') AND (contains(t, 'amostras nao conformes') OR contains(t, 'minimo anual de amostras') OR contains(t, 'quadro n') OR contains(t, 'alinea d')))::INT",
}
_FLAGGED = f"flagged AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in _FLAG_SQL.items())} FROM (SELECT *, {_T} AS t FROM conditions))"


@query(f"WITH {_FLAGGED} SELECT cond_id, {', '.join(criteria.FLAGS)} FROM flagged")
def classify_flags(spark, folder):
    """The nine flags of each assessment."""
    rows = table(spark, folder, "conditions", "cond_id", "avaliacao_conformidade_legal")
    return rows.select("cond_id", *criteria.flags(F.col("avaliacao_conformidade_legal")))


_CAT = sql.contains_case(_F, P.CATALOGUE, "coalesce(nullif(trim(parametro_doc), ''), 'Desconhecido')")
_SLUG = f"CASE WHEN regexp_replace({sql.fold('parametro')}, '[^a-z0-9]+', '', 'g') = '' THEN 'PARAM' ELSE upper(regexp_replace(regexp_replace({sql.fold('parametro')}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) END"


@query(
    f"""WITH {_FLAGGED}, rules AS (SELECT {_CAT} AS parametro, coalesce(vle, '') AS vle, {', '.join(criteria.FLAGS)}, count(*) AS uso FROM flagged GROUP BY ALL),
    k AS (SELECT *, {_SLUG} AS slug, replace(trim(vle), ',', '.') AS v FROM rules), s AS (SELECT *, regexp_matches(v, '^\\d+(?:\\.\\d+)?$') AS isn FROM k)
    SELECT 'LIC_' || slug || '_' || row_number() OVER (PARTITION BY slug ORDER BY encode(parametro), CASE WHEN isn THEN 0 ELSE 1 END, CASE WHEN isn THEN try_cast(v AS DOUBLE) ELSE 0 END, encode(CASE WHEN isn THEN '' ELSE v END), encode(vle), {', '.join(criteria.FLAGS)}) AS id_criterio, parametro, vle, uso FROM s"""
)
def rule_numbering(spark, folder):
    """The rule catalogue with its numbers."""
    return criteria.normalise(_flat(spark, folder), "LIC").catalogue.select("id_criterio", "parametro", "vle", "uso")


@query(
    """WITH t AS (SELECT coalesce(legislacao_aplicavel, '') AS legislacao, coalesce(avaliacao_conformidade_legal, '') AS avaliacao, count(*) AS uso FROM conditions GROUP BY ALL)
    SELECT 'LIC_TX' || CASE WHEN n < 100 THEN lpad(n::VARCHAR, 2, '0') ELSE n::VARCHAR END AS id_texto, legislacao, avaliacao, uso FROM (SELECT *, row_number() OVER (ORDER BY encode(legislacao), encode(avaliacao)) AS n FROM t)"""
)
def text_numbering(spark, folder):
    """The text dimension with its numbers over the whole table."""
    return criteria.normalise(_flat(spark, folder), "LIC").texts


@query(f"WITH {_FLAGGED} SELECT cond_id AS row_id, coalesce(n_tua, '') AS licenca, coalesce(parametro_doc, '') AS parametro_doc, {_CAT} AS parametro, coalesce(vle, '') AS vle, coalesce(legislacao_aplicavel, '') AS legislacao, coalesce(avaliacao_conformidade_legal, '') AS avaliacao, {', '.join(criteria.FLAGS)} FROM flagged")
def flatten_star_roundtrip(spark, folder):
    """The star taken apart and put together again gives every row back."""
    return criteria.flatten(criteria.normalise(_flat(spark, folder), "LIC")).drop("estabelecimento", "nota")


@query("SELECT * FROM (VALUES ('factos sem criterio', 0::BIGINT), ('factos sem texto', 0), ('criterios sem uso', 0), ('textos sem uso', 0), ('usos a mais ou a menos', 0)) v(verificacao, n)")
def star_integrity(spark, folder):
    """Orphans, unused members and uses of the star; all zero."""
    return criteria.integrity(criteria.normalise(_flat(spark, folder), "LIC"))


# What the report calls the flags.
FLAG_LABELS = {"f_dobro": "até ao dobro do VLE", "f_mensal": "média mensal", "f_anual": "média anual", "f_ordem": "uma ordem de grandeza", "f_gama": "gama de valores"}


@query(
    f"""WITH {_FLAGGED}, s AS (SELECT n_tua, {', '.join(f'sum({f}) AS {f}' for f in FLAG_LABELS)} FROM flagged WHERE n_tua IS NOT NULL GROUP BY 1)
    SELECT n_tua, array_to_string(list_filter([{', '.join(f"CASE WHEN {f} >= 1 THEN {sql.quoted('• ' + t)} END" for f, t in FLAG_LABELS.items())}], lambda v: v IS NOT NULL), chr(10)) AS criterios,
    ({' + '.join(FLAG_LABELS)})::BIGINT AS n FROM s"""
)
def criteria_to_meet(spark, folder):
    """The criteria each licence has to meet as a bullet list, and how many flags are set in all."""
    rows = table(spark, folder, "conditions", "n_tua", "avaliacao_conformidade_legal").where("n_tua is not null")
    flagged = rows.select("n_tua", *criteria.flags(F.col("avaliacao_conformidade_legal")))
    total = F.sum(sum((F.col(f) for f in FLAG_LABELS), F.lit(0)))
    return flagged.groupBy("n_tua").agg(license_flags_text(list(FLAG_LABELS), FLAG_LABELS).alias("criterios"), total.alias("n"))


@query(
    f"""WITH x AS (SELECT cond_id, {_T} AS t FROM conditions), y AS (SELECT *, length(t) < 6 AS s, regexp_matches(t, 'artigo 69') AND regexp_matches(t, 'n\\.?\\s*o?\\s*6') AS a,
    contains(t, 'alinea d') OR (contains(t, 'nenhuma amostra excede') AND contains(t, '100')) AS b FROM x), z AS (SELECT *, contains(t, 'anexo xviii') AND NOT a AND NOT b AS law FROM y)
    SELECT cond_id, (a AND NOT s AND NOT law)::INT AS mensal, ((a OR b) AND NOT s AND NOT law)::INT AS dobro, (b AND (contains(t, 'relacao estatistica') OR contains(t, 'quadro') OR contains(t, 'alinea d')) AND NOT s AND NOT law)::INT AS quadro,
    CASE WHEN s THEN '' WHEN law THEN 'só legislação' WHEN a OR b THEN 'derivado' ELSE 'sem critério' END AS estado FROM z"""
)
def licence_text_flags(spark, folder):
    """The flags and state of an assessment by the second regime's rules."""
    rows = table(spark, folder, "conditions", "cond_id", "avaliacao_conformidade_legal")
    return rows.select("cond_id", *criteria.licence_flags(F.col("avaliacao_conformidade_legal")))


@query("SELECT n_tua, count(*) AS linhas FROM conditions WHERE n_tua IS NOT NULL AND n_tua NOT IN (SELECT n_tua FROM licenses WHERE n_tua IS NOT NULL) GROUP BY 1")
def referential_orphans(spark, folder):
    """Conditions whose licence number no licence has."""
    counts = table(spark, folder, "conditions", "n_tua").where("n_tua is not null").groupBy("n_tua").agg(F.count("*").alias("linhas"))
    return counts.join(table(spark, folder, "licenses", "n_tua").distinct(), "n_tua", "left_anti")


@query(
    """WITH f AS (SELECT valor, analises_ano FROM ref_valores WHERE lista = 'frequencia') SELECT a.ac_id, f.analises_ano FROM autocontrolo a LEFT JOIN f ON trim(a.frequencia_amostragem) = f.valor"""
)
def left_join_enrich_many_one(spark, folder):
    """Analyses a year by the frequency as written."""
    f = table(spark, folder, "ref_valores", "ref_id", "lista", "valor", "analises_ano").where("lista = 'frequencia'").withColumnRenamed("valor", "freq")
    rows = table(spark, folder, "autocontrolo", "ac_id", "frequencia_amostragem").withColumn("freq", F.trim("frequencia_amostragem"))
    return lookups.many_to_one(rows, f, ["freq"], ["ref_id"], ["analises_ano"], "ac_id").select("ac_id", "analises_ano")


@query(
    """WITH f AS (SELECT valor, analises_ano FROM ref_valores WHERE lista = 'frequencia'), s AS (SELECT DISTINCT a.file_name, a.parametro_doc, a.frequencia_amostragem, coalesce(f.analises_ano, 0) AS n FROM autocontrolo a LEFT JOIN f ON a.frequencia_amostragem = f.valor),
    fm AS (SELECT file_name, parametro_doc, metodo_analitico FROM autocontrolo WHERE trim(metodo_analitico) <> '' QUALIFY row_number() OVER (PARTITION BY file_name, parametro_doc ORDER BY ac_id) = 1)
    SELECT s.file_name, s.parametro_doc, sum(n)::BIGINT AS analises, any_value(m.metodo_analitico) AS metodo FROM s LEFT JOIN fm m ON m.file_name IS NOT DISTINCT FROM s.file_name AND m.parametro_doc IS NOT DISTINCT FROM s.parametro_doc GROUP BY 1, 2"""
)
def preagg_signature_dedupe(spark, folder):
    """Analyses a year per file and parameter, each frequency once, with the first method named."""
    rows = table(spark, folder, "autocontrolo", "ac_id", "file_name", "parametro_doc", "frequencia_amostragem", "metodo_analitico")
    f = table(spark, folder, "ref_valores", "lista", "valor", "analises_ano").where("lista = 'frequencia'").select(F.col("valor").alias("frequencia_amostragem"), "analises_ano")
    # One aggregate: the distinct frequencies of a key are few, the list of frequencies is the fixed table.
    method = F.min(F.when(F.trim("metodo_analitico") != "", F.struct("ac_id", "metodo_analitico")))
    kinds = rows.groupBy("file_name", "parametro_doc", "frequencia_amostragem").agg(method.alias("m"))
    joined = kinds.join(f, "frequencia_amostragem", "left")
    return joined.groupBy("file_name", "parametro_doc").agg(F.sum(F.coalesce("analises_ano", F.lit(0))).cast("bigint").alias("analises"), F.min("m").alias("m")).select(
        "file_name", "parametro_doc", "analises", F.col("m.metodo_analitico").alias("metodo")
    )


@query(
    """WITH c AS (SELECT file_name, parametro, periodo, vle, cond_id FROM conditions WHERE file_name IS NOT NULL AND parametro IS NOT NULL AND periodo IS NOT NULL), u AS (SELECT file_name, parametro, periodo, vle FROM c QUALIFY row_number() OVER (PARTITION BY file_name, parametro, periodo ORDER BY cond_id)=1),
    asked AS (SELECT DISTINCT file_name, parametro, p AS periodo FROM u, (VALUES ('Normal'), ('Estiagem')) t(p))
    SELECT a.file_name, a.parametro, a.periodo, CASE WHEN o.file_name IS NOT NULL THEN o.vle ELSE n.vle END AS vle FROM asked a LEFT JOIN u o USING (file_name, parametro, periodo)
    LEFT JOIN u n ON n.file_name=a.file_name AND n.parametro=a.parametro AND n.periodo='Normal'"""
)
def period_fallback_join(spark, folder):
    """The limit of each file, parameter and period; without one of its own a period takes the normal one."""
    c = table(spark, folder, "conditions", "cond_id", "file_name", "parametro", "periodo", "vle").where("file_name is not null and parametro is not null and periodo is not null")
    unique = records.pick(c, ["file_name", "parametro", "periodo"], [F.col("cond_id")], ["file_name", "parametro", "periodo", "vle"])
    asked = unique.select("file_name", "parametro").distinct().withColumn("periodo", F.explode(F.array(F.lit("Normal"), F.lit("Estiagem"))))
    return lookups.with_fallback(asked, unique, ["file_name", "parametro"], "periodo", "Normal", ["vle"])


@query("SELECT file_name, count(DISTINCT parametro) AS parametros, count(*) AS linhas, arg_max(ponto, cond_id) AS ponto FROM conditions WHERE file_name IS NOT NULL GROUP BY 1")
def plant_summary(spark, folder):
    """Parameters and rows per document, with the last row's point."""
    rows = table(spark, folder, "conditions", "cond_id", "file_name", "parametro", "ponto").where("file_name is not null")
    # The last row's point even where it is null in an earlier one.
    return rows.groupBy("file_name").agg(F.count_distinct("parametro").alias("parametros"), F.count("*").alias("linhas"), F.max_by("ponto", F.when(F.col("ponto").isNotNull(), F.col("cond_id"))).alias("ponto"))


@query("SELECT file_name, string_agg(trim(parametro), chr(10) || chr(10) ORDER BY cond_id) AS texto FROM conditions WHERE file_name IS NOT NULL AND parametro IS NOT NULL GROUP BY 1")
def string_agg_group(spark, folder):
    """The codes of each document in one text, in order."""
    rows = table(spark, folder, "conditions", "cond_id", "file_name", "parametro").where("file_name is not null and parametro is not null")
    ordered = F.array_sort(F.collect_list(F.struct("cond_id", F.trim("parametro").alias("p"))))
    return rows.groupBy("file_name").agg(F.array_join(F.transform(ordered, lambda x: x["p"]), "\n\n").alias("texto"))


@query(
    """WITH a AS (SELECT DISTINCT parametro AS p FROM conditions WHERE parametro IS NOT NULL), b AS (SELECT DISTINCT parametro_doc AS p FROM autocontrolo WHERE parametro_doc IS NOT NULL), c AS (SELECT DISTINCT codigo AS p FROM ref_valores WHERE codigo IS NOT NULL),
    u AS (SELECT p FROM a UNION SELECT p FROM b UNION SELECT p FROM c) SELECT p AS parametro, p IN (SELECT p FROM a) AS em_condicoes, p IN (SELECT p FROM b) AS em_autocontrolo, p IN (SELECT p FROM c) AS na_lista FROM u"""
)
def dimension_from_three_facts(spark, folder):
    """The parameter dimension out of three tables, with where each occurs: one pass and one aggregate."""
    parts = [("conditions", "parametro", "em_condicoes"), ("autocontrolo", "parametro_doc", "em_autocontrolo"), ("ref_valores", "codigo", "na_lista")]
    out = None
    for name, column, flag in parts:
        rows = table(spark, folder, name, column).where(F.col(column).isNotNull()).select(F.col(column).alias("parametro"), *[F.lit(flag == f).alias(f) for _, _, f in parts])
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("parametro").agg(*[F.bool_or(f).alias(f) for _, _, f in parts])


@query("WITH s AS (SELECT file_name, count(*) AS k FROM conditions GROUP BY 1) SELECT count(*) AS grupos, count(DISTINCT k) AS tamanhos, count(DISTINCT k) <= 1 AS uniforme FROM s")
def uniform_group_size(spark, folder):
    """Whether all documents have the same number of conditions."""
    return quality.uniform_groups(table(spark, folder, "conditions", "file_name"), "file_name")


@query("SELECT count(*) AS linhas, count(DISTINCT file_name) AS documentos FROM conditions WHERE parametro IN (SELECT codigo FROM ref_valores WHERE unidade_comum = 'mg/L')")
def semijoin_treatas(spark, folder):
    """Conditions under a filter carried over from the list: parameters measured in mg/L."""
    ref = table(spark, folder, "ref_valores", "codigo", "unidade_comum").where("unidade_comum = 'mg/L'")
    rows = measures.restricted(table(spark, folder, "conditions", "parametro", "file_name"), "parametro", ref, "codigo")
    return measures.evaluate(rows, [], {"linhas": F.count("*"), "documentos": F.count_distinct("file_name")})


@query("SELECT tua_lurh, count(*) AS n FROM licenses WHERE file_name IN (SELECT file_name FROM conditions WHERE contains(lower(observacoes), 'medidor de caudal')) GROUP BY 1")
def cross_filter_both_ways(spark, folder):
    """Licences found by a text search in their conditions."""
    hits = table(spark, folder, "conditions", "file_name", "observacoes").where(F.lower("observacoes").contains("medidor de caudal"))
    return measures.restricted(table(spark, folder, "licenses", "file_name", "tua_lurh"), "file_name", hits, "file_name").groupBy("tua_lurh").agg(F.count("*").alias("n"))


# The words the priority report looks for, folded.
KEYWORDS = ("desinfecao", "emergencia", "periodo de estiagem", "odor", "laboratorio", "lamas", "avaria")


@query(
    f"""WITH x AS (SELECT cond_id, {sql.fold('observacoes')} AS t FROM conditions WHERE {sql.filled('observacoes')}), h AS (SELECT cond_id, list_filter([{', '.join(f"CASE WHEN contains(t, '{k}') THEN '{k}' END" for k in sorted(KEYWORDS))}], lambda v: v IS NOT NULL) AS hits FROM x)
    SELECT cond_id, array_to_string(hits, '; ') AS palavras FROM h WHERE len(hits) > 0"""
)
def keyword_hits(spark, folder):
    """The clauses with a word of the fixed list."""
    from caudalix.functions.fold import fold_ascii

    rows = table(spark, folder, "conditions", "cond_id", "observacoes").where(filled(F.col("observacoes"))).select("cond_id", fold_ascii(F.col("observacoes")).alias("t"))
    hits = F.filter(F.array(*[F.lit(k) for k in sorted(KEYWORDS)]), lambda k: F.col("t").contains(k))
    return rows.select("cond_id", F.array_join(hits, "; ").alias("palavras")).where("palavras <> ''")


_ACT_NAME = f"CASE {' '.join(f"WHEN regexp_matches(tok, '(?i)^(?:{p})') THEN {sql.quoted(short)}" for p, short, _ in citations.KINDS)} END || ' ' || regexp_replace(regexp_extract(tok, '{citations.NUMBER}$'), '{X.WHITE}+', '', 'g')"


@query(
    f"""WITH d AS (SELECT cond_id, coalesce(legislacao_aplicavel, '') AS t FROM conditions), m AS (SELECT cond_id, regexp_replace(regexp_replace(t, '(?i)({citations.CLOSES})', '⟧\\1', 'g'), '(?i){citations.OPENS}', '⟦', 'g') AS t FROM d),
    k AS (SELECT cond_id, unnest(x) AS tok, generate_subscripts(x, 1) AS i FROM (SELECT cond_id, regexp_extract_all(t, '(?i)⟦|⟧|{citations.ACT}|{citations.NUMBER}') AS x FROM m)),
    s AS (SELECT *, coalesce(last_value(CASE WHEN tok IN ('⟦', '⟧') THEN tok END IGNORE NULLS) OVER (PARTITION BY cond_id ORDER BY i), '⟧') = '⟦' AS clause FROM k),
    a AS (SELECT cond_id, name, min(i) AS i FROM (SELECT cond_id, i, {_ACT_NAME} AS name FROM s WHERE NOT clause AND tok NOT IN ('⟦', '⟧')) WHERE name IS NOT NULL GROUP BY ALL),
    n AS (SELECT cond_id, i, 'DL ' || regexp_replace(regexp_extract(tok, '{citations.NUMBER}$'), '{X.WHITE}+', '', 'g') AS am FROM s WHERE clause AND tok NOT IN ('⟦', '⟧')),
    o AS (SELECT DISTINCT n.cond_id, n.am, coalesce(arg_max(a.name, a.i) FILTER (WHERE a.i < n.i), arg_min(a.name, a.i)) AS owner FROM n JOIN a USING (cond_id) GROUP BY n.cond_id, n.i, n.am),
    f AS (SELECT cond_id, string_agg(name, ' | ' ORDER BY i) AS diplomas FROM a GROUP BY 1), g AS (SELECT cond_id, count(*) AS alteracoes FROM o WHERE am <> owner GROUP BY 1)
    SELECT cond_id, coalesce(diplomas, '') AS diplomas, coalesce(alteracoes, 0) AS alteracoes FROM d LEFT JOIN f USING (cond_id) LEFT JOIN g USING (cond_id)"""
)
def legal_citations(spark, folder):
    """Citations of each condition: short forms, and how many amendments they carry."""
    rows = table(spark, folder, "conditions", "cond_id", "legislacao_aplicavel")
    # A row of one array, so that the optimizer does not copy the fold to each of its uses.
    found = rows.select("cond_id", F.explode(F.array(citations.citations(F.col("legislacao_aplicavel")))).alias("c"))
    amended = F.aggregate("c", F.lit(0), lambda n, x: n + F.size(x["alteracoes"]))
    return found.select("cond_id", citations.flat(F.col("c")).alias("diplomas"), amended.cast("bigint").alias("alteracoes"))


@query(
    f"""WITH {_VERSIONS}, d AS (SELECT * FROM versions WHERE codmaximo IS NOT NULL AND inicio IS NOT NULL), o AS (SELECT codmaximo, lic_id, file_name FROM d QUALIFY row_number() OVER (PARTITION BY codmaximo ORDER BY inicio, lic_id)=1),
    n AS (SELECT codmaximo, lic_id, file_name FROM d QUALIFY row_number() OVER (PARTITION BY codmaximo ORDER BY inicio DESC, lic_id DESC)=1), p AS (SELECT o.codmaximo, o.file_name AS fo, n.file_name AS fn FROM o JOIN n USING (codmaximo) WHERE o.lic_id <> n.lic_id),
    c AS (SELECT file_name, parametro, vle, legislacao_aplicavel FROM conditions WHERE parametro IS NOT NULL AND periodo = 'Normal' QUALIFY row_number() OVER (PARTITION BY file_name, parametro ORDER BY cond_id)=1),
    a AS (SELECT codmaximo, parametro, vle, legislacao_aplicavel AS t FROM p JOIN c ON c.file_name=fo), b AS (SELECT codmaximo, parametro, vle, legislacao_aplicavel AS t FROM p JOIN c ON c.file_name=fn)
    SELECT codmaximo, parametro, coalesce(a.vle, '') AS vle_antigo, coalesce(b.vle, '') AS vle_novo, CASE WHEN b.codmaximo IS NULL THEN 'removido' WHEN a.codmaximo IS NULL THEN 'novo' WHEN {_LEGAL('a.t')} <> {_LEGAL('b.t')} THEN 'a confirmar' ELSE 'provável sem alteração' END AS estado
    FROM a FULL JOIN b USING (codmaximo, parametro)"""
)
def full_outer_compare(spark, folder):
    """Oldest against newest licence of each asset, parameter by parameter, by limits and legal texts alone."""
    return _old_and_new(spark, folder, lambda text: F.lit(None).cast("array<string>")).drop("mais", "menos")


def _old_and_new(spark: SparkSession, folder: str, criterios) -> DataFrame:
    """Oldest against newest licence of each asset; ``criterios`` makes the criteria of an assessment text."""
    v = _versions(spark, folder)
    pairs = compare.oldest_and_newest(v, "codmaximo", "inicio", "lic_id")
    files = v.select("lic_id", "file_name")
    names = ["file_name", "parametro", "vle", "legislacao_aplicavel", "avaliacao_conformidade_legal"]
    c = table(spark, folder, "conditions", "cond_id", "periodo", *names).where("parametro is not null and periodo = 'Normal' and file_name is not null")
    c = records.pick(c, ["file_name", "parametro"], [F.col("cond_id")], names)

    def side(which: str) -> DataFrame:
        own = pairs.join(files, pairs[which] == files["lic_id"]).select("codmaximo", "file_name")
        return own.join(c, "file_name").select("codmaximo", "parametro", "vle", F.col("legislacao_aplicavel").alias("texto"), criterios(F.col("avaliacao_conformidade_legal")).alias("criterios"))

    return compare.compared(side("antiga"), side("nova"), ["codmaximo", "parametro"])


_LESS = lambda a, b: f"coalesce(array_to_string(list_sort(list_filter({a}, lambda x: NOT list_contains({b}, x))), '; '), '')"
_LABELS = ", ".join(f"CASE WHEN {n} = 1 THEN '{label}' END" for n, label in zip(criteria.FLAGS, criteria.LABELS))


@query(
    f"""WITH {_VERSIONS}, {_FLAGGED}, d AS (SELECT * FROM versions WHERE codmaximo IS NOT NULL AND inicio IS NOT NULL), o AS (SELECT codmaximo, lic_id, file_name FROM d QUALIFY row_number() OVER (PARTITION BY codmaximo ORDER BY inicio, lic_id)=1),
    n AS (SELECT codmaximo, lic_id, file_name FROM d QUALIFY row_number() OVER (PARTITION BY codmaximo ORDER BY inicio DESC, lic_id DESC)=1), p AS (SELECT o.codmaximo, o.file_name AS fo, n.file_name AS fn FROM o JOIN n USING (codmaximo) WHERE o.lic_id <> n.lic_id),
    c AS (SELECT file_name, parametro, vle, legislacao_aplicavel, CASE WHEN {sql.filled('avaliacao_conformidade_legal')} THEN list_filter([{_LABELS}], lambda x: x IS NOT NULL) END AS crit FROM flagged WHERE parametro IS NOT NULL AND periodo = 'Normal' QUALIFY row_number() OVER (PARTITION BY file_name, parametro ORDER BY cond_id)=1),
    a AS (SELECT codmaximo, parametro, vle, legislacao_aplicavel AS t, crit FROM p JOIN c ON c.file_name=fo), b AS (SELECT codmaximo, parametro, vle, legislacao_aplicavel AS t, crit FROM p JOIN c ON c.file_name=fn)
    SELECT codmaximo, parametro, coalesce(a.vle, '') AS vle_antigo, coalesce(b.vle, '') AS vle_novo, CASE WHEN b.codmaximo IS NULL THEN 'removido' WHEN a.codmaximo IS NULL THEN 'novo' WHEN a.crit = b.crit THEN 'sem alteração' WHEN a.crit <> b.crit THEN 'altera'
    WHEN {_LEGAL('a.t')} <> {_LEGAL('b.t')} THEN 'a confirmar' ELSE 'provável sem alteração' END AS estado, {_LESS('b.crit', 'a.crit')} AS mais, {_LESS('a.crit', 'b.crit')} AS menos
    FROM a FULL JOIN b USING (codmaximo, parametro)"""
)
def criteria_compared(spark, folder):
    """Oldest against newest licence of each asset, parameter by parameter, with the criteria that came and went."""
    return _old_and_new(spark, folder, criteria.labels)


@query("SELECT file_name, 'dados' AS origem, localidade, '' AS ponto FROM dados_gerais WHERE localidade IS NOT NULL UNION ALL SELECT file_name, 'rejeicao', '', coalesce(designacao_da_rejeicao, '') FROM rejeicao")
def union_widen_schema(spark, folder):
    """Two tables under one schema, what one lacks empty."""
    a = table(spark, folder, "dados_gerais", "file_name", "localidade").where("localidade is not null").select("file_name", F.lit("dados").alias("origem"), "localidade")
    b = table(spark, folder, "rejeicao", "file_name", "designacao_da_rejeicao").select("file_name", F.lit("rejeicao").alias("origem"), F.col("designacao_da_rejeicao").alias("ponto"))
    return columns.union_widened(a, b)


@query(
    f"SELECT 'Condições' AS seccao, cond_id AS id, observacoes AS texto FROM conditions WHERE {sql.filled('observacoes')} UNION ALL SELECT 'Legislação', cond_id, legislacao_aplicavel FROM conditions WHERE {sql.filled('legislacao_aplicavel')} UNION ALL SELECT 'Documentos', doc_id, text FROM documents WHERE {sql.filled('text')} UNION ALL SELECT 'Autocontrolo', ac_id, metodo_analitico FROM autocontrolo WHERE {sql.filled('metodo_analitico')}"
)
def union_search_index(spark, folder):
    """Everything searchable in one table, with where it comes from."""
    sources = [("Condições", "conditions", "cond_id", "observacoes"), ("Legislação", "conditions", "cond_id", "legislacao_aplicavel"), ("Documentos", "documents", "doc_id", "text"), ("Autocontrolo", "autocontrolo", "ac_id", "metodo_analitico")]
    out = None
    for label, name, key, text in sources:
        rows = table(spark, folder, name, key, text).select(F.lit(label).alias("seccao"), F.col(key).alias("id"), F.col(text).alias("texto")).where(F.coalesce(~F.trim("texto").isin(*sql.PLACEHOLDERS), F.lit(False)))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, folder):
    """A number out of each event's JSON."""
    return table(spark, folder, "events", "event_id", "props").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


@query("SELECT doc_id, sha256(text) AS digest, count(*) OVER (PARTITION BY sha256(text)) AS copias, doc_id = min(doc_id) OVER (PARTITION BY sha256(text)) AS primeiro FROM documents WHERE text IS NOT NULL")
def content_duplicates(spark, folder):
    """Each document's digest, how many have the same, and whether it is the first."""
    rows = table(spark, folder, "documents", "doc_id", "text").where("text is not null").select("doc_id", F.sha2("text", 256).alias("digest"))
    groups = rows.groupBy("digest").agg(F.count("*").alias("copias"), F.min("doc_id").alias("_first"))
    return salted_join(rows, groups, ["digest"], "doc_id").select("doc_id", "digest", "copias", (F.col("doc_id") == F.col("_first")).alias("primeiro"))


@query(
    r"""WITH l AS (SELECT doc_id, unnest(string_split_regex(text, '\r\n|\r|\n')) AS t, generate_subscripts(string_split_regex(text, '\r\n|\r|\n'), 1) AS linha FROM documents WHERE text IS NOT NULL), f AS (SELECT doc_id, linha, trim(t) AS texto FROM l WHERE trim(t) <> '')
    SELECT doc_id, linha, CASE WHEN regexp_matches(texto, '^(?:\d+\.|Ref\.)\s') THEN texto ELSE last_value(CASE WHEN regexp_matches(texto, '^(?:\d+\.|Ref\.)\s') THEN texto END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY linha) END AS seccao FROM f"""
)
def section_membership(spark, folder):
    """The numbered heading each line of a document stands under."""
    lines = parsing.lines(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text")
    return parsing.sections(lines, "doc_id", r"^(?:\d+\.|Ref\.)\s").select("doc_id", "linha", "seccao")


# The labels of the documents.
LABELS = ("Ref.", "Nota:", "Ponto", "Note:", "Punto", "Remarque")


@query(
    f"""WITH l AS (SELECT doc_id, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS t, generate_subscripts(string_split_regex(text, '\\r\\n|\\r|\\n'), 1) AS linha FROM documents WHERE text IS NOT NULL),
    h AS (SELECT doc_id, linha, trim(t) AS texto, CASE {' '.join(f"WHEN starts_with({sql.fold('trim(t)')}, {sql.quoted(x.lower())}) THEN {sql.quoted(x)}" for x in sorted(LABELS, key=len, reverse=True))} END AS own FROM l WHERE trim(t) <> ''),
    b AS (SELECT *, last_value(CASE WHEN own IS NOT NULL THEN linha END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY linha) AS bloco, last_value(own IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY linha) AS rotulo FROM h),
    g AS (SELECT doc_id, rotulo, bloco, string_agg(CASE WHEN own IS NOT NULL THEN regexp_replace(substring(texto, length(own) + 1), '^\\s*[:.-]?\\s*', '') ELSE texto END, ' ' ORDER BY linha) AS valor FROM b WHERE bloco IS NOT NULL GROUP BY ALL)
    SELECT doc_id, rotulo, trim(arg_min(valor, bloco)) AS valor FROM g GROUP BY ALL"""
)
def labelled_values(spark, folder):
    """The text behind each known label of the documents."""
    lines = parsing.lines(table(spark, folder, "documents", "doc_id", "text"), "doc_id", "text")
    return parsing.labelled(lines, "doc_id", list(LABELS))


@query(
    r"""SELECT ac_id, array_to_string(list_transform(regexp_extract_all(coalesce(tipo_amostragem, ''), '\([a-z0-9]\)|T\d{6}'), lambda k: CASE k WHEN '(i)' THEN 'com intervalos máximos'
    WHEN '(a)' THEN 'diária' WHEN '(b)' THEN 'semanal' ELSE regexp_replace(k, '[()]', '', 'g') END), ' | ') AS nota FROM autocontrolo"""
)
def resolved_markers(spark, folder):
    """The legend texts that each sampling type's marker stands for."""
    rows = table(spark, folder, "autocontrolo", "ac_id", "tipo_amostragem")
    legend = parsing.legend(F.lit("(i) com intervalos máximos (a) diária (b) semanal"))
    return rows.select("ac_id", parsing.resolved(F.col("tipo_amostragem"), legend).alias("nota"))


_BARE = f"regexp_replace(t, '^{X.WHITE}+|{X.WHITE}+$', '', 'g')"


@query(
    f"""SELECT doc_id, trim(regexp_replace(array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda t: {_BARE} || CASE WHEN regexp_matches(t, '{X.WHITE}$') AND {_BARE} <> '' THEN ' ' ELSE '' END), ''), '{X.WHITE}+', ' ', 'g')) AS texto FROM documents"""
)
def dewrapped_texts(spark, folder):
    """Every document with its physical lines joined."""
    return table(spark, folder, "documents", "doc_id", "text").select("doc_id", X.dewrap(F.col("text")).alias("texto"))


_FR = "lower(trim(coalesce(frequencia_amostragem, '')))"


@query(
    f"""WITH x AS (SELECT ac_id, CASE WHEN {_FR} = '' THEN 'Não especificada' WHEN contains({_FR}, 'mensal') AND NOT contains({_FR}, 'semestral') THEN 'Mensal'
    ELSE {sql.contains_case(_FR, X.PERIODS, "'A verificar'")} END AS periodicidade FROM autocontrolo)
    SELECT ac_id, periodicidade, CASE periodicidade {' '.join(f"WHEN '{k}' THEN {v}" for k, v in X.PERIOD_ORDER.items())} ELSE 9 END AS ordem FROM x"""
)
def communications_normalised(spark, folder):
    """Each frequency's reporting label by ordered fragments, with its sort code."""
    rows = table(spark, folder, "autocontrolo", "ac_id", "frequencia_amostragem")
    return rows.select("ac_id", X.reporting_period(F.col("frequencia_amostragem")).alias("periodicidade")).withColumn("ordem", X.period_order(F.col("periodicidade")))


@query(
    "SELECT cond_id, CASE trim(parametro_doc) " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in P.CUT_NAMES) + " WHEN '' THEN NULL ELSE trim(parametro_doc) END AS parametro FROM conditions"
)
def cut_names(spark, folder):
    """Parameter names with the two known cut ones as codes."""
    return table(spark, folder, "conditions", "cond_id", "parametro_doc").select("cond_id", P.cut_name(F.col("parametro_doc")).alias("parametro"))


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_upsert_result(spark, folder):
    """The last event of each user, kept by a file stream that upserts batch by batch."""
    root = f"{shared_folder(spark)}/inbox-{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "ts", "user_id", "event_type").schema
    stream = inbox.arrivals(spark, folder, schema.simpleString()[7:-1].replace(":", " "), "events.parquet")
    order = [F.col("ts"), F.col("event_id")]
    accepted, review = (inbox.UpsertTable(spark, f"{root}/{name}", ["user_id"], order=order) for name in ("accepted", "review"))
    work = inbox.upsert_batches(["user_id"], order, F.col("user_id").isNotNull(), accepted, review)
    inbox.run_once(stream, work, f"{root}/progress")
    found = cut(accepted.read().select("user_id", "event_id", "event_type"))
    inbox.UpsertTable(spark, root, []).drop()
    return found
