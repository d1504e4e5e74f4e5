"""Queries behind the report pages: limits by parameter, keyword lists, texts of one selected asset, dates by urgency,
answers of a stored or remote model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudalix.functions.fold import fold_ascii
from caudalix.functions.placeholders import filled
from caudalix.operators import columns, compare, criteria, lookups, measures, records
from caudalix.operators.skew import salted_join
from caudalix.operators.vocabulary import small_rows
from caudalix.plans import sql
from caudalix.plans.facts import ORACLES as FACTS
from caudalix.plans.facts import _FLAGGED, distinct_text_pairs
from caudalix.plans.licences import _DATED, _dated, _versions, _VERSIONS, AS_OF
from caudalix.sources.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return add


# The parameters a report lists first, in its order.
TEMPLATE = ("CBO5", "CQO", "SST", "pH", "Nt", "Pt")
# What stands behind the two limits of a cell where the dry season has another one.
WET, DRY = "\n(período húmido*)\n", "\n(período estiagem*)"


def _cells(spark: SparkSession, folder: str) -> DataFrame:
    """n_tua, parametro, celula: the limits of each licence and parameter, of each period the last row's."""
    rows = table(spark, folder, "conditions", "cond_id", "n_tua", "parametro", "periodo", "vle").where(filled(F.col("n_tua")) & filled(F.col("parametro")))
    of = lambda p: F.max_by(F.coalesce("vle", F.lit("")), F.when(F.coalesce(F.nullif("periodo", F.lit("")), F.lit("Normal")) == p, F.col("cond_id")))
    both = rows.groupBy("n_tua", "parametro").agg(F.coalesce(of("Normal"), F.lit("")).alias("n"), F.coalesce(of("Estiagem"), F.lit("")).alias("e"))
    stacked = F.concat("n", F.lit(WET), "e", F.lit(DRY))
    cell = F.when((F.col("n") != "") & (F.col("e") != "") & (F.col("n") != F.col("e")), stacked).when(F.col("n") != "", F.col("n")).otherwise(F.col("e"))
    return both.select("n_tua", "parametro", cell.alias("celula"))


_CELLS = f"""last AS (SELECT n_tua, parametro, coalesce(nullif(periodo, ''), 'Normal') AS p, coalesce(vle, '') AS v FROM conditions WHERE {sql.filled('n_tua')} AND {sql.filled('parametro')}
      QUALIFY row_number() OVER (PARTITION BY n_tua, parametro, p ORDER BY cond_id DESC) = 1),
    two AS (SELECT n_tua, parametro, coalesce(max(CASE WHEN p = 'Normal' THEN v END), '') AS n, coalesce(max(CASE WHEN p = 'Estiagem' THEN v END), '') AS e FROM last GROUP BY ALL),
    cells AS (SELECT n_tua, parametro, CASE WHEN n <> '' AND e <> '' AND n <> e THEN n || {sql.quoted(WET)} || e || {sql.quoted(DRY)} WHEN n <> '' THEN n ELSE e END AS celula FROM two)"""


@query(
    f"""WITH {_CELLS}, o AS (SELECT *, coalesce(list_position([{sql.values(TEMPLATE)}], parametro), 999) AS r FROM cells)
    SELECT n_tua, string_agg(parametro, '; ' ORDER BY r, encode(parametro)) AS parametros, string_agg(celula, '; ' ORDER BY r, encode(parametro)) AS celulas FROM o GROUP BY 1"""
)
def limits_by_parameter(spark, folder):
    """One row per licence: every parameter it sets, those of the template first and the others in order, with their
    cells. No parameter is left out, however many there are."""
    place = F.array_position(F.array(*[F.lit(p) for p in TEMPLATE]), F.col("parametro"))
    rank = F.when(place > 0, place).otherwise(999)
    listed = F.array_sort(F.collect_list(F.struct(rank.alias("r"), "parametro", "celula"))).alias("x")
    rows = _cells(spark, folder).groupBy("n_tua").agg(listed)
    text = lambda name: F.array_join(F.transform("x", lambda c: c[name]), "; ")
    return rows.select("n_tua", text("parametro").alias("parametros"), text("celula").alias("celulas"))


def limits_pivoted(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a column per parameter: the template's, then all others in order."""
    return columns.pivot_in_order(_cells(spark, folder), ["n_tua"], "parametro", F.max("celula"), TEMPLATE)


QUERIES["limits_pivoted"] = limits_pivoted


@query(
    f"""WITH k AS (SELECT DISTINCT {sql.fold('valor')} AS k FROM ref_valores), x AS (SELECT doc_id, {sql.fold('text')} AS t FROM documents WHERE {sql.filled('text')})
    SELECT doc_id, string_agg(k, '; ' ORDER BY encode(k)) AS palavras FROM x JOIN k ON k <> '' AND contains(t, k) GROUP BY 1"""
)
def keywords_scanned(spark, folder):
    """The documents that name an entry of a keyword list, which is read from a table."""
    ref = table(spark, folder, "ref_valores", "valor").select(fold_ascii(F.col("valor")).alias("valor"))
    words = sorted(r["palavra"] for r in small_rows(lookups.keyword_list(ref, "valor", "valor")))
    rows = table(spark, folder, "documents", "doc_id", "text").where(filled(F.col("text"))).select("doc_id", F.explode(F.array(fold_ascii(F.col("text")))).alias("t"))
    hits = F.filter(F.array(*map(F.lit, words)).cast("array<string>"), lambda k: F.col("t").contains(k))
    return rows.select("doc_id", F.array_join(hits, "; ").alias("palavras")).where("palavras <> ''")


_ONE = lambda c: f"CASE WHEN count(DISTINCT coalesce({c}::VARCHAR, chr(1))) = 1 THEN max({c}) END"
_CARD = f"""WITH {_VERSIONS}, r AS (SELECT codmaximo, concelho, negocio FROM registo), l AS (SELECT v.codmaximo, v.n_tua, v.tua_lurh, v.fim, nullif(trim(p.populacao_servida), '') AS pop, r.concelho, r.negocio, v.file_name
    FROM versions v JOIN licenses p USING (lic_id) LEFT JOIN r ON r.codmaximo = v.codmaximo WHERE v.codmaximo IS NOT NULL),
    g AS (SELECT codmaximo, {_ONE('n_tua')} AS num, {_ONE('tua_lurh')} AS tipo, {_ONE('concelho')} AS mun, {_ONE('negocio')} AS neg, {_ONE('pop')} AS pop, {_ONE('fim')} AS fim, {_ONE('file_name')} AS fich, count(DISTINCT n_tua) AS n FROM l GROUP BY 1)"""


@query(
    f"""{_CARD} SELECT codmaximo, coalesce(num, '') || '  ·  ' || coalesce(tipo, '') || '  ·  ' || coalesce(neg, '') || ' · ' || coalesce(mun, '') AS subtitulo,
    coalesce(num, '') || CASE WHEN mun IS NOT NULL AND mun <> '0' THEN '   ·   ' || mun ELSE '' END || CASE WHEN pop IS NOT NULL THEN '   ·   Pop. servida: ' || pop || ' hab.' ELSE '' END AS subtitulo_etar,
    coalesce(strftime(fim, '%d/%m/%Y'), 'Sem data') AS validade,
    CASE WHEN fim IS NULL THEN 'Sem data' WHEN fim < DATE '{AS_OF}' THEN 'Caducada há ' || (DATE '{AS_OF}' - fim) || ' dias' ELSE (fim - DATE '{AS_OF}') || ' dias' END AS dias,
    coalesce(mun, '—') || CASE WHEN neg IS NOT NULL THEN '  ·  ' || neg ELSE '' END AS localizacao, CASE WHEN n = 1 THEN fich END AS ficheiro,
    CASE WHEN n = 0 THEN 'Escolha uma licença primeiro.' WHEN n > 1 THEN 'Escolha só UMA licença (' || n || ' seleccionadas).' WHEN fich IS NULL THEN 'O PDF desta licença não está no arquivo.' ELSE 'Abrir o PDF original desta licença.' END AS dica FROM g"""
)
def asset_card(spark, folder):
    """The texts of one selected asset's page: subtitles, validity, days to it, place, its file and the button's hint. A
    field with several values is empty."""
    people = table(spark, folder, "licenses", "lic_id", "populacao_servida")
    places = table(spark, folder, "registo", "codmaximo", "concelho", "negocio")
    versions = _versions(spark, folder).where("codmaximo is not null").join(people, "lic_id")
    rows = salted_join(versions, places, ["codmaximo"], "lic_id").withColumn("pop", F.nullif(F.trim("populacao_servida"), F.lit("")))
    one = {"num": "n_tua", "tipo": "tua_lurh", "mun": "concelho", "neg": "negocio", "pop": "pop", "fim": "fim", "fich": "file_name"}
    found = {name: measures.only_value(F.col(c)) for name, c in one.items()} | {"n": F.count_distinct("n_tua")}
    day = F.lit(AS_OF).cast("date")
    text = lambda *parts: F.concat(*[F.coalesce(F.col(p[1:]), F.lit("")) if p.startswith("$") else F.lit(p) for p in parts])
    given = lambda c, shown: F.when(F.col(c).isNotNull(), shown).otherwise("")
    days = F.datediff("fim", day)
    return measures.evaluate(rows, ["codmaximo"], found).select(
        "codmaximo",
        text("$num", "  ·  ", "$tipo", "  ·  ", "$neg", " · ", "$mun").alias("subtitulo"),
        F.concat(text("$num"), F.when(F.col("mun") != "0", text("   ·   ", "$mun")).otherwise(""), given("pop", text("   ·   Pop. servida: ", "$pop", " hab."))).alias("subtitulo_etar"),
        F.coalesce(F.date_format("fim", "dd/MM/yyyy"), F.lit("Sem data")).alias("validade"),
        F.when(F.col("fim").isNull(), "Sem data").when(days < 0, F.concat(F.lit("Caducada há "), -days, F.lit(" dias"))).otherwise(F.concat(days, F.lit(" dias"))).alias("dias"),
        F.concat(F.coalesce("mun", F.lit("—")), given("neg", text("  ·  ", "$neg"))).alias("localizacao"),
        F.when(F.col("n") == 1, F.col("fich")).alias("ficheiro"),
        F.when(F.col("n") == 0, "Escolha uma licença primeiro.")
        .when(F.col("n") > 1, F.concat(F.lit("Escolha só UMA licença ("), "n", F.lit(" seleccionadas).")))
        .when(F.col("fich").isNull(), "O PDF desta licença não está no arquivo.")
        .otherwise("Abrir o PDF original desta licença.").alias("dica"),
    )


# The seven criteria of a licence's page: flag, label, line of the list; and the colours with and without.
CRITERIA = (
    ("f_mensal", "Média mensal ≤ VLE", "Média mensal ≤ VLE"),
    ("f_anual", "Média anual ≤ VLE", "Média anual ≤ VLE"),
    ("f_dobro", "Valor máx. observado ≤ dobro do VLE", "Máx. observado ≤ 100% VLE (dobro)"),
    ("f_150", "Valor máx. observado ≤ 150% do VLE", "Máx. observado ≤ 150% VLE"),
    ("f_ordem", "≤ uma ordem de grandeza do VLE", "≤ uma ordem de grandeza do VLE"),
    ("f_gama", "Dentro da gama de valores (intervalo)", "Gama de valores (intervalo)"),
    ("f_quadro", "Borlas — Quadro III do DL 152/97", "Quadro III DL 152/97"),
)
CELL_COLOURS, TEXT_COLOURS = ("#A9DFBF", "#F5B7B1"), ("#1E8449", "#95A5A6")
_EITHER = lambda f, a, b: f"CASE WHEN {f} >= 1 THEN {sql.quoted(a)} ELSE {sql.quoted(b)} END"


@query(
    f"""WITH {_FLAGGED}, s AS (SELECT n_tua, {', '.join(f'sum({f}) AS {f}' for f, _, _ in CRITERIA)} FROM flagged WHERE n_tua IS NOT NULL GROUP BY 1)
    SELECT n_tua, {', '.join(f"{_EITHER(f, label, '—')} AS crit_{f[2:]}, {_EITHER(f, *CELL_COLOURS)} AS cf_{f[2:]}, {_EITHER(f, *TEXT_COLOURS)} AS cor_{f[2:]}" for f, label, _ in CRITERIA)},
    coalesce(nullif(concat_ws(chr(10), {', '.join(f"CASE WHEN {f} >= 1 THEN {sql.quoted('• ' + line)} END" for f, _, line in CRITERIA)}), ''), '—') AS criterios, ({' + '.join(f for f, _, _ in CRITERIA)})::BIGINT AS n FROM s"""
)
def criteria_card(spark, folder):
    """Each licence's seven criteria: label or dash, colours, the list of those to meet, and how many flags are set."""
    rows = table(spark, folder, "conditions", "n_tua", "avaliacao_conformidade_legal").where("n_tua is not null")
    names = [f for f, _, _ in CRITERIA]
    flags = rows.select("n_tua", *criteria.flags(F.col("avaliacao_conformidade_legal")))
    sums = measures.evaluate(flags, ["n_tua"], {f: F.sum(f) for f in names})
    either = lambda f, a, b, name: F.when(F.col(f) >= 1, a).otherwise(b).alias(f"{name}_{f[2:]}")
    shown = [c for f, label, _ in CRITERIA for c in (either(f, label, "—", "crit"), either(f, *CELL_COLOURS, "cf"), either(f, *TEXT_COLOURS, "cor"))]
    lines = F.concat_ws("\n", *[F.when(F.col(f) >= 1, f"• {line}") for f, _, line in CRITERIA])
    return sums.select("n_tua", *shown, F.when(lines == "", "—").otherwise(lines).alias("criterios"), sum(map(F.col, names), F.lit(0)).cast("bigint").alias("n"))


@query(
    f"""{_CARD.replace('WHERE v.codmaximo IS NOT NULL', '')}, m AS (SELECT count(DISTINCT coalesce(concelho, '')) AS municipios, count(DISTINCT coalesce(negocio, '')) AS empresas, coalesce(sum(try_cast(pop AS BIGINT)), 0)::BIGINT AS populacao,
    count(*) AS n, count(*) FILTER (fim < DATE '{AS_OF}') AS antes, count(*) FILTER (fim BETWEEN DATE '{AS_OF}' AND CAST(DATE '{AS_OF}' + INTERVAL 8 MONTH AS DATE)) AS janela, min(fim) AS fim FROM l)
    SELECT municipios, empresas, populacao, 'Situação a ' || strftime(DATE '{AS_OF}', '%d/%m/%Y') AS referencia, 'Localização das licenças — ' || n || ' licenças | ' || antes || ' caducadas, ' || janela || ' a expirar em 8 meses' AS titulo,
    (fim - DATE '{AS_OF}')::BIGINT AS dias FROM m"""
)
def map_measures(spark, folder):
    """Distinct places and companies, people served, and the map's title with the day of report, over all licences."""
    people = table(spark, folder, "licenses", "lic_id", "populacao_servida")
    places = table(spark, folder, "registo", "codmaximo", "concelho", "negocio")
    rows = salted_join(_versions(spark, folder).join(people, "lic_id"), places, ["codmaximo"], "lic_id")
    day = F.lit(AS_OF).cast("date")
    dates = measures.date_measures(F.col("fim"), day)
    found = {
        "municipios": measures.distinct_with_blank(F.col("concelho")),
        "empresas": measures.distinct_with_blank(F.col("negocio")),
        "populacao": F.coalesce(F.sum(F.trim("populacao_servida").try_cast("bigint")), F.lit(0)),
        "n": dates["total"], "antes": dates["antes"], "janela": dates["na_janela"], "fim": F.min("fim"),
    }
    title = F.concat(F.lit("Localização das licenças — "), "n", F.lit(" licenças | "), "antes", F.lit(" caducadas, "), "janela", F.lit(" a expirar em 8 meses"))
    stamp = F.concat(F.lit("Situação a "), F.date_format(day, "dd/MM/yyyy"))
    return measures.evaluate(rows, [], found).select("municipios", "empresas", "populacao", stamp.alias("referencia"), title.alias("titulo"), F.datediff("fim", day).cast("bigint").alias("dias"))


@query(
    f"""WITH {_DATED}, d AS (SELECT dg_id, fim - DATE '{AS_OF}' AS dias FROM dated WHERE fim >= DATE '{AS_OF}')
    SELECT dg_id, dias::BIGINT AS dias, CASE WHEN dias <= 183 THEN 'ALTA' WHEN dias <= 365 THEN 'MÉDIA' ELSE 'BAIXA' END AS prioridade, row_number() OVER (ORDER BY dias, dg_id) AS ordem FROM d"""
)
def urgency_order(spark, folder):
    """Documents that still hold, by days to their end, with the step of the ladder they stand on and their place."""
    day = F.lit(AS_OF).cast("date")
    rows = _dated(spark, folder).where(F.col("fim") >= day).select("dg_id", F.datediff("fim", day).cast("bigint").alias("dias"))
    stepped = rows.withColumn("prioridade", measures.ladder(F.col("dias"), ((183, "ALTA"), (365, "MÉDIA")), "BAIXA"))
    return records.ordinals(stepped, [], ["dias", "dg_id"])


@query(f"""WITH p AS ({FACTS['distinct_text_pairs']}) SELECT chave, n, exemplo, CASE WHEN chave < '8' THEN 'EQUIVALENTE' ELSE 'PENDENTE' END AS resposta FROM p""")
def text_pairs_answered(spark, folder):
    """The text pairs with the answers of a store that has those of half the keys and one that no pair asks for."""
    pairs = distinct_text_pairs(spark, folder)
    known = pairs.where("chave < '8'").select("chave", F.lit("EQUIVALENTE").alias("resposta"))
    spare = spark.createDataFrame([("none", "EQUIVALENTE")], "chave string, resposta string")
    return compare.answered(pairs, known.unionByName(spare))


@query("SELECT event_id, CASE WHEN event_type LIKE '%e%' THEN event_type ELSE 'fim' END AS resposta FROM events")
def model_messages(spark, folder):
    """The first message of a model's answer in JSON lines; each event is told in such lines."""
    rows = table(spark, folder, "events", "event_id", "event_type")
    kind = F.when(F.col("event_type").contains("e"), "message").otherwise("status")
    parts = ['{"type":"status"}\n\nbroken\n\n{"type":"', kind, '","content":{"content":"', F.col("event_type"), '"}}\n\n{"type":"message","content":"fim"}']
    told = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return rows.select("event_id", compare.first_message(told).alias("resposta"))
