"""Queries over licences, their documents and the asset registry, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudalix.functions import text as X
from caudalix.functions.dates import iso_text, order_number, parse_date
from caudalix.functions.numbers import as_decimal, as_integer, number
from caudalix.functions.placeholders import filled
from caudalix.operators import columns, compare, lookups, measures, quality, records
from caudalix.operators.parsing import file_name_dates
from caudalix.operators.skew import salted_join
from caudalix.plans import sql
from caudalix.sources.tables import table

#: All dated reports are seen from this day.
AS_OF = "2015-01-01"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _dated(spark: SparkSession, folder: str) -> DataFrame:
    """One row per dated document: file_name, tua_lurh, requerente, dg_id, inicio, fim."""
    rows = table(spark, folder, "dados_gerais", "dg_id", "file_name", "tua_lurh", "requerente", "data_de_inicio", "data_de_validade")
    return rows.withColumns({"inicio": parse_date(F.col("data_de_inicio")), "fim": parse_date(F.col("data_de_validade"))})


_DATED = f"""dated AS (SELECT dg_id, file_name, tua_lurh, requerente, data_de_inicio, data_de_validade,
  {sql.date('data_de_inicio')} AS inicio, {sql.date('data_de_validade')} AS fim FROM dados_gerais)"""


@query(f"WITH {_DATED} SELECT dg_id, CAST(inicio AS VARCHAR) AS inicio, CAST(fim AS VARCHAR) AS fim FROM dated")
def parse_date_formats(spark, folder):
    """Both dates of every document, whatever the notation."""
    return _dated(spark, folder).select("dg_id", F.col("inicio").cast("string"), F.col("fim").cast("string"))


@query(
    r"""SELECT lic_id, CASE WHEN regexp_matches(data_de_validade, '^\s*\d{2}[-/]\d{2}[-/]\d{4}') THEN
    regexp_extract(data_de_validade, '^\s*(\d{2})[-/](\d{2})[-/](\d{4})', 3) || '-' || regexp_extract(data_de_validade, '^\s*(\d{2})[-/](\d{2})[-/](\d{4})', 2)
    || '-' || regexp_extract(data_de_validade, '^\s*(\d{2})[-/](\d{2})[-/](\d{4})', 1) ELSE '' END AS iso,
    CASE WHEN regexp_matches(data_de_validade, '^\s*\d{2}[-/]\d{2}[-/]\d{4}') THEN CAST(
    regexp_extract(data_de_validade, '^\s*(\d{2})[-/](\d{2})[-/](\d{4})', 3) || regexp_extract(data_de_validade, '^\s*(\d{2})[-/](\d{2})[-/](\d{4})', 2)
    || regexp_extract(data_de_validade, '^\s*(\d{2})[-/](\d{2})[-/](\d{4})', 1) AS BIGINT) ELSE 0 END AS ordem FROM licenses"""
)
def iso_dates(spark, folder):
    """Validity as ISO text and as a sortable number, without a calendar check."""
    c = F.col("data_de_validade")
    return table(spark, folder, "licenses", "lic_id", "data_de_validade").select("lic_id", iso_text(c).alias("iso"), order_number(c).alias("ordem"))


@query(
    f"""WITH {_DATED} SELECT l.lic_id, {sql.identity('l.estabelecimento')} || '|' || coalesce(strftime(d.inicio, '%d-%m-%Y'), '') || '|' ||
    coalesce(strftime(d.fim, '%d-%m-%Y'), '') AS id_versao FROM licenses l LEFT JOIN
    (SELECT file_name, min(struct_pack(dg_id := dg_id, inicio := inicio, fim := fim)) AS p FROM dated GROUP BY file_name) x USING (file_name)
    LEFT JOIN dated d ON d.dg_id = x.p.dg_id"""
)
def version_identity(spark, folder):
    """A licence version's identity: folded name, start and end; the number is left out, as renewals reuse it."""
    lic = table(spark, folder, "licenses", "lic_id", "file_name", "estabelecimento")
    dates = records.pick(_dated(spark, folder), ["file_name"], [F.col("dg_id")], ["file_name", "inicio", "fim"])
    day = lambda c: F.coalesce(F.date_format(c, "dd-MM-yyyy"), F.lit(""))
    return salted_join(lic, dates, ["file_name"], "lic_id").select("lic_id", F.concat_ws("|", X.identity_norm(F.col("estabelecimento")), day("inicio"), day("fim")).alias("id_versao"))


def _versions(spark: SparkSession, folder: str) -> DataFrame:
    """Licences with the dates of their document: lic_id, codmaximo, tua_lurh, n_tua, inicio, fim."""
    lic = table(spark, folder, "licenses", "lic_id", "file_name", "codmaximo", "tua_lurh", "n_tua", "loaded_at")
    dates = records.pick(_dated(spark, folder), ["file_name"], [F.col("dg_id")], ["file_name", "inicio", "fim"])
    return salted_join(lic, dates, ["file_name"], "lic_id")


_VERSIONS = f"""{_DATED}, first_dates AS (SELECT file_name, inicio, fim FROM dated QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY dg_id) = 1),
versions AS (SELECT l.lic_id, l.file_name, l.codmaximo, l.tua_lurh, l.n_tua, l.loaded_at, f.inicio, f.fim FROM licenses l LEFT JOIN first_dates f USING (file_name))"""


@query(
    f"""WITH {_VERSIONS} SELECT lic_id, CASE WHEN codmaximo IS NULL OR row_number() OVER (PARTITION BY codmaximo ORDER BY inicio DESC NULLS LAST, lic_id) = 1
    THEN 'Atual' ELSE 'Histórico' END AS vigencia FROM versions"""
)
def current_vs_history(spark, folder):
    """The newest version of each asset against the others."""
    return records.versions(_versions(spark, folder), "codmaximo", F.col("inicio"), "lic_id").select("lic_id", "vigencia")


@query(
    f"""WITH {_VERSIONS}, v AS (SELECT *, codmaximo IS NULL OR row_number() OVER (PARTITION BY codmaximo ORDER BY inicio DESC NULLS LAST, lic_id) = 1 AS atual FROM versions),
    best AS (SELECT n_tua, file_name FROM v WHERE n_tua IS NOT NULL QUALIFY row_number() OVER (PARTITION BY n_tua ORDER BY atual DESC, lic_id DESC) = 1)
    SELECT c.cond_id, coalesce(nullif(c.file_name, ''), b.file_name, '') AS versao, coalesce(b.file_name, '') AS versao_atual FROM conditions c LEFT JOIN best b USING (n_tua)"""
)
def number_to_version_fill(spark, folder):
    """A condition's own version, else the one its licence number stands for (the current version wins)."""
    v = records.versions(_versions(spark, folder), "codmaximo", F.col("inicio"), "lic_id").where("n_tua is not null")
    best = records.pick_last(v, ["n_tua"], [(F.col("vigencia") == "Atual"), F.col("lic_id")], ["n_tua", "file_name"]).withColumnRenamed("file_name", "_f")
    rows = table(spark, folder, "conditions", "cond_id", "file_name", "n_tua")
    # The number side is unique and the collective licence's number is hot.
    joined = salted_join(rows, best, ["n_tua"], "cond_id")
    own = F.nullif(F.col("file_name"), F.lit(""))
    return joined.select("cond_id", F.coalesce(own, "_f", F.lit("")).alias("versao"), F.coalesce("_f", F.lit("")).alias("versao_atual"))


@query(
    f"""WITH {_VERSIONS} SELECT codmaximo, tua_lurh, lic_id, CAST(fim AS VARCHAR) AS fim FROM versions WHERE codmaximo IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY codmaximo, tua_lurh ORDER BY fim DESC NULLS LAST, lic_id DESC) = 1"""
)
def latest_per_regime(spark, folder):
    """The licence of each asset and regime that ends last."""
    rows = _versions(spark, folder).where("codmaximo is not null")
    last = records.pick_last(rows, ["codmaximo", "tua_lurh"], [F.col("fim"), F.col("lic_id")], ["codmaximo", "tua_lurh", "lic_id", "fim"])
    return last.withColumn("fim", F.col("fim").cast("string"))


@query(
    f"""WITH {_VERSIONS}, last AS (SELECT * FROM versions WHERE codmaximo IS NOT NULL QUALIFY row_number() OVER
    (PARTITION BY codmaximo, tua_lurh ORDER BY fim DESC NULLS LAST, lic_id DESC) = 1),
    p AS (SELECT codmaximo, max(CASE WHEN tua_lurh='TUA' THEN lic_id END) AS tua, max(CASE WHEN tua_lurh='LURH' THEN lic_id END) AS lurh,
    max(CASE WHEN tua_lurh='TUA' THEN inicio END) a1, max(CASE WHEN tua_lurh='TUA' THEN fim END) a2, max(CASE WHEN tua_lurh='LURH' THEN inicio END) b1,
    max(CASE WHEN tua_lurh='LURH' THEN fim END) b2 FROM last GROUP BY codmaximo), n AS (SELECT codmaximo, count(*) AS n FROM versions GROUP BY 1)
    SELECT codmaximo, CASE WHEN tua IS NOT NULL AND lurh IS NOT NULL THEN 'TUA + LURH' WHEN tua IS NOT NULL THEN 'Só TUA' ELSE 'Só LURH' END AS regimes,
    CASE WHEN a1 IS NULL OR a2 IS NULL OR b1 IS NULL OR b2 IS NULL THEN 'desconhecido' WHEN a1=b1 AND a2=b2 THEN 'igual'
    WHEN a1<=b2 AND b1<=a2 THEN 'sobrepostos' ELSE 'separados' END AS periodos, n - (tua IS NOT NULL)::INT - (lurh IS NOT NULL)::INT AS outras FROM p JOIN n USING (codmaximo)"""
)
def regimes_per_asset(spark, folder):
    """Which regimes an asset is licensed under, how the latest periods of both lie, and how many more licences it has."""
    rows = _versions(spark, folder).where("codmaximo is not null")
    last = records.pick_last(rows, ["codmaximo", "tua_lurh"], [F.col("fim"), F.col("lic_id")], ["codmaximo", "tua_lurh", "lic_id", "inicio", "fim"])
    of = lambda regime, c: F.max(F.when(F.col("tua_lurh") == regime, F.col(c)))
    wide = last.groupBy("codmaximo").agg(
        of("TUA", "lic_id").alias("tua"), of("LURH", "lic_id").alias("lurh"), of("TUA", "inicio").alias("a1"), of("TUA", "fim").alias("a2"),
        of("LURH", "inicio").alias("b1"), of("LURH", "fim").alias("b2"),
    )
    n = rows.groupBy("codmaximo").agg(F.count("*").alias("n"))
    has = lambda c: F.col(c).isNotNull()
    regimes = F.when(has("tua") & has("lurh"), "TUA + LURH").when(has("tua"), "Só TUA").otherwise("Só LURH")
    relation = compare.interval_relation(F.col("a1"), F.col("a2"), F.col("b1"), F.col("b2"))
    more = F.col("n") - has("tua").cast("int") - has("lurh").cast("int")
    return wide.join(n, "codmaximo").select("codmaximo", regimes.alias("regimes"), relation.alias("periodos"), more.alias("outras"))


@query(
    f"""WITH {_VERSIONS}, d AS (SELECT * FROM versions WHERE codmaximo IS NOT NULL AND inicio IS NOT NULL),
    o AS (SELECT codmaximo, lic_id FROM d QUALIFY row_number() OVER (PARTITION BY codmaximo ORDER BY inicio, lic_id)=1),
    n AS (SELECT codmaximo, lic_id FROM d QUALIFY row_number() OVER (PARTITION BY codmaximo ORDER BY inicio DESC, lic_id DESC)=1)
    SELECT codmaximo, o.lic_id AS antiga, n.lic_id AS nova FROM o JOIN n USING (codmaximo) WHERE o.lic_id <> n.lic_id"""
)
def pair_oldest_newest(spark, folder):
    """The first and the last dated licence of each asset."""
    return compare.oldest_and_newest(_versions(spark, folder), "codmaximo", "inicio", "lic_id")


@query("SELECT file_name, lic_id, CAST(loaded_at AS VARCHAR) AS loaded_at FROM licenses QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY loaded_at DESC, lic_id DESC) = 1")
def last_wins_batch(spark, folder):
    """The last extraction of each file."""
    rows = table(spark, folder, "licenses", "file_name", "lic_id", "loaded_at")
    last = records.pick_last(rows, ["file_name"], [F.col("loaded_at"), F.col("lic_id")], ["file_name", "lic_id", "loaded_at"])
    return last.withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


@query("SELECT n_tua, lic_id, estabelecimento FROM licenses WHERE n_tua IS NOT NULL QUALIFY row_number() OVER (PARTITION BY n_tua ORDER BY lic_id) = 1")
def first_wins_dedupe(spark, folder):
    """The first licence of each number."""
    rows = table(spark, folder, "licenses", "n_tua", "lic_id", "estabelecimento").where("n_tua is not null")
    return records.pick(rows, ["n_tua"], [F.col("lic_id")], ["n_tua", "lic_id", "estabelecimento"])


@query(
    f"""WITH {_DATED} SELECT tua_lurh, count(*) AS total, count(*) FILTER (fim > CAST(DATE '{AS_OF}' + INTERVAL 8 MONTH AS DATE)) AS depois, count(*) FILTER (fim < DATE '{AS_OF}') AS antes,
    count(*) FILTER (fim BETWEEN DATE '{AS_OF}' AND CAST(DATE '{AS_OF}' + INTERVAL 8 MONTH AS DATE)) AS na_janela, count(*) FILTER (fim IS NULL) AS sem_data,
    round(100.0*count(*) FILTER (fim > CAST(DATE '{AS_OF}' + INTERVAL 8 MONTH AS DATE))/count(*), 1)::DOUBLE AS pct_depois, round(100.0*count(*) FILTER (fim < DATE '{AS_OF}')/count(*), 1)::DOUBLE AS pct_antes,
    round(100.0*count(*) FILTER (fim BETWEEN DATE '{AS_OF}' AND CAST(DATE '{AS_OF}' + INTERVAL 8 MONTH AS DATE))/count(*), 1)::DOUBLE AS pct_na_janela,
    CAST(min(fim) FILTER (fim >= DATE '{AS_OF}') AS VARCHAR) AS proxima, min(fim - DATE '{AS_OF}') FILTER (fim >= DATE '{AS_OF}') AS dias_ate_proxima,
    round(avg(fim - DATE '{AS_OF}') FILTER (fim >= DATE '{AS_OF}'), 2) AS dias_medios,
    count(*) FILTER (fim BETWEEN DATE '{AS_OF}' AND CAST(DATE '{AS_OF}' + INTERVAL 12 MONTH AS DATE)) AS em_12_meses FROM dated GROUP BY tua_lurh"""
)
def date_window_measures(spark, folder):
    """Documents per regime by how their validity lies to the day of report."""
    found = measures.date_measures(F.col("fim"), F.lit(AS_OF).cast("date"))
    return measures.evaluate(_dated(spark, folder), ["tua_lurh"], found).withColumn("proxima", F.col("proxima").cast("string"))


@query(
    f"""WITH {_DATED} SELECT dg_id, CAST(fim AS VARCHAR) AS fim, (fim - DATE '{AS_OF}')::BIGINT AS dias, CASE WHEN fim - DATE '{AS_OF}' <= 183 THEN 'ALTA' ELSE 'MÉDIA' END AS prioridade
    FROM dated WHERE fim BETWEEN DATE '{AS_OF}' AND CAST(DATE '{AS_OF}' + INTERVAL 8 MONTH AS DATE)"""
)
def dates_in_window(spark, folder):
    """Documents whose validity ends within eight months of the day of report, with days and priority."""
    day = F.lit(AS_OF).cast("date")
    rows = _dated(spark, folder).where(F.col("fim").between(day, F.add_months(day, 8)))
    days = F.datediff("fim", day).cast("bigint")
    return rows.select("dg_id", F.col("fim").cast("string"), days.alias("dias"), F.when(days <= 183, "ALTA").otherwise("MÉDIA").alias("prioridade"))


@query("SELECT tua_lurh, sentido_da_decisao, count(*) AS n, round(100.0*count(*)/sum(count(*)) OVER (PARTITION BY tua_lurh), 2)::DOUBLE AS percentagem FROM licenses GROUP BY 1, 2")
def share_with_filter_removed(spark, folder):
    """Share of each decision among its regime's licences."""
    rows = table(spark, folder, "licenses", "tua_lurh", "sentido_da_decisao")
    return measures.share_without(rows, ["tua_lurh", "sentido_da_decisao"], ["sentido_da_decisao"])


@query(
    """SELECT codmaximo, CASE WHEN count(DISTINCT coalesce(nivel_de_tratamento, chr(1))) = 1 AND max(nivel_de_tratamento) IS NOT NULL THEN max(nivel_de_tratamento) ELSE 'vários' END AS nivel,
    CASE WHEN count(DISTINCT coalesce(n_tua, chr(1))) = 1 AND max(n_tua) IS NOT NULL THEN max(n_tua) ELSE '' END AS numero, count(DISTINCT coalesce(estabelecimento, '')) AS nomes
    FROM licenses WHERE codmaximo IS NOT NULL GROUP BY 1"""
)
def selected_value_text(spark, folder):
    """The one treatment level and number of each asset, or a substitute, and how many names it has."""
    rows = table(spark, folder, "licenses", "codmaximo", "nivel_de_tratamento", "n_tua", "estabelecimento").where("codmaximo is not null")
    found = {
        "nivel": measures.selected(F.col("nivel_de_tratamento"), "vários"),
        "numero": measures.selected(F.col("n_tua"), ""),
        "nomes": measures.distinct_with_blank(F.col("estabelecimento")),
    }
    return measures.evaluate(rows, ["codmaximo"], found)


@query(
    f"""SELECT lic_id, {sql.fold('estabelecimento')} AS dobrado, replace({sql.fold('estabelecimento')}, ' ', '') AS cabecalho,
    regexp_replace(regexp_replace({sql.fold('estabelecimento')}, '\\b(?:etar|lic|de|da|do|das|dos)\\b', ' ', 'g'), '[^a-z0-9]', '', 'g') AS instalacao,
    {sql.identity('estabelecimento')} AS identidade, lower(regexp_replace(coalesce(file_name, ''), '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS ficheiro,
    CASE WHEN regexp_replace({sql.fold('estabelecimento')}, '[^a-z0-9]+', '', 'g') = '' THEN 'PARAM' ELSE
    upper(regexp_replace(regexp_replace({sql.fold('estabelecimento')}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) END AS parte FROM licenses WHERE estabelecimento IS NOT NULL"""
)
def fold_variants(spark, folder):
    """The folding variants side by side; they differ on purpose."""
    from caudalix.functions.fold import fold_ascii, slug

    c = F.col("estabelecimento")
    rows = table(spark, folder, "licenses", "lic_id", "estabelecimento", "file_name").where("estabelecimento is not null")
    return rows.select(
        "lic_id", fold_ascii(c).alias("dobrado"), X.header_key(c).alias("cabecalho"), X.plant_key(c).alias("instalacao"), X.identity_norm(c).alias("identidade"),
        X.file_slug(F.col("file_name")).alias("ficheiro"), slug(c).alias("parte"),
    )


_ASSET = lambda c: (
    f"array_to_string(list_filter(list_transform(string_split_regex(trim(regexp_replace(upper({sql.fold(c)}), '[^A-Z0-9 ]+', ' ', 'g')), '\\s+'), "
    "lambda w: CASE w WHEN 'STO' THEN 'SANTO' WHEN 'STA' THEN 'SANTA' ELSE w END), lambda w: w NOT IN ('DE','DA','DO','DAS','DOS','D')), '')"
)
_BARE = lambda c: f"regexp_replace(coalesce({_ASSET(c)}, ''), '^(?:ETAR|ETA|EETAR)', '')"


@query(
    f"""WITH r AS (SELECT codmaximo, {_BARE('designacao_gna')} AS k FROM registo), l AS (SELECT lic_id, {_BARE('estabelecimento')} AS k FROM licenses)
    SELECT lic_id, CASE WHEN k IN (SELECT k FROM r) THEN k ELSE '' END AS chave FROM l"""
)
def name_key_lookup(spark, folder):
    """The registry key of each licence's name, kept only if the registry has it."""
    reg = table(spark, folder, "registo", "designacao_gna").select(X.asset_key_bare(F.col("designacao_gna")).alias("k")).distinct().withColumn("found", F.lit(True))
    lic = table(spark, folder, "licenses", "lic_id", "estabelecimento").select("lic_id", X.asset_key_bare(F.col("estabelecimento")).alias("k"))
    return lic.join(reg, "k", "left").select("lic_id", F.when(F.col("found"), F.col("k")).otherwise("").alias("chave"))


def _match_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    places = records.pick(table(spark, folder, "rejeicao", "file_name", "rej_id", "latitude", "longitude"), ["file_name"], [F.col("rej_id")], ["file_name", "latitude", "longitude"])
    lic = table(spark, folder, "licenses", "lic_id", "file_name", "estabelecimento").join(places, "file_name", "left")
    left = lic.select("lic_id", X.asset_key_bare(F.col("estabelecimento")).alias("name_key"), number(F.col("latitude")).alias("lat"), number(F.col("longitude")).alias("lon"))
    both = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    left = left.withColumns({c: F.when(both, F.col(c)) for c in ("lat", "lon")})
    reg = table(spark, folder, "registo", "codmaximo", "designacao_gna", "latitude_wgs84", "longitude_wgs84")
    name = F.col("designacao_gna")
    right = reg.select(
        "codmaximo", X.asset_key_bare(name).alias("name_key"), F.col("latitude_wgs84").alias("lat"), F.col("longitude_wgs84").alias("lon"),
        F.coalesce(F.lower(name).contains("antiga"), F.lit(False)).alias("old"), F.trim(F.regexp_replace(name, r"\s*\(Antiga\)", "")).alias("base"),
    )
    return left, right


_SIDES = f"""places AS (SELECT file_name, latitude, longitude FROM rejeicao QUALIFY row_number() OVER (PARTITION BY file_name ORDER BY rej_id)=1),
num AS (SELECT lic_id, {_BARE('estabelecimento')} AS k, try_cast(trim(replace(latitude, ',', '.')) AS DOUBLE) AS la, try_cast(trim(replace(longitude, ',', '.')) AS DOUBLE) AS lo
  FROM licenses LEFT JOIN places USING (file_name)),
l AS (SELECT lic_id, k, CASE WHEN lo IS NOT NULL THEN la END AS la, CASE WHEN la IS NOT NULL THEN lo END AS lo FROM num),
r AS (SELECT codmaximo, {_BARE('designacao_gna')} AS k, latitude_wgs84 AS lb, longitude_wgs84 AS lob, lower(designacao_gna) LIKE '%antiga%' AS old,
  trim(regexp_replace(designacao_gna, '\\s*\\(Antiga\\)', '', 'g')) AS base FROM registo)"""


@query(
    f"""WITH {_SIDES}, p AS (SELECT lic_id, codmaximo, {sql.km('la', 'lo', 'lb', 'lob')} AS km FROM l, r WHERE la IS NOT NULL AND lb IS NOT NULL AND abs(la - lb) < 0.02)
    SELECT lic_id, codmaximo, round(km, 3) AS km FROM p WHERE km <= 2 QUALIFY row_number() OVER (PARTITION BY lic_id ORDER BY km, codmaximo) = 1"""
)
def nearest_within_limit(spark, folder):
    """The asset nearest to each licence's discharge point, within two kilometres."""
    left, right = _match_sides(spark, folder)
    return lookups.nearest(left, right, "lic_id", "codmaximo").withColumn("km", F.round("km", 3))


@query(
    f"""WITH {_SIDES}, byname AS (SELECT l.lic_id, r.codmaximo, 'name' AS metodo FROM l JOIN r ON l.k = r.k AND r.k <> ''
      QUALIFY row_number() OVER (PARTITION BY l.lic_id ORDER BY coalesce({sql.km('la', 'lo', 'lb', 'lob')}, 9e9), r.codmaximo) = 1),
    p AS (SELECT lic_id, codmaximo, {sql.km('la', 'lo', 'lb', 'lob')} AS km FROM l, r WHERE la IS NOT NULL AND lb IS NOT NULL AND abs(la - lb) < 0.02 AND lic_id NOT IN (SELECT lic_id FROM byname)),
    bycoord AS (SELECT lic_id, codmaximo, 'coord' AS metodo FROM p WHERE km <= 2 QUALIFY row_number() OVER (PARTITION BY lic_id ORDER BY km, codmaximo) = 1),
    cur AS (SELECT base, min(codmaximo) AS current FROM r WHERE NOT old GROUP BY base), moved AS (SELECT r.codmaximo, current FROM r JOIN cur USING (base) WHERE old)
    SELECT lic_id, coalesce(current, codmaximo) AS codmaximo, metodo FROM (SELECT * FROM byname UNION ALL SELECT * FROM bycoord) x LEFT JOIN moved USING (codmaximo)"""
)
def name_match_then_nearest(spark, folder):
    """The asset of each licence by name, what is left by distance; superseded assets give way to current ones."""
    left, right = _match_sides(spark, folder)
    return lookups.name_then_nearest(left, right, "lic_id", "codmaximo")


@query(
    f"""WITH a AS (SELECT DISTINCT {_BARE('designacao_da_rejeicao')} AS chave FROM rejeicao), b AS (SELECT DISTINCT {_BARE('designacao_gna')} AS registo FROM registo)
    SELECT chave, registo FROM a, b WHERE length(chave) >= 5 AND length(registo) >= 5 AND (contains(chave, registo) OR contains(registo, chave))"""
)
def containment_match(spark, folder):
    """Names of discharge points and assets of which one contains the other."""
    a = table(spark, folder, "rejeicao", "designacao_da_rejeicao").select(X.asset_key_bare(F.col("designacao_da_rejeicao")).alias("chave"))
    b = table(spark, folder, "registo", "designacao_gna").select(X.asset_key_bare(F.col("designacao_gna")).alias("registo"))
    return lookups.containing(a, "chave", b, "registo")


@query(f"SELECT {_BARE('designacao_gna')} AS chave, count(*) AS n FROM registo GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark, folder):
    """Registry keys that more than one asset has."""
    return records.duplicates(table(spark, folder, "registo", "designacao_gna").select(X.asset_key_bare(F.col("designacao_gna")).alias("chave")), ["chave"])


@query("SELECT count(DISTINCT coalesce(concelho, '')) AS concelhos, count(DISTINCT coalesce(negocio, '')) AS negocios, count(DISTINCT coalesce(designacao_gna, '')) AS instalacoes FROM registo")
def distinct_assets(spark, folder):
    """Distinct places, companies and plants, blank counted as one."""
    rows = table(spark, folder, "registo", "concelho", "negocio", "designacao_gna")
    names = {"concelhos": "concelho", "negocios": "negocio", "instalacoes": "designacao_gna"}
    return measures.evaluate(rows, [], {n: measures.distinct_with_blank(F.col(c)) for n, c in names.items()})


@query(
    """SELECT rej_id, regexp_extract(coalesce(regiao_hidrografica, ''), '^(RH\\d)', 1) AS regiao,
    CASE WHEN length(nut_concelho_freguesia) - length(replace(nut_concelho_freguesia, '/', '')) >= 2 THEN trim(split_part(nut_concelho_freguesia, '/', 2)) END AS concelho FROM rejeicao"""
)
def place_parts(spark, folder):
    """Region code and the middle part of the place text."""
    rows = table(spark, folder, "rejeicao", "rej_id", "regiao_hidrografica", "nut_concelho_freguesia")
    return rows.select("rej_id", F.regexp_extract(F.coalesce("regiao_hidrografica", F.lit("")), r"^(RH\d)", 1).alias("regiao"), X.third_place(F.col("nut_concelho_freguesia")).alias("concelho"))


# River-basin code -> administration.
REGIONS = [("RH1", "ARH do Norte"), ("RH2", "ARH do Norte"), ("RH3", "ARH do Norte"), ("RH4", "ARH do Centro"), ("RH5", "ARH do Tejo e Oeste"), ("RH6", "ARH do Alentejo"), ("RH7", "ARH do Alentejo"), ("RH8", "ARH do Algarve")]
# The replacements of the regional report, in order; the last one leaves a blank in front.
REPLACED = [("ARH do Alentejo", "ARH Alentejo"), ("ARH do Centro", "ARH Centro"), ("ARH do Tejo e Oeste", "ARH Tejo e Oeste"), ("ARH do Algarve", "ARH Algarve"), ("ARH do Norte", " ARH Norte")]


@query(
    f"""WITH x AS (SELECT lic_id, regexp_extract(coalesce(n_tua, ''), '\\.(RH\\w+)$', 1) AS codigo FROM licenses)
    SELECT lic_id, codigo, {sql.contains_case('codigo', REGIONS, "''")} AS administracao,
    {"replace(" * len(REPLACED)}{sql.contains_case('codigo', REGIONS, "''")}{"".join(f", {sql.quoted(a)}, {sql.quoted(b)})" for a, b in REPLACED)} AS rotulo FROM x"""
)
def region_lookup_case(spark, folder):
    """The administration named by a licence number's ending, and its label after chained replacements."""
    code = X.region_code(F.col("n_tua"))
    name = X.ordered_contains(F.col("codigo"), REGIONS, F.lit(""))
    rows = table(spark, folder, "licenses", "lic_id", "n_tua").select("lic_id", code.alias("codigo"))
    return rows.select("lic_id", "codigo", name.alias("administracao"), X.chained_replace(name, REPLACED).alias("rotulo"))


@query(
    r"""SELECT lic_id, 'pdf/' || replace(url_encode(file_name), '+', '%20') AS ligacao FROM licenses WHERE file_name IS NOT NULL"""
)
def file_links(spark, folder):
    """A percent-encoded link to each licence's file."""
    rows = table(spark, folder, "licenses", "lic_id", "file_name").where("file_name is not null")
    return rows.select("lic_id", X.url_path(F.concat(F.lit("pdf/"), "file_name")).alias("ligacao"))


@query(
    r"""SELECT lic_id, coalesce(CAST(round_even(try_cast(trim(replace(populacao_servida, ',', '.')) AS DOUBLE), 0)::BIGINT AS VARCHAR), '') AS populacao,
    coalesce(CAST(round_even(try_cast(trim(replace(ano_de_arranque, ',', '.')) AS DOUBLE), 0)::BIGINT AS VARCHAR), '') AS ano FROM licenses"""
)
def integers_from_text(spark, folder):
    """Population and year as whole numbers in text."""
    rows = table(spark, folder, "licenses", "lic_id", "populacao_servida", "ano_de_arranque")
    return rows.select("lic_id", as_integer(F.col("populacao_servida")).alias("populacao"), as_integer(F.col("ano_de_arranque")).alias("ano"))


@query(
    r"""WITH x AS (SELECT rej_id, try_cast(trim(replace(latitude, ',', '.')) AS DOUBLE) AS la FROM rejeicao)
    SELECT rej_id, CASE WHEN la IS NULL THEN '' ELSE replace(regexp_replace(regexp_replace(printf('%.6f', la), '0+$', ''), '\.$', ''), '.', ',') END AS latitude FROM x"""
)
def decimal_comma(spark, folder):
    """Coordinates with a decimal comma and without trailing zeros."""
    rows = table(spark, folder, "rejeicao", "rej_id", "latitude")
    return rows.select("rej_id", as_decimal(F.col("latitude")).alias("latitude"))


_QUALITY_COLS = ["n_tua", "codigo_apa", "data_de_validade", "sentido_da_decisao", "nivel_de_tratamento", "ano_de_arranque", "populacao_servida", "codmaximo"]


@query(
    "WITH x AS (" + " UNION ALL ".join(f"SELECT tua_lurh, '{c}' AS coluna, count(*) AS n, count(*) FILTER ({sql.filled(c)}) AS preenchidos FROM licenses GROUP BY tua_lurh" for c in _QUALITY_COLS)
    + ") SELECT tua_lurh, coluna, n, preenchidos, round(100.0*preenchidos/n, 1)::DOUBLE AS percentagem, CASE WHEN round(100.0*preenchidos/n, 1) >= 99 THEN 'completo' WHEN round(100.0*preenchidos/n, 1) >= 90 THEN 'quase' ELSE 'com falhas' END AS veredicto FROM x"
)
def completeness_matrix(spark, folder):
    """How far each column of the licences is filled, by regime."""
    rows = table(spark, folder, "licenses", "tua_lurh", *_QUALITY_COLS)
    return columns.completeness(rows, "tua_lurh", _QUALITY_COLS).withColumn("percentagem", F.col("percentagem").cast("double"))


@query(
    "SELECT lic_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN NOT {sql.filled(c)} THEN '{c}' END" for c in _QUALITY_COLS)
    + "], lambda x: x IS NOT NULL), ', ') AS em_falta, len(list_filter([" + ", ".join(f"CASE WHEN NOT {sql.filled(c)} THEN '{c}' END" for c in _QUALITY_COLS) + "], lambda x: x IS NOT NULL)) AS n FROM licenses"
)
def row_missing_list(spark, folder):
    """What each licence lacks."""
    names, n = columns.missing_list(_QUALITY_COLS)
    return table(spark, folder, "licenses", "lic_id", *_QUALITY_COLS).select("lic_id", names.alias("em_falta"), n.alias("n"))


@query(
    "SELECT coluna, sum(falta)::BIGINT AS n FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS coluna, count(*) FILTER (NOT {sql.filled(c)}) AS falta FROM licenses" for c in _QUALITY_COLS) + ") GROUP BY coluna HAVING sum(falta) > 0 ORDER BY n DESC, coluna LIMIT 15"
)
def top_missing_fields(spark, folder):
    """The fifteen columns most often missing."""
    rows = table(spark, folder, "licenses", *_QUALITY_COLS)
    names = F.array_compact(F.array(*[F.when(~filled(F.col(c)), F.lit(c)) for c in _QUALITY_COLS]))
    return rows.select(F.explode(names).alias("coluna")).groupBy("coluna").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "coluna").limit(15)


@query(
    f"""WITH x AS (SELECT *, {sql.date('data_de_validade')} AS d FROM licenses) SELECT 'licenses' AS tabela, g AS gravidade, m AS mensagem, n FROM (
    SELECT 'erro' AS g, 'sem número' AS m, count(*) FILTER (NOT {sql.filled('n_tua')}) AS n FROM x UNION ALL SELECT 'aviso', 'sem data legível', count(*) FILTER (d IS NULL) FROM x
    UNION ALL SELECT 'erro', 'data implausível', count(*) FILTER (year(d) NOT BETWEEN 1996 AND 2056) FROM x
    UNION ALL SELECT 'erro', 'número repetido', count(*) FROM (SELECT n_tua FROM licenses WHERE {sql.filled('n_tua')} GROUP BY n_tua HAVING count(*) > 1))
    UNION ALL SELECT 'conditions', g, m, n FROM (SELECT 'info' AS g, 'linhas' AS m, count(*) AS n FROM conditions
    UNION ALL SELECT 'erro', 'parâmetro truncado', count(*) FILTER (regexp_matches(parametro_doc, '\\([^)]*$')) FROM conditions
    UNION ALL SELECT 'aviso', 'sem código', count(*) FILTER (NOT {sql.filled('parametro')}) FROM conditions UNION ALL SELECT 'aviso', 'código desconhecido', count(*) FILTER (length(parametro) > 20) FROM conditions
    UNION ALL SELECT 'erro', 'licença inexistente', count(*) FROM (SELECT DISTINCT n_tua FROM conditions WHERE {sql.filled('n_tua')} AND n_tua NOT IN (SELECT n_tua FROM licenses WHERE n_tua IS NOT NULL)))"""
)
def quality_gate(spark, folder):
    """The constraint checks of licences and conditions as one table."""
    lic = table(spark, folder, "licenses", "n_tua", "data_de_validade")
    cond = table(spark, folder, "conditions", "n_tua", "parametro_doc", "parametro")
    return quality.licence_checks(lic, "n_tua", "data_de_validade").unionByName(quality.parameter_checks(cond, lic, "n_tua", "parametro_doc", "parametro"))


@query(
    f"""WITH {_DATED}, x AS (SELECT dg_id, list_filter([CASE WHEN NOT {sql.filled('n_licenca')} THEN 'sem número' END, CASE WHEN NOT {sql.filled('dados_gerais.requerente')} THEN 'sem requerente' END,
    CASE WHEN coalesce(fim < inicio, false) THEN 'datas trocadas' END, CASE WHEN dados_gerais.tua_lurh = 'LURH' AND fim IS NULL THEN 'sem validade' END], lambda v: v IS NOT NULL) AS r FROM dados_gerais JOIN dated USING (dg_id))
    SELECT dg_id, CASE WHEN list_contains(r, 'sem número') THEN 'FALHOU' WHEN len(r) > 0 THEN 'NOTA' ELSE 'OK' END AS veredicto, array_to_string(r, '; ') AS razoes FROM x"""
)
def extraction_verdicts(spark, folder):
    """Each document's verdict with its reasons."""
    rows = table(spark, folder, "dados_gerais", "dg_id", "tua_lurh", "n_licenca", "requerente", "data_de_inicio", "data_de_validade")
    start, end = parse_date(F.col("data_de_inicio")), parse_date(F.col("data_de_validade"))
    checks = {
        "sem número": ~filled(F.col("n_licenca")),
        "sem requerente": ~filled(F.col("requerente")),
        "datas trocadas": F.coalesce(end < start, F.lit(False)),
        "sem validade": (F.col("tua_lurh") == "LURH") & end.isNull(),
    }
    v, reasons = quality.verdict(checks, ("sem número",))
    return rows.select("dg_id", v.alias("veredicto"), reasons.alias("razoes"))


@query("SELECT v AS tua_lurh, n_ficheiros, n_chaves FROM (SELECT tua_lurh AS v, count(DISTINCT file_name) AS n_ficheiros, count(DISTINCT n_tua) AS n_chaves FROM licenses WHERE file_name NOT IN (SELECT file_name FROM conditions WHERE file_name IS NOT NULL) GROUP BY 1)")
def anti_join_missing(spark, folder):
    """Licences whose file has no conditions, by regime."""
    lic = table(spark, folder, "licenses", "tua_lurh", "file_name", "n_tua")
    rest = lic.join(table(spark, folder, "conditions", "file_name").distinct(), "file_name", "left_anti")
    return rest.groupBy("tua_lurh").agg(F.count_distinct("file_name").alias("n_ficheiros"), F.count_distinct("n_tua").alias("n_chaves"))


@query("SELECT dg_id FROM dados_gerais d WHERE NOT EXISTS (SELECT 1 FROM autocontrolo a WHERE a.file_name = d.file_name) AND NOT EXISTS (SELECT 1 FROM autocontrolo a WHERE a.n_tua = d.n_licenca)")
def anti_join_two_keys(spark, folder):
    """Documents that self-monitoring knows neither by file nor by number."""
    docs = table(spark, folder, "dados_gerais", "dg_id", "file_name", "n_licenca")
    known = table(spark, folder, "autocontrolo", "file_name", "n_tua")
    rest = docs.join(known.select("file_name").distinct(), "file_name", "left_anti")
    return rest.join(known.select(F.col("n_tua").alias("n_licenca")).distinct(), "n_licenca", "left_anti").select("dg_id")


@query(
    """WITH f AS (SELECT DISTINCT file_name FROM dados_gerais), c AS (SELECT DISTINCT file_name FROM conditions), l AS (SELECT DISTINCT file_name FROM licenses WHERE codmaximo IS NOT NULL),
    r AS (SELECT DISTINCT file_name FROM rejeicao) SELECT CASE WHEN l.file_name IS NOT NULL THEN 'com instalação' WHEN r.file_name IS NOT NULL THEN 'com ponto de rejeição' WHEN c.file_name IS NOT NULL THEN 'com condições' ELSE 'só documento' END AS etapa,
    count(*) AS n FROM f LEFT JOIN c USING (file_name) LEFT JOIN l ON l.file_name = f.file_name LEFT JOIN r ON r.file_name = f.file_name GROUP BY 1"""
)
def coverage_chain(spark, folder):
    """How far each document came: asset matched, discharge point read, conditions read, or none of these."""
    flag = lambda name, where=None: (table(spark, folder, name) if where is None else table(spark, folder, name).where(where)).select("file_name").distinct()
    docs = flag("dados_gerais")
    stages = {"l": flag("licenses", "codmaximo is not null"), "r": flag("rejeicao"), "c": flag("conditions")}
    for name, rows in stages.items():
        docs = docs.join(rows.withColumn(name, F.lit(True)), "file_name", "left")
    stage = F.when(F.col("l"), "com instalação").when(F.col("r"), "com ponto de rejeição").when(F.col("c"), "com condições").otherwise("só documento")
    return docs.groupBy(stage.alias("etapa")).agg(F.count("*").alias("n"))


@query(
    """SELECT lic_id, len(regexp_extract_all(file_name, '\\d{2}[-._]\\d{2}[-._]\\d{4}')) AS n_datas, regexp_extract(file_name, '^(TUA|LURH)', 1) AS regime,
    regexp_extract(file_name, '_(\\d{4})\\.pdf$', 1) AS ano FROM licenses"""
)
def file_name_parts(spark, folder):
    """Dates, regime and year that a file's name gives."""
    rows = table(spark, folder, "licenses", "lic_id", "file_name")
    c = F.coalesce(F.col("file_name"), F.lit(""))
    return rows.select("lic_id", F.size(file_name_dates(c)).cast("bigint").alias("n_datas"), F.regexp_extract(c, "^(TUA|LURH)", 1).alias("regime"), F.regexp_extract(c, r"_(\d{4})\.pdf$", 1).alias("ano"))


@query(
    """WITH new AS (SELECT file_name, lic_id, n_tua FROM licenses WHERE tua_lurh='TUA'), old AS (SELECT file_name, min(dg_id) AS dg_id FROM dados_gerais GROUP BY 1)
    SELECT file_name, 'nova' AS origem FROM new UNION ALL SELECT file_name, 'antiga' FROM old WHERE file_name NOT IN (SELECT file_name FROM new)"""
)
def upsert_merge(spark, folder):
    """Old rows by file, replaced by the new ones of the same file."""
    old = table(spark, folder, "dados_gerais", "file_name").distinct().withColumn("origem", F.lit("antiga"))
    new = table(spark, folder, "licenses", "file_name", "tua_lurh").where("tua_lurh = 'TUA'").select("file_name", F.lit("nova").alias("origem"))
    return records.upsert(old, new, ["file_name"])


@query(
    """WITH old AS (SELECT DISTINCT n_tua FROM licenses WHERE n_tua IS NOT NULL), new AS (SELECT DISTINCT n_licenca AS n_tua FROM dados_gerais WHERE n_licenca IS NOT NULL)
    SELECT n_tua, 'antiga' AS origem FROM old UNION ALL SELECT n_tua, 'pendente' FROM new WHERE n_tua NOT IN (SELECT n_tua FROM old)"""
)
def pending_insert_only(spark, folder):
    """Known numbers, and the pending ones that are not known yet."""
    old = table(spark, folder, "licenses", "n_tua").where("n_tua is not null").distinct().withColumn("origem", F.lit("antiga"))
    new = table(spark, folder, "dados_gerais", F.col("n_licenca").alias("n_tua")).where("n_tua is not null").distinct().withColumn("origem", F.lit("pendente"))
    return records.insert_missing(old, new, ["n_tua"])


@query(
    """WITH n AS (SELECT file_name, max(localidade) AS localidade FROM dados_gerais WHERE file_name IS NOT NULL GROUP BY 1), o AS (SELECT file_name, max(regiao_hidrografica) AS regiao, CAST(NULL AS VARCHAR) AS localidade FROM rejeicao WHERE file_name IS NOT NULL GROUP BY 1)
    SELECT coalesce(o.file_name, n.file_name) AS file_name, o.regiao, coalesce(nullif(n.localidade, ''), o.localidade) AS localidade FROM o FULL JOIN n ON o.file_name = n.file_name"""
)
def cell_upsert(spark, folder):
    """Single cells filled into a table, its other cells untouched."""
    old = table(spark, folder, "rejeicao", "file_name", "regiao_hidrografica").where("file_name is not null").groupBy("file_name").agg(F.max("regiao_hidrografica").alias("regiao")).withColumn("localidade", F.lit(None).cast("string"))
    new = table(spark, folder, "dados_gerais", "file_name", "localidade").where("file_name is not null").groupBy("file_name").agg(F.max("localidade").alias("localidade"))
    return records.fill_cells(old, new, ["file_name"], ["localidade"])


