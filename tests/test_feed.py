"""Scenarios of the feed: folding, parameters, limits, dates, versions, matching."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caudalix.functions import numbers as N
from caudalix.functions import parameters as P
from caudalix.functions import text as X
from caudalix.functions.dates import parse_date
from caudalix.operators import citations, columns, compare, criteria, lookups, measures, parsing, records
from caudalix.operators.skew import salted_join


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "c string").select(build(F.col("c")).alias("x")).collect()[0]["x"]


def test_folding_variants(spark):
    assert one(spark, "ETAR de Sto. Álvaro", X.asset_key) == "ETARSTOALVARO"
    assert one(spark, "ETAR de Sto. Álvaro", X.asset_key_bare) == "SANTOALVARO"
    assert one(spark, "ETAR  Cardigos ", X.identity_norm) == "etar cardigos"
    assert one(spark, None, X.identity_norm) == ""
    assert one(spark, "Artigo n.º 5 , da Lei .", X.legal_norm) == "artigo n5,da lei"
    assert one(spark, "a b/c(d).pdf", X.url_path) == "a%20b/c%28d%29.pdf"
    assert one(spark, "gradagem \nmecânica secundári\no", X.dewrap) == "gradagem mecânica secundário"
    assert one(spark, "Composta (ii)", lambda c: X.sampling_note(c, F.lit("(i) um; (ii) dois. Resto"))) == "(ii) dois"
    assert one(spark, "|X|", X.checkbox) == "Sim"
    assert one(spark, "a / b / c", X.third_place) == "b"


def joined_lines(text):
    """The feed's own fold, line by line."""
    out, boundary = "", True
    for line in (text or "").split("\n"):
        part = line.strip()
        if part:
            out = part if not out else out + (" " if boundary else "") + part
            boundary = line != line.rstrip()
    return " ".join(out.split())


def test_wrapped_lines_of_every_document(spark, folder):
    from caudalix.plans import registry

    odd = ["a \n \nb", "a\n \nb", "a\u00a0\nb", "a\u2028\nb\r\nc", "\n\n", " x\u00a0 y ", "\x1c a\x85", None, ""]
    for text in odd:
        assert one(spark, text, X.dewrap) == joined_lines(text), text
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["texto"] for r in registry.QUERIES["dewrapped_texts"](spark, folder).collect()}
    assert sum("\n" in (t or "") for t in docs.values()) > len(docs) / 2
    assert got == {k: joined_lines(t) for k, t in docs.items()}


def test_reporting_labels(spark):
    for text, label in (("Mensalmente", "Mensal"), ("semestral", "Semestral"), ("Trimestral", "Trimestral"), ("Quinzenal", "A verificar"), (None, "Não especificada")):
        assert one(spark, text, X.reporting_period) == label
    for text, label in (("no SILiAmb", "Plataforma SILiAmb"), ("e-mail", "E-mail"), ("em papel", "Em Papel"), ("", "Não especificado")):
        assert one(spark, text, X.reporting_format) == label
    assert one(spark, " Carência Química de ", P.cut_name) == "CQO" and one(spark, "", P.cut_name) is None


def test_parameter_split(spark):
    row = spark.createDataFrame([("Carência Bioquímica de Oxigénio (período de estiagem) (mg/l O2)",)], "c string").select(*P.split_parameter(F.col("c"))).collect()[0]
    assert tuple(row) == ("CBO5", "mg/L O2", "Estiagem")


def test_limits(spark):
    assert one(spark, "6,0 a 9,0", N.clean_limit) == "6,0 - 9,0"
    low, high = (one(spark, "6,0 a 9,0", lambda c, i=i: N.limit_bounds(c)[i]) for i in (0, 1))
    assert (low, high) == (6.0, 9.0)
    assert one(spark, "2,5", N.as_integer) == "2" and one(spark, "x", N.as_integer) == ""
    assert one(spark, "38.100", N.as_decimal) == "38,1"


@pytest.mark.parametrize(
    "text,day",
    [("27-01-2026", "2026-01-27"), ("27/01/2026", "2026-01-27"), ("7.1.2026", "2026-01-07"), ("2026-01-27 00:00:00", "2026-01-27"), ("1 de março de 2005", "2005-03-01"), ("31-02-2024", None), ("s/d", None), (None, None)],
)
def test_dates(spark, text, day):
    got = one(spark, text, parse_date)
    assert got == (dt.date.fromisoformat(day) if day else None)


def test_versions_and_picks(spark):
    df = spark.createDataFrame([(1, "A", dt.date(2020, 1, 1)), (2, "A", dt.date(2021, 1, 1)), (3, "A", dt.date(2021, 1, 1)), (4, "A", None), (5, None, None)], "id long, asset string, start date")
    got = {r["id"]: r["vigencia"] for r in records.versions(df, "asset", F.col("start"), "id").collect()}
    assert got == {1: "Histórico", 2: "Atual", 3: "Histórico", 4: "Histórico", 5: "Atual"}
    last = records.pick_last(df, ["asset"], [F.col("start"), F.col("id")], ["asset", "id"]).collect()
    assert {r["asset"]: r["id"] for r in last} == {"A": 3, None: 5}


def test_ordinals_of_a_hot_group(spark):
    df = spark.range(2_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"))
    got = records.ordinals(df.repartition(7), ["g"], ["id"]).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["id"]):
        by[r["g"]] = by.get(r["g"], 0) + 1
        assert r["ordem"] == by[r["g"]]
    assert records.ordinals(df.where("false"), ["g"], ["id"]).count() == 0


def test_upserts(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert sorted(map(tuple, records.upsert(old, new, ["k"]).collect())) == [("a", 1), ("b", 3), ("c", 4)]
    assert sorted(map(tuple, records.insert_missing(old, new, ["k"]).collect())) == [("a", 1), ("b", 2), ("c", 4)]


def test_lookups(spark):
    left = spark.createDataFrame([("ABCDEF",), ("XABCDEX",), (None,), ("ABC",)], "a string")
    right = spark.createDataFrame([("BCDEF",), ("ABCDE",), ("ZZZZZ",)], "b string")
    got = {tuple(r) for r in lookups.containing(left, "a", right, "b").collect()}
    assert got == {("ABCDEF", "BCDEF"), ("ABCDEF", "ABCDE"), ("XABCDEX", "ABCDE")}
    rows = spark.createDataFrame([("p", ["media", "anual"]), ("p", ["outra"]), ("q", ["x"])], "param string, w array<string>")
    rules = spark.createDataFrame([("p", ["anual"], "C1"), ("p", ["dobro"], "C2")], "param string, w array<string>, v string")
    got = {(r["param"], tuple(r["w"])): r["v"] for r in lookups.by_words(rows, rules, "param", "w", "v").collect()}
    assert got == {("p", ("media", "anual")): "C1", ("p", ("outra",)): "C1; C2", ("q", ("x",)): "not found"}
    note = "uma nota com mais de quarenta caracteres sobre a regra"
    texts = spark.createDataFrame([("p", f"antes {note} depois"), ("p", "igual"), ("q", note)], "param string, t string")
    known = spark.createDataFrame([("p", note, "R1"), ("p", "igual", "R2")], "param string, note string, v string")
    got = {(r["param"], r["t"][:5]): r["v"] for r in lookups.inherited(texts, known, "param", "t", "note", "v").collect()}
    assert got == {("p", "antes"): "R1", ("p", "igual"): "R2", ("q", "uma n"): None}


def test_salted_join(spark):
    big = spark.createDataFrame([(i, "hot" if i % 2 else None) for i in range(20)], "id long, k string")
    got = salted_join(big, spark.createDataFrame([("hot", 7)], "k string, v int"), ["k"], "id").collect()
    assert len(got) == 20 and {r["v"] for r in got if r["k"]} == {7} and {r["v"] for r in got if not r["k"]} == {None}


def test_criteria_round_trip(spark):
    rows = spark.createDataFrame(
        [(1, "L1", "E1", "pH (x)", "pH", "6", "n", "lei", "a media mensal"), (2, "L1", "E1", "pH (x)", "pH", "10", None, None, "dobro do VLE"), (3, "L2", None, "SST", "SST", None, "n", "lei", None)],
        "row_id long, licenca string, estabelecimento string, parametro_doc string, parametro string, vle string, nota string, legislacao string, avaliacao string",
    )
    rows = rows.select("*", *criteria.flags(F.col("avaliacao")))
    star = criteria.normalise(rows, "X")
    back = criteria.flatten(star).drop("estabelecimento", "nota")
    want = rows.fillna("").drop("estabelecimento", "nota")
    assert sorted(map(tuple, back.select(*sorted(back.columns)).collect())) == sorted(map(tuple, want.select(*sorted(back.columns)).collect()))
    assert all(r["n"] == 0 for r in criteria.integrity(star).collect())
    assert {r["id_criterio"] for r in star.catalogue.where("parametro = 'pH'").collect()} == {"X_PH_1", "X_PH_2"}


def test_citations(spark):
    cited = lambda text: one(spark, text, citations.citations)
    got = cited("Lei n.º 58/2005 e Decreto-Lei n.º 152/97, com as alterações introduzidas pelo Decreto-Lei n.º 348/98 e 149/2004 (Quadro 1). Lei 58/2005")
    assert [g["diploma"] for g in got] == ["Lei 58/2005", "DL 152/97"]
    assert got[1]["alteracoes"] == ["DL 348/98", "DL 149/2004"] and got[1]["tipo"] == "Decreto-Lei" and got[1]["numero"] == "152/97"
    assert cited("sem nada") == [] and cited(None) == [] and cited("") == []
    early = cited("com as alterações introduzidas pelos n.os 1 / 99 e 2/2000. A Portaria n.º 3/2001 e o artigo 4.º da Portaria 3/2001")
    assert [(g["diploma"], g["alteracoes"]) for g in early] == [("Portaria 3/2001", ["DL 1/99", "DL 2/2000"])]
    ended = cited("DL 7/90; Decreto Regulamentar n.º 5/2009, com as alterações introduzidas pela Lei n.º 6/2010, e o Decreto-Lei n.º 9/2011. Resolução 8/2012 e o Decreto-Lei n.º 9/2011")
    assert [(g["diploma"], g["alteracoes"]) for g in ended] == [("DR 5/2009", ["DL 6/2010"]), ("DL 9/2011", []), ("Resolução 8/2012", [])]
    assert len(cited("Lei 1/2000 " * 500)) == 1


def test_parsing(spark):
    lines = spark.createDataFrame([("d", 1, "Nome: ETAR"), ("d", 2, "do Sul"), ("d", 3, "Código X1"), ("d", 4, "Nome: outra")], "doc string, linha long, texto string")
    got = {r["rotulo"]: r["valor"] for r in parsing.labelled(lines, "doc", ["Nome", "Código"]).collect()}
    assert got == {"Nome": "ETAR do Sul", "Código": "X1"}
    assert one(spark, "(a) Lei um (b) Lei dois (a) outra", parsing.legend) == {"a": "Lei um", "b": "Lei dois"}
    assert one(spark, "(b)(c)", lambda c: parsing.resolved(c, parsing.legend(F.lit("(a) um (b) dois")))) == "dois | c"
    rows = spark.createDataFrame([("d", 1, "pH", ""), ("d", 2, "(b) (1) CQO", "(a)")], "doc string, n long, nome string, lei string")
    fixed = [tuple(r)[2:] for r in parsing.markers_moved_up(rows, "doc", "n", "nome", "lei").orderBy("n").collect()]
    assert fixed == [("pH", "(b) (1)"), ("CQO", "(a)")]
    grid = spark.createDataFrame(
        [("d", 1, ["Parâmetro", "VLE"]), ("d", 2, ["Sólidos", ""]), ("d", 3, ["Suspensos", "35"]), ("d", 4, ["", "mg/L"]), ("d", 5, ["VLE", "Parâmetro"]), ("d", 6, ["25", "CBO5"])], "doc string, linha long, celulas array<string>"
    )
    got = [tuple(r)[2:] for r in parsing.grid_records(grid, "doc", {"parametro": "p", "vle": "v"}, ["p", "v"]).orderBy("ordem").collect()]
    assert got == [("Sólidos Suspensos", "35 mg/L"), ("CBO5", "25")]
    assert parsing.limit_rows_of(["CBO5 (mg/L) 25 70 % (a)", "Sólidos", "Suspensos", "35", "90 %", "(b)"]) == [("CBO5 (mg/L)", "25", "70", "(a)"), ("Sólidos Suspensos", "35", "90", "(b)")]
    assert parsing.without_repeated_tail("um dois tres quatro cinco seis sete um dois tres quatro cinco seis sete") == "um dois tres quatro cinco seis sete."


def test_measures_partition(spark):
    as_of = F.lit("2024-06-30").cast("date")
    df = spark.createDataFrame([(dt.date(2024, 6, 29),), (dt.date(2024, 6, 30),), (dt.date(2025, 2, 28),), (dt.date(2025, 3, 1),), (None,)], "v date")
    r = measures.evaluate(df, [], measures.date_measures(F.col("v"), as_of)).collect()[0]
    assert (r["antes"], r["na_janela"], r["depois"], r["sem_data"], r["total"]) == (1, 2, 1, 1, 5)


def test_compare(spark):
    schema = "k string, vle string, texto string, criterios array<string>"
    old = spark.createDataFrame([("a", "1", "Lei n.º 1.", None), ("b", "1", "x", ["c1"]), ("c", "1", "x", None)], schema)
    new = spark.createDataFrame([("a", "2", "Lei nº 1", None), ("b", "1", "y", ["c1", "c2"]), ("d", "1", "x", None)], schema)
    got = {r["k"]: (r["estado"], r["mais"]) for r in compare.compared(old, new, ["k"]).collect()}
    assert got == {"a": ("provável sem alteração", ""), "b": ("altera", "c2"), "c": ("removido", ""), "d": ("novo", "")}


def test_columns(spark):
    df = spark.createDataFrame([("x", "-", None), ("x", "1", "n/a")], "g string, a string, b string")
    got = {r["coluna"]: r["preenchidos"] for r in columns.completeness(df, "g", ["a", "b"]).collect()}
    assert got == {"a": 1, "b": 0}
    assert columns.ordered(df, ["b", "zz"]).columns == ["b", "g", "a"]
    assert columns.inserted(df, "g", {"n": F.lit(1)}).columns == ["g", "n", "a", "b"]
    assert columns.without(df, "^[ab]$").columns == ["g"]
    assert [tuple(r) for r in columns.placeholders_emptied(df).collect()] == [("x", "", ""), ("x", "1", "")]


def test_licences_compared_by_their_criteria(spark):
    from caudalix.plans import registry

    rows = registry.QUERIES["criteria_compared"](spark, "/root/testdata/sf0.01").collect()
    states = {r["estado"] for r in rows}
    assert {"altera", "sem alteração"} <= states
    assert all((r["mais"] + r["menos"] != "") == (r["estado"] == "altera") for r in rows)
    assert one(spark, "média mensal, dobro do VLE", criteria.labels) == ["VLE", "≤100% VLE (dobro)", "média mensal ≤ VLE"]
    assert one(spark, "s/d", criteria.labels) is None
