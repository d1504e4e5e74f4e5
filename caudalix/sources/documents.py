"""Extraction documents (nested, two regimes) to flat row sets.

Regime A keeps its sampling rows in an array and its dates in ``enquadramento``; regime B keeps them in a struct and in
``dados_gerais``. Every row carries the document's number and its version identity. Positions start at 1 and follow
the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudalix.functions.fold import fold_ascii
from caudalix.functions.text import identity_norm, sampling_note
from caudalix.operators.parsing import resolved


def _get(c: str, *names: str) -> Column:
    """The first filled value of a label/value section under any of the names."""
    return F.coalesce(*[F.nullif(F.trim(F.try_element_at(c, F.lit(n))), F.lit("")) for n in names], F.lit(""))


def _day(c: Column) -> Column:
    found = r"(\d{2})[-/.](\d{2})[-/.](\d{4})"
    return F.when(c.rlike(found), F.concat_ws("-", *[F.regexp_extract(c, found, i) for i in (1, 2, 3)])).otherwise("")


def identity_a() -> Column:
    name = _get("dados_gerais", "Estabelecimento", "Designação", "Requerente")
    return F.concat_ws("|", identity_norm(name), _day(_get("enquadramento", "Data de Entrada em Vigor")), _day(_get("enquadramento", "Data de Validade")))


def identity_b() -> Column:
    name = F.coalesce(F.nullif(_get("rejeicao", "Designação da rejeição"), F.lit("")), _get("dados_gerais", "Requerente"))
    return F.concat_ws("|", identity_norm(name), _day(_get("dados_gerais", "Data de Início")), _day(_get("dados_gerais", "Data de Validade")))


def number_a() -> Column:
    return F.coalesce(F.nullif(_get("dados_gerais", "Nº TUA"), F.lit("")), F.col("file_name"))


def number_b() -> Column:
    return F.coalesce(F.nullif(_get("dados_gerais", "Nº Licença"), F.lit("")), F.col("file_name"))


def licences(df: DataFrame, regime: str) -> DataFrame:
    """One licence row per document."""
    a = regime == "TUA"
    section = "enquadramento" if a else "dados_gerais"
    return df.select(
        "file_name",
        F.lit(regime).alias("tua_lurh"),
        (number_a() if a else number_b()).alias("n_tua"),
        (identity_a() if a else identity_b()).alias("id_versao"),
        (_get("dados_gerais", "Estabelecimento") if a else _get("rejeicao", "Designação da rejeição")).alias("estabelecimento"),
        _get(section, "Data de Entrada em Vigor", "Data de Início").alias("inicio"),
        _get(section, "Data de Validade").alias("validade"),
    )


def _rows(df: DataFrame, regime: str, array: str) -> DataFrame:
    a = regime == "TUA"
    keep = [c for c in ("legislacao", "avaliacao_conformidade", "autocontrolo_nota") if c in df.columns]
    return df.select((number_a() if a else number_b()).alias("n_tua"), (identity_a() if a else identity_b()).alias("id_versao"), *keep, F.posexplode(array).alias("_p", "r")).withColumn("ordem", (F.col("_p") + 1).cast("bigint")).drop("_p")


def conditions(df: DataFrame, regime: str) -> DataFrame:
    """One row per discharge condition, its markers resolved against the document's legends, with the sampling of the
    outlet for the same parameter (the last such row)."""
    rows = _rows(df, regime, "condicoes_rejeicao" if regime == "TUA" else "condicoes_descarga")
    out = rows.select(
        "n_tua", "id_versao", "ordem",
        _get("r", "Parâmetro").alias("parametro_doc"), _get("r", "VLE").alias("vle"), _get("r", "Regime", "Período").alias("periodo"),
        resolved(_get("r", "Legislação aplicável"), F.coalesce("legislacao", F.create_map().cast("map<string,string>"))).alias("legislacao"),
        resolved(_get("r", "Avaliação da conformidade"), F.coalesce("avaliacao_conformidade", F.create_map().cast("map<string,string>"))).alias("avaliacao"),
        fold_ascii(_get("r", "Parâmetro")).alias("_k"),
    )
    taken = sampling(df, regime).where(fold_ascii(F.col("local")).startswith("saida")).withColumn("_k", fold_ascii(F.col("parametro_doc")))
    last = taken.groupBy("id_versao", "_k").agg(F.max(F.struct("ordem", "frequencia", "tipo")).alias("s"))
    return out.join(last, ["id_versao", "_k"], "left").select(*[c for c in out.columns if c != "_k"], F.col("s.frequencia").alias("frequencia"), F.col("s.tipo").alias("tipo"))


def sampling(df: DataFrame, regime: str) -> DataFrame:
    """One row per sampling obligation; the footnote's phrase only where the type carries its marker."""
    rows = _rows(df, regime, "autocontrolo" if regime == "TUA" else "autocontrolo.rows")
    kind = _get("r", "Tipo de amostragem")
    note = sampling_note(kind, F.col("autocontrolo_nota")) if "autocontrolo_nota" in rows.columns else F.lit("")
    return rows.select(
        "n_tua", "id_versao", "ordem", _get("r", "Local de amostragem").alias("local"), _get("r", "Parâmetro").alias("parametro_doc"),
        _get("r", "Frequência de amostragem").alias("frequencia"), kind.alias("tipo"), note.alias("nota"),
    )


def legends(df: DataFrame, regime: str, column: str = "legislacao") -> DataFrame:
    """One row per legend text: of equal texts the one with the shortest code is kept."""
    number, identity = (number_a(), identity_a()) if regime == "TUA" else (number_b(), identity_b())
    rows = df.select(number.alias("n_tua"), identity.alias("id_versao"), F.explode(column).alias("codigo", "texto")).where(F.trim("texto") != "")
    best = rows.groupBy("n_tua", "id_versao", "texto").agg(F.min(F.struct(F.length("codigo").alias("l"), "codigo")).alias("b"))
    return best.select("n_tua", "id_versao", F.col("b.codigo").alias("codigo"), "texto")


def clauses(df: DataFrame) -> DataFrame:
    """One row per clause of regime B's general, specific and other conditions."""
    sections = df.select(number_b().alias("n_tua"), identity_b().alias("id_versao"), F.explode("condicoes_texto").alias("seccao", "textos"))
    rows = sections.select("n_tua", "id_versao", "seccao", F.posexplode("textos").alias("_p", "texto"))
    return rows.where(F.trim("texto") != "").select("n_tua", "id_versao", "seccao", (F.col("_p") + 1).cast("bigint").alias("ordem"), F.trim("texto").alias("texto"))


def section_rows(df: DataFrame) -> DataFrame:
    """The generic sections of regime A stacked: number, section code and title, row position, and the row as a map."""
    s = df.select(number_a().alias("n_tua"), F.explode("sections").alias("s"))
    return s.select("n_tua", F.col("s.code").alias("codigo"), F.col("s.title").alias("titulo"), F.posexplode("s.rows").alias("_p", "linha")).withColumn("ordem", (F.col("_p") + 1).cast("bigint")).drop("_p")


def warnings(df: DataFrame, regime: str) -> DataFrame:
    """What a document lacks, as an array: number, identity dates, conditions."""
    a = regime == "TUA"
    rows = "condicoes_rejeicao" if a else "condicoes_descarga"
    section = "enquadramento" if a else "dados_gerais"
    found = F.array_compact(
        F.array(
            F.when(_get("dados_gerais", "Nº TUA", "Nº Licença") == "", "sem número"),
            F.when(_get(section, "Data de Validade") == "", "sem validade"),
            F.when(F.coalesce(F.size(rows), F.lit(0)) <= 0, "sem condições"),
        )
    )
    return df.select("file_name", found.alias("avisos"))


def license_flags_text(flags: list[str], labels: dict[str, str]) -> Column:
    """A bullet list of the labels of the flags that are set somewhere in the group, empty text without any."""
    active = F.array_compact(F.array(*[F.when(F.sum(f) >= 1, F.concat(F.lit("• "), F.lit(labels[f]))) for f in flags]))
    return F.array_join(active, "\n")
