"""Constraint queries: each gives rows (tabela, gravidade, mensagem, n); a run passes without rows of gravity erro."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudalix.functions.dates import parse_date
from caudalix.functions.numbers import number
from caudalix.functions.placeholders import filled

# Bounds of the country's coordinates with its islands.
LONGITUDES, LATITUDES = (-32.0, 0.0), (30.0, 45.0)


def _rows(counts: DataFrame, table: str, checks: dict[str, str]) -> DataFrame:
    """The named counts of a one-row table as rows; ``checks``: column -> gravity."""
    each = F.array(*[F.struct(F.lit(table).alias("tabela"), F.lit(g).alias("gravidade"), F.lit(c).alias("mensagem"), F.col(c).cast("bigint").alias("n")) for c, g in checks.items()])
    return counts.select(F.inline(each))


def licence_checks(df: DataFrame, number_col: str, valid: str, lat: str | None = None, lon: str | None = None, year: int = 2026, table: str = "licenses") -> DataFrame:
    """Blank and repeated numbers, unreadable and implausible validity dates, coordinates out of the country."""
    date = parse_date(F.col(valid))
    outside = lambda c, low, high: filled(F.col(c)) & ~F.coalesce(number(F.col(c)).between(low, high), F.lit(False))
    aggregates: dict[str, Column] = {
        "sem número": F.count_if(~filled(F.col(number_col))),
        "sem data legível": F.count_if(date.isNull()),
        "data implausível": F.count_if(~F.year(date).between(year - 30, year + 30)),
    }
    gravity = {"sem número": "erro", "sem data legível": "aviso", "data implausível": "erro"}
    for name, c, (low, high) in (("latitude fora", lat, LATITUDES), ("longitude fora", lon, LONGITUDES)):
        if c:
            aggregates[name], gravity[name] = F.count_if(outside(c, low, high)), "erro"
    plain = df.agg(*[a.alias(n) for n, a in aggregates.items()])
    repeated = df.where(filled(F.col(number_col))).groupBy(number_col).agg(F.count("*").alias("k")).agg(F.count_if(F.col("k") > 1).alias("número repetido"))
    return _rows(plain, table, gravity).unionByName(_rows(repeated, table, {"número repetido": "erro"}))


def parameter_checks(df: DataFrame, licences: DataFrame, key: str, name: str, code: str, table: str = "conditions") -> DataFrame:
    """Rows, keys without a licence, names that stop in a bracket, blank and overlong codes."""
    cut = F.col(name).rlike(r"\([^)]*$")
    plain = df.agg(
        F.count("*").alias("linhas"),
        F.count_if(cut).alias("parâmetro truncado"),
        F.count_if(~filled(F.col(code))).alias("sem código"),
        F.count_if(F.length(code) > 20).alias("código desconhecido"),
    )
    orphans = df.where(filled(F.col(key))).select(key).distinct().join(licences.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("licença inexistente"))
    return _rows(plain, table, {"linhas": "info", "parâmetro truncado": "erro", "sem código": "aviso", "código desconhecido": "aviso"}).unionByName(
        _rows(orphans, table, {"licença inexistente": "erro"})
    )


def uniform_groups(df: DataFrame, by: str) -> DataFrame:
    """grupos, tamanhos (distinct sizes), uniforme: whether all groups have the same number of rows."""
    sizes = df.groupBy(by).agg(F.count("*").alias("k"))
    return sizes.agg(F.count("*").alias("grupos"), F.count_distinct("k").alias("tamanhos"), (F.count_distinct("k") <= 1).alias("uniforme"))


def verdict(checks: dict[str, Column], fatal: tuple[str, ...]) -> tuple[Column, Column]:
    """(verdict, reasons) of each row: FALHOU where a fatal check fires, NOTA where another does, else OK."""
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))
    hard = F.arrays_overlap(reasons, F.array(*[F.lit(f) for f in fatal]))
    return F.when(hard, "FALHOU").when(F.size(reasons) > 0, "NOTA").otherwise("OK"), F.array_join(reasons, "; ")
