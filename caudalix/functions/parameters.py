"""The parameter vocabularies of the feed. They disagree on purpose: each serves another table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caudalix.functions.fold import fold_ascii, let
from caudalix.functions.text import collapse, ordered_contains

# Fragment of a folded name without blanks -> short code; the first that fits wins.
SHORT_CODES = [
    ("carenciabioquimicadeoxigenio", "CBO5"), ("carenciaquimicadeoxigenio", "CQO"),
    ("totaldeparticulassolidasemsuspensao", "SST"), ("solidossuspensostotais", "SST"), ("oleosegorduras", "O&G"),
    ("azotoamoniacal", "N-NH4"), ("azotokjeldahl", "N-Kjeldahl"), ("azototal", "Nt"), ("azototatotal", "Nt"),
    ("azototot", "Nt"), ("fosforototal", "Pt"), ("escherichiacoli", "E. coli"),
    ("enterococosintestinais", "Enterococos"), ("enterecocosintestinais", "Enterococos"), ("coliformesfecais", "CF"),
    ("nitratos", "NO3"), ("nitritos", "NO2"), ("fosfatos", "PO4"), ("fenois", "Fenóis"), ("cromiototal", "Cr total"),
    ("detergentes", "Detergentes"), ("oxigenio", "O2"), ("caudal", "Caudal"), ("ph", "pH"),
]
# Fragment of a folded name -> catalogue name; the first that fits wins.
CATALOGUE = [
    ("carencia bioquimica", "CBO5"), ("cbo5", "CBO5"), ("carencia quimica", "CQO"), ("cqo", "CQO"),
    ("solidos suspensos", "SST"), ("particulas solidas em suspensao", "SST"), ("sst", "SST"),
    ("azoto amoniacal", "Azoto amoniacal"), ("azoto total", "Nt"), ("fosforo total", "Pt"),
    ("escherichia coli", "E. coli"), ("e. coli", "E. coli"), ("coliformes fecais", "Coliformes fecais"),
    ("oleos e gorduras", "Óleo e gorduras"), ("fenois", "Fenóis"), ("caudal", "Caudal"), ("ph", "pH"),
]
# Fragment of a padded lower-case name -> join key; the first that fits wins.
JOIN_KEYS = [
    ("cbo", "CBO5"), ("cqo", "CQO"), ("sst", "SST"), ("ph", "pH"), ("gordur", "O&G"), ("oleo", "O&G"),
    ("azoto", "N"), (" n ", "N"), ("fosforo", "P"), ("coliform", "CF"), ("coli", "E.coli"),
]
# Fragment of a lower-case name with accents -> name used when two licences are compared.
COMPARED = [
    ("cbo", "CBO5"), ("bioquímica", "CBO5"), ("bioquimica", "CBO5"), ("cqo", "CQO"), ("química", "CQO"),
    ("quimica", "CQO"), ("sólidos suspensos", "SST"), ("solidos suspensos", "SST"), ("sst", "SST"), ("ph", "pH"),
    ("azoto amoniacal", "N-NH4"), ("amoniacal", "N-NH4"), ("azoto total", "N-total"), ("azoto", "N-total"),
    ("fósforo", "P-total"), ("fosforo", "P-total"), ("coliformes", "Coliformes"), ("óleos", "Óleos e gorduras"),
]
# Two names as the documents cut them -> code.
CUT_NAMES = [("Carência Bioquímica de", "CBO5"), ("Carência Química de", "CQO")]


def name_key(c: Column) -> Column:
    return F.regexp_replace(fold_ascii(F.coalesce(c, F.lit(""))), r"[^a-z0-9]+", "")


def abbreviate(c: Column) -> Column:
    """Short code of a full name; unknown names stay, blanks collapsed."""
    return ordered_contains(name_key(c), SHORT_CODES, collapse(c))


def normalise_unit(c: Column) -> Column:
    """mg/L, mL, ufc and m³ in one spelling."""
    u = collapse(c)
    for pattern, spelled in ((r"(?i)\bmg/l\b", "mg/L"), (r"(?i)\bml\b", "mL"), (r"(?i)\bufc\b", "ufc"), (r"(?i)\bm3\b", "m³")):
        u = F.regexp_replace(u, pattern, spelled)
    return u


def split_parameter(c: Column) -> tuple[Column, Column, Column]:
    """(short code, unit, period): the unit is the last bracket once the dry-season mark is off."""
    text = collapse(c)
    period = F.when(name_key(text).contains("estiagem"), "Estiagem").otherwise("Normal")
    bare = F.regexp_replace(text, r"(?i)\(\s*per[íi]odo de estiagem\s*\)", " ")
    groups = F.regexp_extract_all(bare, F.lit(r"\(([^()]*)\)"), 1)
    unit = F.coalesce(normalise_unit(F.try_element_at(groups, F.lit(-1))), F.lit(""))
    name = F.regexp_replace(collapse(F.regexp_replace(bare, r"\([^()]*\)", " ")), r"^[ –—-]+|[ –—-]+$", "")
    return F.when(text == "", "").otherwise(abbreviate(name)), unit, period


def laboratory_key(c: Column) -> Column:
    """The name laboratories use."""

    def named(n: Column) -> Column:
        return (
            F.when(n.contains("bioqu"), "CBO5")
            .when(n.contains("quimica") | (n == "cqo"), "CQO")
            .when(n.contains("solidos") | n.contains("suspenso"), "SST")
            .when(n.contains("oleos") | n.contains("gordura"), "O&G")
            .when(n.contains("azoto"), "N")
            .when(n.contains("fosforo"), "P")
            .when(n.startswith("ph") | n.contains("sorensen"), "pH")
        )

    return F.coalesce(let(fold_ascii(F.coalesce(c, F.lit(""))), named), F.trim(c))


def join_key(c: Column) -> Column:
    """Padded lower-case lookup; else the first twelve characters."""
    n = F.concat(F.lit(" "), F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")), F.lit(" "))
    return ordered_contains(n, JOIN_KEYS, F.substring(F.trim(F.coalesce(c, F.lit(""))), 1, 12))


def catalogue_name(c: Column) -> Column:
    """Catalogue name shared by both regimes; blank names are Desconhecido."""
    default = F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("Desconhecido"))
    return ordered_contains(fold_ascii(F.coalesce(c, F.lit(""))), CATALOGUE, default)


def compared_name(c: Column) -> Column:
    """Name under which two licences' parameters meet; accents count."""
    return ordered_contains(F.lower(F.coalesce(c, F.lit(""))), COMPARED, F.trim(F.coalesce(c, F.lit(""))))


def base_name(c: Column) -> Column:
    """Text in front of the first bracket."""
    return F.trim(F.split_part(F.coalesce(c, F.lit("")), F.lit("("), F.lit(1)))


def cut_name(c: Column) -> Column:
    """Trimmed name; the two names known to be cut become their code, blank becomes null."""
    text = F.trim(c)
    out = F.when(text != "", text)
    for name, code in CUT_NAMES:
        out = F.when(text == name, code).otherwise(out)
    return out
