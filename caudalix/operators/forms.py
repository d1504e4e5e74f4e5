"""Forms and ruled rows: filling fields by label, repairing shifted rows, cleaning section grids, rule inheritance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudalix.functions.text import header_key
from caudalix.operators.criteria import FLAGS
from caudalix.operators.lookups import containing, inherited


def filled_form(labels: DataFrame, fields: DataFrame) -> DataFrame:
    """Which field fills each label of a form: rotulo, campo, valor; null where none does.

    labels: rotulo. fields: campo, valor, ordem (unique). The same folded text first, else the first field in order
    of which one text contains the other (three characters or more).
    """
    a = labels.select("rotulo", header_key(F.col("rotulo")).alias("_a")).distinct()
    b = fields.select("campo", "valor", "ordem", header_key(F.col("campo")).alias("_b"))
    exact = a.join(b, F.col("_a") == F.col("_b")).select("rotulo", F.struct(F.lit(0).alias("r"), "ordem", "campo", "valor").alias("x"))
    pairs = containing(a, "_a", b, "_b", 3)
    near = a.join(pairs, "_a").join(b, "_b").select("rotulo", F.struct(F.lit(1).alias("r"), "ordem", "campo", "valor").alias("x"))
    best = exact.unionByName(near).groupBy("rotulo").agg(F.min("x").alias("x"))
    return a.join(best, "rotulo", "left").select("rotulo", "x.campo", "x.valor")


def repaired_row(cells: Column) -> Column:
    """struct(codigo_t, codigo_l, referencias, numero, nome) of a row whose cells slipped: each cell is told by what it
    looks like. Of several of a kind the first is taken; texts are joined."""
    kept = F.filter(F.transform(cells, F.trim), lambda c: c != "")
    is_t = lambda c: c.rlike(r"^T\d{6}$")
    is_l = lambda c: c.rlike(r"^L\d{6}\.\d{4}")
    is_ref = lambda c: c.rlike(r"^(?:\([a-z0-9]\)\s*)+$")
    is_number = lambda c: c.rlike(r"^[≤<>]?\s*\d[\d.,\s–-]*$")
    other = F.filter(kept, lambda c: ~(is_t(c) | is_l(c) | is_ref(c) | is_number(c)))
    return F.struct(
        F.get(F.filter(kept, is_t), 0).alias("codigo_t"),
        F.get(F.filter(kept, is_l), 0).alias("codigo_l"),
        F.array_join(F.filter(kept, is_ref), " ").alias("referencias"),
        F.get(F.filter(kept, is_number), 0).alias("numero"),
        F.array_join(other, " ").alias("nome"),
    )


def clean_grid(rows: list[list[str]], least: int = 2) -> tuple[list[str], list[dict[str, str]]]:
    """(columns, records) of a section's ruled rows. The header is the first row with the most filled cells among the
    first three; repeated headers and blank rows go; a nameless column needs ``least`` values to stay, and a column
    without any value goes."""
    rows = [[(c or "").strip() for c in r] for r in rows]
    rows = [r for r in rows if any(r)]
    if not rows:
        return [], []
    width = max(map(len, rows))
    rows = [r + [""] * (width - len(r)) for r in rows]
    head = max(range(min(3, len(rows))), key=lambda i: (sum(map(bool, rows[i])), -i))
    header, body = rows[head], [r for i, r in enumerate(rows) if i > head and r != rows[head]]
    keep = [i for i in range(width) if (n := sum(bool(r[i]) for r in body)) and (header[i] or n >= least)]
    names: list[str] = []
    for i in keep:
        name = header[i] or f"coluna {i + 1}"
        names.append(name if name not in names else f"{name} {names.count(name) + 1}")
    return names, [{n: r[i] for n, i in zip(names, keep)} for r in body]


def assigned_flags(rows: DataFrame, rules: DataFrame, param: str, text: str) -> DataFrame:
    """``rows`` (with the flags classified from the text) where a catalogue rule's flags take their place.

    rules: param, note, flags (array<int>), unique by param and note. The first two flags say whether the row has a
    limit (vle) and a least reduction (reducao), whoever set them. ``origem`` tells herdado from classificado.
    """
    found = inherited(rows, rules, param, text, "note", "flags").withColumnRenamed("flags", "_f")
    joined = rows.join(found, [param, text], "left")
    has = lambda c: (F.coalesce(F.trim(F.col(c)), F.lit("")) != "").cast("int")
    own = {f: F.coalesce(F.get("_f", i), F.col(f)) for i, f in enumerate(FLAGS)} | {FLAGS[0]: has("vle"), FLAGS[1]: has("reducao")}
    origin = F.when(F.col("_f").isNotNull(), "herdado").otherwise("classificado")
    return joined.withColumns(own | {"origem": origin}).drop("_f")
