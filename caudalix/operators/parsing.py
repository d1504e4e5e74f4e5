"""Tables from document text: lines, labels, sections, legends, ruled grids and limit rows.

What a window or a higher-order function can say stays in the JVM. Only the readers of ruled grids and of loose limit
lines walk through a document in Python, grouped by document (a document was one row before).
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudalix.functions.fold import fold_ascii
from caudalix.functions.placeholders import strip
from caudalix.functions.pytext import fold_text
from caudalix.operators.lookups import forward_filled


def lines(df: DataFrame, doc: str, text: str) -> DataFrame:
    """doc, linha (from 1), texto of every line of every document that is not blank; null texts give no row."""
    split = df.select(doc, F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("pos", "texto"))
    return split.where(F.trim("texto") != "").select(doc, (F.col("pos") + 1).cast("bigint").alias("linha"), F.trim("texto").alias("texto"))


def labelled(lines_: DataFrame, doc: str, labels: list[str]) -> DataFrame:
    """doc, rotulo, valor: the text behind each label and on the lines up to the next one.

    A line has the longest label it starts with (folded); the first occurrence of a label in a document is kept.
    """
    known = F.array(*[F.struct(F.length(F.lit(fold_text(x))).alias("len"), F.lit(x).alias("label"), F.lit(fold_text(x)).alias("key")) for x in labels])
    folded = fold_ascii(F.col("texto"))
    hit = F.array_max(F.filter(known, lambda x: folded.startswith(x["key"])))
    marked = lines_.withColumn("rotulo", hit["label"]).withColumn("inicio", F.when(F.col("rotulo").isNotNull(), F.col("linha")))
    filled = forward_filled(forward_filled(marked, doc, "linha", "inicio", "bloco"), doc, "linha", "rotulo", "dono")
    rest = F.when(F.col("rotulo").isNotNull(), F.regexp_replace(F.expr("substring(texto, length(rotulo) + 1)"), r"^\s*[:.-]?\s*", "")).otherwise(F.col("texto"))
    parts = filled.where("bloco is not null").select(doc, "bloco", F.col("dono").alias("rotulo"), "linha", rest.alias("parte"))
    blocks = parts.groupBy(doc, "rotulo", "bloco").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("linha", "parte"))), lambda x: x["parte"]), " ").alias("valor")
    )
    first = blocks.groupBy(doc, "rotulo").agg(F.min_by("valor", "bloco").alias("valor"))
    return first.select(doc, "rotulo", strip(F.col("valor")).alias("valor"))


def sections(lines_: DataFrame, doc: str, marker: str) -> DataFrame:
    """``lines_`` with ``seccao``: the last line at or before each that matches ``marker``; null before the first."""
    opened = lines_.withColumn("_m", F.when(F.col("texto").rlike(marker), F.col("texto")))
    return forward_filled(opened, doc, "linha", "_m", "seccao").drop("_m")


def legend(c: Column) -> Column:
    """map marker -> text of ``(a) ... (b) ...`` in a legend; of a repeated marker the first is kept. Null gives an
    empty map."""
    text = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    marks = F.regexp_extract_all(text, F.lit(r"\(([a-z0-9])\)\s*(?=\S)"), 1)
    texts = F.slice(F.split(text, r"\([a-z0-9]\)"), 2, F.size(marks))
    pairs = F.zip_with(marks, texts, lambda k, v: F.struct(k.alias("key"), F.trim(v).alias("value")))
    unique = F.filter(pairs, lambda p, i: F.array_position(F.transform(pairs, lambda x: x["key"]), p["key"]) == i + 1)
    return F.map_from_entries(unique)


def resolved(cell: Column, legend_map: Column) -> Column:
    """The texts a cell's markers stand for, joined by `` | ``; an undefined marker is the only text of a legend of one,
    else stays as it is."""
    keys = F.regexp_extract_all(F.coalesce(cell, F.lit("")), F.lit(r"\(([a-z0-9])\)|(T\d{6})"), 0)
    names = F.transform(keys, lambda k: F.regexp_replace(k, r"[()]", ""))
    only = F.when(F.size(legend_map) == 1, F.get(F.map_values(legend_map), 0))
    return F.array_join(F.transform(names, lambda k: F.coalesce(F.try_element_at(legend_map, k), only, k)), " | ")


def markers_moved_up(df: DataFrame, group: str, order: str, name: str, law: str) -> DataFrame:
    """Repairs rows whose markers slipped into the next row's name: where a row has no law and the next row's name
    starts with ``(b) (1)``-style markers, they become this row's law and leave that name."""
    marks = r"^((?:\([a-z0-9]\)\s*)+)"
    w = Window.partitionBy(group).orderBy(order)
    own_blank = F.coalesce(F.trim(F.col(law)), F.lit("")) == ""
    next_marks = F.trim(F.regexp_extract(F.coalesce(F.lead(name).over(w), F.lit("")), marks, 1))
    before_blank = F.coalesce(F.lag(own_blank).over(w), F.lit(False))
    moved = df.withColumn("_law", F.when(own_blank & (next_marks != ""), next_marks).otherwise(F.col(law)))
    moved = moved.withColumn("_name", F.when(before_blank, F.trim(F.regexp_replace(F.coalesce(F.col(name), F.lit("")), marks, ""))).otherwise(F.col(name)))
    return moved.withColumns({law: F.col("_law"), name: F.col("_name")}).drop("_law", "_name")


def without_repeated_tail(text: str, least: int = 7, most: int = 30) -> str:
    """Text without a tail of ``least`` to ``most`` words that stood before in it; then it ends in a full stop."""
    words = text.split()
    for k in range(min(most, len(words) // 2), least - 1, -1):
        tail = words[-k:]
        if any(words[j : j + k] == tail for j in range(len(words) - k)):
            return " ".join(words[:-k]).rstrip(" ,;.") + "."
    return text


def grid_records(df: DataFrame, doc: str, headers: dict[str, str], fields: list[str]) -> DataFrame:
    """Records of ruled tables: doc, ordem and ``fields`` from rows (doc, linha, celulas).

    ``headers``: folded fragment of a header cell -> field. A row with two header cells or more (re)defines which
    column is which, also in the middle of a document. A row whose first field is blank goes on with the one before;
    text in front of the first full row waits for it. Rows before any header are left out.
    """
    kind = df.schema[doc].dataType.simpleString()

    def read(group: pd.DataFrame) -> pd.DataFrame:
        columns: dict[int, str] = {}
        out: list[dict] = []
        waiting = ""
        for cells in group.sort_values("linha")["celulas"]:
            cells = [c or "" for c in cells]
            found = {i: f for i, c in enumerate(cells) for part, f in headers.items() if part in fold_text(c)}
            if len(found) >= 2:
                columns = found
                continue
            row = {f: cells[i].strip() for i, f in columns.items() if i < len(cells)}
            if not any(row.values()):
                continue
            first, rest = row.get(fields[0], ""), [v for f, v in row.items() if f != fields[0] and v]
            if first and not rest:  # a name's part on its own waits for its values
                waiting = f"{waiting} {first}".strip()
            elif not first and out:
                for f, v in row.items():
                    if v:
                        out[-1][f] = f"{out[-1].get(f, '')} {v}".strip()
            else:
                out.append(row | {fields[0]: f"{waiting} {first}".strip()})
                waiting = ""
        made = pd.DataFrame([{f: r.get(f, "") for f in fields} for r in out], columns=fields)
        made.insert(0, "ordem", range(1, len(made) + 1))
        made.insert(0, doc, group[doc].iloc[0])
        return made

    schema = f"`{doc}` {kind}, ordem long, " + ", ".join(f"`{f}` string" for f in fields)
    return df.select(doc, "linha", "celulas").groupBy(doc).applyInPandas(read, schema)


_FIGURE = r"[≤<>]?\s*\d+(?:[.,]\d+)?(?:\s*(?:-|–|a)\s*\d+(?:[.,]\d+)?)?"
_ONE_LINE = re.compile(rf"^(?P<name>\D.*?(?:\)|[A-Za-zÀ-ÿ]))\s+(?P<limit>{_FIGURE})(?:\s+(?P<cut>\d{{1,3}})\s*%)?\s*(?P<marks>(?:\([a-z0-9]\)\s*)*)$")
_ONLY_FIGURE = re.compile(rf"^{_FIGURE}$")
_ONLY_SHARE = re.compile(r"^(\d{1,3})\s*%$")
_ONLY_MARKS = re.compile(r"^(?:\([a-z0-9]\)\s*)+$")


def limit_rows_of(texts: list[str]) -> list[tuple[str, str, str, str]]:
    """(name, limit, minimum reduction in %, markers) of limit lines: joined on one line, or one cell a line."""
    out: list[list[str]] = []
    name: list[str] = []
    for text in (t.strip() for t in texts):
        if found := _ONE_LINE.match(text):
            out.append([" ".join([*name, found["name"]]), found["limit"].strip(), found["cut"] or "", found["marks"].strip()])
            name = []
        elif _ONLY_SHARE.match(text) and out and not name:
            out[-1][2] = out[-1][2] or _ONLY_SHARE.match(text)[1]
        elif _ONLY_MARKS.match(text) and out and not name:
            out[-1][3] = f"{out[-1][3]} {text}".strip()
        elif _ONLY_FIGURE.match(text) and name:
            out.append([" ".join(name), text, "", ""])
            name = []
        elif text:
            name.append(text)
    return [tuple(x) for x in out]


def limit_rows(lines_: DataFrame, doc: str) -> DataFrame:
    """doc, ordem, parametro, vle, reducao, marcas of the limit lines of each document (lines: doc, linha, texto)."""
    kind = lines_.schema[doc].dataType.simpleString()

    def read(group: pd.DataFrame) -> pd.DataFrame:
        rows = limit_rows_of(group.sort_values("linha")["texto"].tolist())
        made = pd.DataFrame(rows, columns=["parametro", "vle", "reducao", "marcas"])
        made.insert(0, "ordem", range(1, len(made) + 1))
        made.insert(0, doc, group[doc].iloc[0])
        return made

    return lines_.select(doc, "linha", "texto").groupBy(doc).applyInPandas(read, f"`{doc}` {kind}, ordem long, parametro string, vle string, reducao string, marcas string")


def repeated_records(lines_: DataFrame, doc: str, known: str, width: int) -> DataFrame:
    """Rows of a table whose cells stand one a line: doc, ordem, celulas. A line that matches ``known`` (a sampling
    place, say) opens a row of at most ``width`` cells; further lines go to the last cell."""
    opened = lines_.withColumn("_o", F.col("texto").rlike(known).cast("int"))
    numbered = opened.withColumn("ordem", F.sum("_o").over(Window.partitionBy(doc).orderBy("linha")).cast("bigint")).where("ordem > 0")
    cells = numbered.groupBy(doc, "ordem").agg(F.transform(F.array_sort(F.collect_list(F.struct("linha", "texto"))), lambda x: x["texto"]).alias("c"))
    last = F.array_join(F.slice(F.col("c"), width, 1_000), " ")
    return cells.select(doc, "ordem", F.when(F.size("c") <= width, F.col("c")).otherwise(F.concat(F.slice("c", 1, width - 1), F.array(last))).alias("celulas"))


def best_reader(first: DataFrame, second: DataFrame, doc: str) -> DataFrame:
    """Of two readers' rows those of the one with more rows for the document; the first wins ties."""
    n1, n2 = first.groupBy(doc).agg(F.count("*").alias("n1")), second.groupBy(doc).agg(F.count("*").alias("n2"))
    counts = n1.join(n2, doc, "full").fillna(0, ["n1", "n2"])
    use_first = counts.where("n1 >= n2").select(doc)
    return first.join(use_first, doc, "left_semi").unionByName(second.join(use_first, doc, "left_anti"))


def file_name_dates(c: Column) -> Column:
    """The valid dates ``dd[-./_]mm[-./_]yyyy`` in a file name, in order."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(\d{2}[-._]\d{2}[-._]\d{4})"), 1)
    dates = F.transform(found, lambda x: F.try_to_date(F.regexp_replace(x, r"[._]", "-"), "dd-MM-yyyy"))
    return F.filter(dates, lambda d: d.isNotNull() & F.year(d).between(1900, 2100))


# What stands in front of a plant's name on a document's first pages, folded, and of its dates.
NAME_LABELS = ("estabelecimento", "designacao da rejeicao")
DATES_LABEL = r"(?i)data\s+de\s+validade"


def first_page_identity(df: DataFrame, name: str, text: str) -> DataFrame:
    """name, estabelecimento, vigor, validade, fonte of documents, from the text of their first pages (lines).

    The plant's name stands behind its label or on the next line. Of the dates behind the last "data de validade" the
    second and third count (after the one of issue), of two both; without two the file name's first and last. ``fonte``
    says where the dates are from (texto, nome do ficheiro, incompleta). Null texts have none.
    """
    texts = F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n"), lambda x: F.trim(x) != ""), F.trim)
    numbered = F.transform(texts, lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    first = F.get(F.filter(numbered, lambda s: fold_ascii(s["x"]).rlike(f"^(?:{'|'.join(NAME_LABELS)})")), 0)
    behind = F.trim(F.regexp_replace(first["x"], r"^[^:]*:", ""))
    own = F.when((behind != "") & ~fold_ascii(behind).isin(*NAME_LABELS), behind).otherwise(F.get(texts, first["i"] + 1))
    parts = F.split(F.coalesce(text, F.lit("")), DATES_LABEL)
    dates = F.regexp_extract_all(F.element_at(parts, -1), F.lit(r"\b(\d{2}[-/.]\d{2}[-/.]\d{4})\b"), 1)
    at = lambda i: F.regexp_replace(F.get(dates, i), "[/.]", "-")
    start = F.when(F.size("_d") >= 3, at(1)).when(F.size("_d") == 2, at(0))
    end = F.when(F.size("_d") >= 3, at(2)).when(F.size("_d") == 2, at(1))
    day = lambda d: F.date_format(d, "dd-MM-yyyy")
    named = file_name_dates(F.element_at(F.split(name, "/"), -1))
    found = df.withColumn("_d", F.when(F.size(parts) > 1, dates).otherwise(F.array().cast("array<string>"))).withColumn("_n", named)
    by_name = F.size("_n") >= 2
    return found.select(
        name,
        F.coalesce(own, F.lit("")).alias("estabelecimento"),
        F.coalesce(start, F.when(by_name, day(F.get("_n", 0))), F.lit("")).alias("vigor"),
        F.coalesce(end, F.when(by_name, day(F.element_at("_n", -1))), F.lit("")).alias("validade"),
        F.when(start.isNotNull(), "texto").when(by_name, "nome do ficheiro").otherwise("incompleta").alias("fonte"),
    )
