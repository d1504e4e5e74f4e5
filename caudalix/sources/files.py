"""File sources and sinks: delimited text, extraction documents, workbooks, file listings, versioned tables."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from decimal import Decimal
from io import BytesIO
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from caudalix.session import cut

#: Extraction documents of the first regime; the second keeps its sampling rows inside a struct.
DOCUMENT_A = (
    "file_name string, dados_gerais map<string,string>, enquadramento map<string,string>, localizacao map<string,string>, "
    "caracterizacao map<string,string>, condicoes_rejeicao array<map<string,string>>, legislacao map<string,string>, "
    "avaliacao_conformidade map<string,string>, autocontrolo array<map<string,string>>, autocontrolo_nota string, "
    "sections array<struct<code:string,title:string,sheet:string,columns:array<string>,rows:array<map<string,string>>>>, "
    "_warnings array<string>"
)
DOCUMENT_B = (
    "file_name string, dados_gerais map<string,string>, tratamento map<string,string>, rejeicao map<string,string>, "
    "condicoes_texto map<string,array<string>>, condicoes_descarga array<map<string,string>>, condicoes_observacoes map<string,string>, "
    "legislacao map<string,string>, avaliacao_conformidade map<string,string>, avaliacao_texto string, notas_numeradas map<string,string>, "
    "autocontrolo struct<rows:array<map<string,string>>>, entidade map<string,string>, _warnings array<string>"
)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, delimiter: str = ",") -> DataFrame:
    """Delimited text with header, every column text, quotes doubled, line ends inside quotes kept. A byte-order mark
    in front of the first name is dropped. A missing file gives an empty table of ``columns``."""
    if not _exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns or []]))
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"', sep=delimiter, encoding="UTF-8")
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per readable JSON document under ``path``; unreadable ones are left out."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="DROPMALFORMED")


def file_index(spark: SparkSession, folders: list[str], pattern: str = "*") -> DataFrame:
    """nome, caminho, tamanho of every file below the folders; of equal names the first folder's is kept."""
    out = None
    for rank, folder in enumerate(folders):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
        rows = found.select(F.element_at(F.split("path", "/"), -1).alias("nome"), F.col("path").alias("caminho"), F.col("length").alias("tamanho"), F.lit(rank).alias("pasta"))
        out = rows if out is None else out.unionByName(rows)
    best = out.groupBy("nome").agg(F.min(F.struct("pasta", "caminho", "tamanho")).alias("b"))
    return best.select("nome", "b.caminho", "b.tamanho")


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def workbook_rows(content: bytes) -> Iterator[tuple[str, int, list[str]]]:
    """(sheet, row number, cell texts) of a workbook in Office Open XML; cells that are left out are empty text."""
    with zipfile.ZipFile(BytesIO(content)) as z:
        names = set(z.namelist())
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            root = ElementTree.fromstring(z.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in root.findall("m:si", _NS)]
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).find("m:sheets", _NS):
            target = rels[sheet.get(_REL)].lstrip("/")
            root = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            for i, row in enumerate(root.iter(f"{{{_NS['m']}}}row"), 1):
                cells: dict[int, str] = {}
                for j, c in enumerate(row.findall("m:c", _NS)):
                    letters = re.match(r"[A-Z]+", c.get("r") or "")
                    at = sum((ord(x) - 64) * 26**k for k, x in enumerate(reversed(letters[0]))) - 1 if letters else j
                    v = c.find("m:v", _NS)
                    if c.get("t") == "s" and v is not None:
                        cells[at] = shared[int(v.text)]
                    elif c.get("t") == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
                    else:
                        cells[at] = (v.text or "") if v is not None else ""
                yield sheet.get("name"), int(row.get("r") or i), [cells.get(k, "") for k in range(max(cells, default=-1) + 1)]


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """ficheiro, folha, linha, celulas of every workbook that matches ``path``; unreadable files are left out."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                try:
                    found = [(name, *r) for r in workbook_rows(content)]
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
                    continue
                yield pd.DataFrame(found, columns=["ficheiro", "folha", "linha", "celulas"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(rows, "ficheiro string, folha string, linha long, celulas array<string>")


def sheet(rows: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """One sheet as a table of text columns: the named columns are found in its first row wherever they stand; a
    missing one is null. ``_ord`` is the row's number."""
    own = rows.where(F.col("folha") == name)
    header = own.where("linha = 1").select("ficheiro", F.col("celulas").alias("_h"))
    body = own.where("linha > 1").join(header, "ficheiro")
    at = lambda c: F.array_position(F.transform("_h", F.trim), F.lit(c)).cast("int")
    return body.select(F.col("linha").alias("_ord"), *[F.get("celulas", F.when(at(c) > 0, at(c) - 1)).alias(c) for c in columns])


def _column(at: int) -> str:
    """The letters of a sheet's column, counted from 0."""
    letters = ""
    at += 1
    while at:
        at, rest = divmod(at - 1, 26)
        letters = chr(65 + rest) + letters
    return letters


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    """A workbook in Office Open XML with the rows of each sheet; figures stay figures, all else is text, None is left
    out. Sheet names are made unique, cleaned of what they may not hold, and cut to 31 characters."""
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    names: list[str] = []
    for title in sheets:
        clean = re.sub(r"[\[\]:*?/\\]", " ", title).strip()[:31] or "Folha"
        tries = (clean, *(f"{clean[:27]} ({i})" for i in range(2, 999)))
        names.append(next(t for t in tries if t.lower() not in {n.lower() for n in names}))

    def cell(row: int, at: int, value) -> str:
        place = f'{_column(at)}{row}'
        if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
            return f'<c r="{place}"><v>{value}</v></c>'
        text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(value))
        return f'<c r="{place}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'

    out = BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", f'<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{r}">{"".join(cell(r, c, v) for c, v in enumerate(row) if v is not None)}</row>' for r, row in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def write_workbook(spark: SparkSession, sheets: dict[str, DataFrame], path: str, most: int = 50_000) -> None:
    """A report workbook: a sheet per table, its columns as header. A report is read by people: a table of more than
    ``most`` rows raises ValueError (``write_feed`` and ``write_csv`` take any)."""
    written = {}
    for name, df in sheets.items():
        rows = df.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"more than {most} rows in sheet {name}")
        written[name] = [df.columns, *map(list, rows)]
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(workbook_bytes(written)))
    finally:
        stream.close()


def write_feed(df: DataFrame, path: str) -> None:
    """Every column as text, replaced as a whole; the committer publishes it at once."""
    df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, delimiter: str = ",") -> None:
    """Delimited text with header, every column as text, quotes doubled."""
    df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).write.mode("overwrite").csv(path, header=True, sep=delimiter, quote='"', escape='"')


def write_documents(df: DataFrame, path: str, by: str | None = None) -> None:
    """One JSON object a row, in folders by ``by``."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def write_json_report(df: DataFrame, path: str, most: int = 10_000, **extra: str) -> None:
    """A report as one JSON object: the rows of a short table (a top list, alerts of one run) and fixed texts. More than
    ``most`` rows raise ValueError: a long table is written by ``write_documents``."""
    rows = cut(df)
    if (n := rows.count()) > most:
        raise ValueError(f"{n} rows in a report of at most {most}")
    listed = F.collect_list(F.struct(*rows.columns)).alias("linhas")
    rows.agg(F.count("*").alias("n"), listed).select(*[F.lit(v).alias(k) for k, v in extra.items()], "n", "linhas").coalesce(1).write.mode("overwrite").json(path)


def referenced_files(spark: SparkSession, path: str, pattern: str = r"([\w ./-]+\.(?:xlsx|csv|json|parquet))") -> DataFrame:
    """ficheiro, referido: the file names that text files mention."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("ficheiro"), "value")
    return texts.select("ficheiro", F.explode(F.array_distinct(F.regexp_extract_all("value", F.lit(pattern), 1))).alias("referido"))


def append_with_retention(df: DataFrame, path: str, stamp: str, most: int = 2_000) -> None:
    """Appends report rows, then keeps the newest ``most`` in the table; what leaves it goes to ``path``_archive.

    Of rows with one stamp those appended last stay; rows without a stamp are the oldest. Every row is in one of the two.
    """
    spark = df.sparkSession
    try:
        rows = spark.read.parquet(path).unionByName(df)
    except AnalysisException:
        rows = df
    # Each row has a number of its own, so that rows of one stamp on both sides of the limit are told apart.
    rows = cut(rows.withColumn("_row", F.monotonically_increasing_id()))
    kept = cut(rows.orderBy(F.desc_nulls_last(stamp), F.desc("_row")).limit(most))
    rest = rows.join(F.broadcast(kept.select("_row")), "_row", "left_anti").drop("_row")
    if rest.take(1):
        rest.write.mode("append").parquet(f"{path}_archive")
    kept.drop("_row").write.mode("overwrite").parquet(path)

