import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from caudalix.sources import files
from caudalix.streaming import inbox


def workbook() -> bytes:
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} {rel}><sheets><sheet name="Um" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml" Type="x"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>Nome</t></si><si><t>ETAR</t></si></sst>")
        z.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>Valor</t></is></c></row><row r="2"><c r="A2" t="s"><v>1</v></c><c r="C2"><v>7</v></c></row></sheetData></worksheet>',
        )
    return out.getvalue()


def test_workbook_csv_json(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook())
    (tmp_path / "b.xlsx").write_bytes(b"broken")
    rows = files.read_workbooks(spark, str(tmp_path / "*.xlsx"))
    assert [tuple(r) for r in files.sheet(rows, "Um", ["Valor", "Nome", "Falta"]).collect()] == [(2, "7", "ETAR", None)]
    (tmp_path / "c.csv").write_bytes("\ufeffa,b\n\"x\ny\",\"q\"\"q\"\n".encode())
    df = files.read_csv(spark, str(tmp_path / "c.csv"))
    assert df.columns == ["a", "b"] and [tuple(r) for r in df.collect()] == [("x\ny", 'q"q')]
    assert files.read_csv(spark, str(tmp_path / "none.csv"), ["a"]).count() == 0
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "1.json").write_text(json.dumps({"file_name": "f", "condicoes_rejeicao": [{"Parâmetro": "pH"}]}))
    (docs / "2.json").write_text("{broken")
    read = files.read_documents(spark, str(docs), files.DOCUMENT_A)
    assert [r["file_name"] for r in read.collect()] == ["f"]
    index = files.file_index(spark, [str(docs)], "*.json")
    assert {r["nome"] for r in index.collect()} == {"1.json", "2.json"}


def test_inbox_upserts_late_rows_and_runs_twice(spark, tmp_path):
    box = tmp_path / "in"
    accepted, review = inbox.UpsertTable(spark, str(tmp_path / "ok"), ["k"]), inbox.UpsertTable(spark, str(tmp_path / "rev"), ["k"])
    schema = "k string, v int, t int"
    drop = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(box))
    work = inbox.upsert_batches(["k"], [F.col("t"), F.col("v")], F.col("v") >= 0, accepted, review)

    def run():
        inbox.run_once(inbox.arrivals(spark, str(box), schema, "*.parquet"), work, str(tmp_path / "progress"))

    drop([("a", 1, 1), ("a", 2, 2), ("b", 5, 1), ("bad", -1, 1)])
    run()
    drop([("b", 6, 0), ("c", 7, 1)])
    run()
    run()
    assert sorted((r["k"], r["v"]) for r in accepted.read().collect()) == [("a", 2), ("b", 6), ("c", 7)]
    assert [r["k"] for r in review.read().collect()] == ["bad"]


def test_inbox_keeps_the_order_of_late_files(spark, tmp_path):
    """Two files out of order, a batch each: the older event arrives last and replaces nothing, in deltas and bases."""
    box, schema, order = tmp_path / "in", "k string, v int, t int", [F.col("t")]
    for every in (50, 1):
        accepted, review = (inbox.UpsertTable(spark, str(tmp_path / f"{n}{every}"), ["k"], every, order) for n in ("ok", "rev"))
        work = inbox.upsert_batches(["k"], order, F.lit(True), accepted, review)
        for n, rows in enumerate([[("a", 2, 9), ("b", 1, 1)], [("a", 1, 3), ("b", 2, 1), ("c", 1, None)], [("c", 2, None)]]):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(box))
            inbox.run_once(inbox.arrivals(spark, str(box), schema, "*.parquet", files=1), work, str(tmp_path / f"progress{every}-{n}"))
            if n == 0:
                first = accepted.numbers("delta")
            # Each drop has a progress of its own here, so its number is given by the table.
            work = (lambda run, n: lambda batch, _: run(batch, n))(inbox.upsert_batches(["k"], order, F.lit(True), accepted, review), n + 1)
        assert first and sorted((r["k"], r["v"]) for r in accepted.read().collect()) == [("a", 2), ("b", 2), ("c", 2)]


def test_upsert_table_compacts(spark, tmp_path):
    t = inbox.UpsertTable(spark, str(tmp_path / "t"), ["k"], compact_every=3)
    assert t.read() is None
    for n in range(8):
        t.write(spark.createDataFrame([(f"k{n % 3}", n)], "k string, v int"), n)
        t.write(spark.createDataFrame([(f"k{n % 3}", n)], "k string, v int"), n)
    assert sorted((r["k"], r["v"]) for r in t.read().collect()) == [("k0", 6), ("k1", 7), ("k2", 5)]
    assert t.numbers("base") == [2, 5] and t.numbers("delta") == [3, 4, 5, 6, 7]


def test_report_retention(spark, tmp_path):
    path = str(tmp_path / "report")
    for i in range(3):
        files.append_with_retention(spark.createDataFrame([(f"t{i}{j}", i) for j in range(2)], "stamp string, n int"), path, "stamp", most=3)
    assert sorted(r["stamp"] for r in spark.read.parquet(path).collect()) == ["t11", "t20", "t21"]
    assert sorted(r["stamp"] for r in spark.read.parquet(f"{path}_archive").collect()) == ["t00", "t01", "t10"]


def test_report_retention_of_shared_and_missing_stamps(spark, tmp_path):
    path, schema = str(tmp_path / "report"), "stamp string, n int"
    for i in range(2):
        files.append_with_retention(spark.createDataFrame([("t", 10 * i + j) for j in range(5)] + [(None, 100 + i)], schema), path, "stamp", most=3)
    kept, archived = ([r["n"] for r in spark.read.parquet(p).collect()] for p in (path, f"{path}_archive"))
    assert len(kept) == 3 and sorted(kept + archived) == [*range(5), *range(10, 15), 100, 101]
    assert set(kept) <= set(range(10, 15))


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 'x"y\nz'), ("b", 2, None)], "k string, n int, t string")
    files.write_csv(df, str(tmp_path / "csv"))
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "csv")).orderBy("k").collect()] == [("a", "1", 'x"y\nz'), ("b", "2", None)]
    files.write_documents(df, str(tmp_path / "docs"), "k")
    assert spark.read.json(str(tmp_path / "docs")).count() == 2
    files.write_json_report(df, str(tmp_path / "report"), titulo="t")
    assert spark.read.json(str(tmp_path / "report")).collect()[0]["n"] == 2
    with pytest.raises(ValueError):
        files.write_json_report(df, str(tmp_path / "long"), most=1)
    files.write_feed(df, str(tmp_path / "feed"))
    assert spark.read.parquet(str(tmp_path / "feed")).where("t = ''").count() == 1
    (tmp_path / "model.txt").write_text("let a = File(data/Licenses.xlsx), b = x.csv")
    assert {r["referido"] for r in files.referenced_files(spark, str(tmp_path / "model.txt")).collect()} >= {"data/Licenses.xlsx"}
