"""Operators behind the report pages."""

import pytest
from pyspark.sql import functions as F

from caudalix.operators import columns, compare, lookups, measures, records
from caudalix.plans import report
from caudalix.sources import files


def test_pivot_keeps_every_value(spark):
    df = spark.createDataFrame([("a", "pH", "6"), ("a", "X", "1"), ("b", "CQO", "2"), ("b", None, "9"), ("c", "B b", None)], "k string, p string, v string")
    wide = columns.pivot_in_order(df, ["k"], "p", F.max("v"), ("CQO", "pH"))
    assert wide.columns == ["k", "CQO", "pH", "B b", "X"]
    assert {tuple(r) for r in wide.collect()} == {("a", None, "6", None, "1"), ("b", "2", None, None, None), ("c", None, None, None, None)}
    assert columns.pivot_in_order(df.where("false"), ["k"], "p", F.max("v"), ("pH",)).columns == ["k", "pH"]
    with pytest.raises(ValueError):
        columns.pivot_in_order(df, ["k"], "p", F.max("v"), (), most=2)


def test_keyword_list(spark):
    df = spark.createDataFrame([("Palavra",), (" odor ",), ("odor",), ("",), (None,), ("lamas",)], "p string")
    assert {r["palavra"] for r in lookups.keyword_list(df, "p", "palavra").collect()} == {"odor", "lamas"}


def test_only_value_and_ladder(spark):
    df = spark.createDataFrame([("a", "x", 5), ("a", "x", None), ("b", "x", 1), ("b", None, 9), ("c", "x", 2), ("c", "y", 2)], "k string, v string, n int")
    got = {r["k"]: r["v"] for r in measures.evaluate(df, ["k"], {"v": measures.only_value(F.col("v"))}).collect()}
    assert got == {"a": "x", "b": None, "c": None}
    steps = [r["s"] for r in df.select(measures.ladder(F.col("n"), ((2, "low"), (5, "mid")), "high").alias("s")).collect()]
    assert steps == ["mid", None, "low", "high", "low", "low"]


def test_first_message(spark):
    texts = ['{"type":"a"}\n\n{"type":"message","content":{"content":"x"}}\n\n{"type":"message","content":"y"}', '{"type":"message","content":"y"}', " plain ", "{broken\n\n", None, '{"type":"message"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r["m"] for r in df.orderBy("i").select(compare.first_message(F.col("t")).alias("m")).collect()] == ["x", "y", "plain", "{broken\n\n".strip(" "), None, ""]


def test_asked_stores_no_errors(spark):
    pairs = spark.createDataFrame([("1", "a", "b"), ("2", "c", "boom"), ("3", "d", "e"), ("3", "d", "e"), ("4", "f", "")], "chave string, antes string, depois string")
    answers = spark.createDataFrame([("1", "old")], "chave string, resposta string")

    def ask(before, after):
        if after == "boom":
            raise TimeoutError
        return after and f"{before}-{after}"

    new = compare.asked(pairs, answers, ask)
    assert [tuple(r) for r in new.collect()] == [("3", "d-e")]
    done = {r["chave"]: r["resposta"] for r in compare.answered(pairs.select("chave").distinct(), answers.unionByName(new)).collect()}
    assert done == {"1": "old", "2": "PENDENTE", "3": "d-e", "4": "PENDENTE"}


def test_report_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("ção <&> \x01\n2", 1.5, None), ("", -2.0, "x")], "nome string, valor double, nota string")
    path = str(tmp_path / "report.xlsx")
    files.write_workbook(spark, {"Um/dois": df, "um dois": df.where("false"), "L" * 40: df.limit(1)}, path)
    rows = files.read_workbooks(spark, path).collect()
    got = {}
    for r in rows:
        got.setdefault(r["folha"], []).append(r["celulas"])
    assert got["Um dois"] == [["nome", "valor", "nota"], ["ção <&> \n2", "1.5"], ["", "-2.0", "x"]]
    assert got["um dois (2)"] == [["nome", "valor", "nota"]] and set(got) == {"Um dois", "um dois (2)", "L" * 31}
    with pytest.raises(ValueError):
        files.write_workbook(spark, {"x": df}, path, most=1)


def test_zipped_sheets(spark):
    left = spark.createDataFrame([(3, "c", "C"), (1, "a", "A"), (2, None, "B")], "_ord long, k string, v string")
    right = spark.createDataFrame([(20, None, "y"), (10, "a", "x"), (30, "c", "z")], "_ord long, k string, w string")
    assert sorted(map(tuple, records.zipped(left, right, "_ord", ["k"]).collect())) == [(1, "a", "A", "x"), (2, None, "B", "y"), (3, "c", "C", "z")]
    for wrong in (right.where("_ord < 30"), right.withColumn("k", F.lit("a"))):
        with pytest.raises(ValueError):
            records.zipped(left, wrong, "_ord", ["k"])
    assert records.zipped(left.where("false"), right.where("false"), "_ord", ["k"]).count() == 0


def test_pairs_may_be_chosen(spark):
    df = spark.createDataFrame([("A", "2020", 1), ("A", "2021", 2), ("A", "2022", 3), ("B", "2020", 4), ("B", "2021", 5), ("C", None, 6), (None, "2020", 7)], "a string, s string, i long")
    chosen = spark.createDataFrame([("A", 2, 3)], "a string, antiga long, nova long")
    assert sorted(map(tuple, compare.oldest_and_newest(df, "a", "s", "i", chosen).collect())) == [("A", 2, 3), ("B", 4, 5)]
    assert sorted(map(tuple, compare.oldest_and_newest(df, "a", "s", "i").collect())) == [("A", 1, 3), ("B", 4, 5)]


def test_pivot_of_names_that_differ_in_case(spark, tmp_path):
    rows = [("a", "Nt", "1"), ("a", "nt", "2"), ("b", "NT", "3"), ("b", "nt (2)", "4"), ("b", "K", "5"), ("b", "nT", "6"), ("a", "E. coli", "7")]
    df = spark.createDataFrame(rows, "k string, p string, v string")
    columns.pivot_in_order(df, ["k"], "p", F.max("v"), ("Nt",)).write.parquet(str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    assert wide.columns == ["k", "Nt", "E. coli", "K (2)", "NT (3)", "nT (4)", "nt (5)", "nt (2)"]
    assert {tuple(r) for r in wide.collect()} == {("a", "1", "7", None, None, None, "2", None), ("b", None, None, "5", "3", "6", None, "4")}


def test_limits_pivoted_has_every_limit(spark, tmp_path):
    """Every cell of limits_by_parameter, over a table whose parameters differ in case, and no other."""
    rows = [(1, "T1", "CBO5", "", "25"), (2, "T1", "cbo5", "Normal", "30"), (3, "T1", "cbo5", "Estiagem", "20"), (4, "T2", "Azoto", None, "10"), (5, "T2", "azoto", "", "9"), (6, "T2", "N_TUA", "", "8"), (7, "T3", "pH", "Outro", "7")]
    spark.createDataFrame(rows, "cond_id long, n_tua string, parametro string, periodo string, vle string").write.parquet(str(tmp_path / "conditions.parquet"))
    report.limits_pivoted(spark, str(tmp_path)).write.parquet(str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    stacked = f"30{report.WET}20{report.DRY}"
    assert {r["n_tua"]: {c: v for c, v in r.asDict().items() if v is not None and c != "n_tua"} for r in wide.collect()} == {
        "T1": {"CBO5": "25", "cbo5 (2)": stacked}, "T2": {"Azoto": "10", "azoto (2)": "9", "N_TUA (2)": "8"}, "T3": {"pH": ""}
    }


def test_pivot_shuffles_no_wide_rows(spark):
    df = spark.createDataFrame([("a", "pH", "6"), ("a", "ph", "7"), ("b", None, "9")], "k string, p string, v string")
    wide = columns.pivot_in_order(df, ["k"], "p", F.max("v"), ("pH",))
    assert {tuple(r) for r in wide.collect()} == {("a", "6", "7"), ("b", None, None)}
    assert "pivotfirst" not in wide._jdf.queryExecution().executedPlan().toString().lower()
