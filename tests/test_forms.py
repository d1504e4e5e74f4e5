from pyspark.sql import functions as F

from caudalix.operators import criteria, forms


def test_filled_form(spark):
    labels = spark.createDataFrame([("Nome da ETAR",), ("Código",), ("Outro",)], "rotulo string")
    fields = spark.createDataFrame([("codigo", "X1", 1), ("ETAR", "Sul", 2), ("Nome", "Norte", 3)], "campo string, valor string, ordem int")
    got = {r["rotulo"]: r["valor"] for r in forms.filled_form(labels, fields).collect()}
    assert got == {"Nome da ETAR": "Sul", "Código": "X1", "Outro": None}


def test_repaired_row(spark):
    row = spark.createDataFrame([(["", "25", "T000007", "Sólidos", "(a)", "Suspensos"],)], "c array<string>").select(forms.repaired_row(F.col("c")).alias("x")).collect()[0]["x"]
    assert (row["codigo_t"], row["codigo_l"], row["referencias"], row["numero"], row["nome"]) == ("T000007", None, "(a)", "25", "Sólidos Suspensos")


def test_clean_grid():
    rows = [["3.1 Título", "", ""], ["A", "B", "", "C"], ["1", "2", "x", ""], ["A", "B", "", "C"], ["", "", "", ""], ["3", "", "y", ""]]
    assert forms.clean_grid(rows) == (["A", "B", "coluna 3"], [{"A": "1", "B": "2", "coluna 3": "x"}, {"A": "3", "B": "", "coluna 3": "y"}])
    assert forms.clean_grid([]) == ([], [])


def test_assigned_flags(spark):
    note = "nota do catálogo com bem mais de quarenta caracteres de texto"
    rows = spark.createDataFrame([(1, "p", note + " e mais", "5", ""), (2, "p", "media anual", "", "80")], "id long, p string, t string, vle string, reducao string")
    rows = rows.select("*", *criteria.flags(F.col("t")))
    rules = spark.createDataFrame([("p", note, [0, 1, 1, 0, 0, 0, 0, 0, 1])], "p string, note string, flags array<int>")
    got = {r["id"]: (r["origem"], [r[f] for f in criteria.FLAGS]) for r in forms.assigned_flags(rows, rules, "p", "t").collect()}
    assert got == {1: ("herdado", [1, 0, 1, 0, 0, 0, 0, 0, 1]), 2: ("classificado", [0, 1, 0, 0, 0, 0, 0, 1, 0])}
