from pyspark.sql import functions as F

from caudalix.operators import packed


def values(spark, texts, kind):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    return [r["v"] for r in df.select("id", packed.values_of(F.col("t"), kind).alias("v")).orderBy("id").collect()]


def test_laws(spark):
    texts = [
        "Lei n.º 1/2000; Portaria n.º 2/2001;",
        'Lei n.º 1/2000; "Portaria n.º 2/2001; mapa 2"',
        "“Lei n.º 1/2000”,“Portaria n.º 2/2001”",
        "a) Lei n.º 1/2000\nb) alínea b) do n.º 1 do artigo 2.º da Lei n.º 3/2000",
        "Lei n.º 1/2000,\nde 5 de maio, alterado pelo Decreto-Lei n.º 3/2001",
        "Lei n.º 1/2000 e Portaria n.º 2/2001",
        None,
        "",
        "-",
        'Lei n.º 1/2000 "sem par; Lei n.º 2/2000',
    ]
    got = values(spark, texts, packed.LAW)
    assert got[0] == ["Lei n.º 1/2000", "Portaria n.º 2/2001"]
    assert got[1] == ["Lei n.º 1/2000", "Portaria n.º 2/2001; mapa 2"]
    assert got[2] == ["Lei n.º 1/2000", "Portaria n.º 2/2001"]
    assert got[3] == ["Lei n.º 1/2000", "alínea b) do n.º 1 do artigo 2.º da Lei n.º 3/2000"]
    assert len(got[4]) == 1
    assert len(got[5]) == 2
    assert got[6] == got[7] == got[8] == []
    assert len(got[9]) == 2


def test_limits(spark):
    texts = ["57,5 ¦ 30", "10 mg / L", "Normal: 20 / Estiagem: 82,5", "6,0 a 9,0", '"72,5","110"', "20 e 140", "30\n110", "5,0 - 9,5 / 5,0 - 9,0"]
    got = values(spark, texts, packed.LIMIT)
    assert [len(v) for v in got] == [2, 1, 2, 1, 2, 2, 2, 2]
    assert got[4] == ["72,5", "110"]


def test_assessments(spark):
    texts = ["1. Um caso. 2. Outro caso.", "(a) Um (b) Dois (c) Três", "- Um.\n- Dois.", "Uma frase com\ncontinuação"]
    got = values(spark, texts, packed.ASSESSMENT)
    assert got[0] == ["Um caso.", "Outro caso."]
    assert got[1] == ["Um", "Dois", "Três"]
    assert got[2] == ["Um.", "Dois."]
    assert len(got[3]) == 1


def test_unpack_edges(spark):
    df = spark.createDataFrame([(1, "1; 2", "x"), (1, "1; 2", "x"), (2, None, None), (3, "a" * 200_000, "y")], "id long, vle string, campo string")
    out = packed.unpack(df, "id", {"vle": packed.LIMIT}).collect()
    assert len(out) == 4 and {r["posicao"] for r in out} == {1, 2}
    assert packed.unpack(df.where("false"), "id", {"vle": packed.LIMIT}).count() == 0
