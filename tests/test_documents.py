import json

from caudalix.sources import documents, files

A = {
    "file_name": "a.pdf",
    "dados_gerais": {"Nº TUA": "TUA1", "Estabelecimento": "ETAR Álamo"},
    "enquadramento": {"Data de Entrada em Vigor": "01-02-2020", "Data de Validade": "01/02/2025"},
    "condicoes_rejeicao": [{"Parâmetro": "pH", "VLE": "6 a 9", "Legislação aplicável": "(a)", "Avaliação da conformidade": "(x)"}],
    "legislacao": {"a": "Lei 1", "T000001": "Lei 1"},
    "avaliacao_conformidade": {"b": "regra"},
    "autocontrolo": [{"Local de amostragem": "Saída", "Parâmetro": "PH", "Frequência de amostragem": "Mensal", "Tipo de amostragem": "Composta (i)"}],
    "autocontrolo_nota": "(i) de hora a hora; (ii) outra",
    "sections": [{"code": "3.1", "title": "t", "sheet": "s", "columns": ["c"], "rows": [{"c": "1"}, {"c": "2"}]}],
}
B = {
    "file_name": "b.pdf",
    "dados_gerais": {"Requerente": "Empresa", "Data de Início": "1 jan", "Data de Validade": ""},
    "rejeicao": {"Designação da rejeição": "ETAR Beta"},
    "condicoes_texto": {"Gerais": ["um", " "], "Outras": ["dois"]},
    "condicoes_descarga": [],
    "autocontrolo": {"rows": [{"Parâmetro": "CQO"}]},
}


def read(spark, tmp_path, doc, schema):
    (tmp_path / "d.json").write_text(json.dumps(doc))
    return files.read_documents(spark, str(tmp_path / "d.json"), schema)


def test_regime_a(spark, tmp_path):
    df = read(spark, tmp_path, A, files.DOCUMENT_A)
    lic = documents.licences(df, "TUA").collect()[0]
    assert (lic["n_tua"], lic["id_versao"]) == ("TUA1", "etar alamo|01-02-2020|01-02-2025")
    c = documents.conditions(df, "TUA").collect()[0]
    assert (c["parametro_doc"], c["legislacao"], c["avaliacao"], c["frequencia"]) == ("pH", "Lei 1", "regra", "Mensal")
    assert documents.sampling(df, "TUA").collect()[0]["nota"] == "(i) de hora a hora"
    assert [r["codigo"] for r in documents.legends(df, "TUA").collect()] == ["a"]
    assert [r["linha"]["c"] for r in documents.section_rows(df).orderBy("ordem").collect()] == ["1", "2"]
    assert documents.warnings(df, "TUA").collect()[0]["avisos"] == []


def test_regime_b(spark, tmp_path):
    df = read(spark, tmp_path, B, files.DOCUMENT_B)
    lic = documents.licences(df, "LURH").collect()[0]
    assert (lic["n_tua"], lic["id_versao"]) == ("b.pdf", "etar beta||")
    assert documents.conditions(df, "LURH").count() == 0
    assert [r["texto"] for r in documents.clauses(df).orderBy("seccao").collect()] == ["um", "dois"]
    assert documents.sampling(df, "LURH").collect()[0]["parametro_doc"] == "CQO"
    assert documents.warnings(df, "LURH").collect()[0]["avisos"] == ["sem número", "sem validade", "sem condições"]
