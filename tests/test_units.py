from fractions import Fraction as Fr

import pytest

from caudalix.operators import units
from caudalix.operators.vocabulary import Lookup


def test_spellings_of_one_unit():
    for text in ("mg/L", "mg/l O2", "MG/L", "mg L-1", "mg.L-1 N", "mg / L", "mg/litro", "miligramas por litro"):
        assert units.unit_key(text) == "mg/l", text
    assert units.unit_key("ufc por 100 mL") == units.unit_key("UFC/100 ml") == "ufc/100ml"
    assert units.unit_key("m³/dia") == units.unit_key("metros cúbicos por dia") == "m3/d"
    assert units.unit_key("µS.cm-1") == units.unit_key("microsiemens por cm") == "us/cm"
    assert units.unit_key("g.m-3 P") == "g/m3"
    assert units.unit_key("C") == units.unit_key("graus Celsius") == units.unit_key("ºC") == "°c"
    assert units.unit_key(None) is None and units.unit_key("") is None


def test_limits():
    assert units.parse_limit("≤ 2×10^3 ufc/100 mL") == (2000.0, 2000.0, "ufc/100 mL")
    assert units.parse_limit("37 500-75000 µg/L O2") == (37500.0, 75000.0, "µg/L O2")
    assert units.parse_limit("6,5 até 8.5") == (6.5, 8.5, None)
    assert units.parse_limit("máx. 15") == (15.0, 15.0, None)
    assert units.parse_limit("5 000ufc/100 mL")[0] == 5000.0
    assert units.parse_limit("Isento") is None and units.parse_limit(None) is None


def test_compositions_and_cycles():
    table = units.compositions()
    assert table["k", "°f"] == (Fr(9, 5), Fr(-45967, 100))
    assert table["l/s", "m3/d"][0] == Fr(864, 10)
    for (a, b), (scale, offset) in table.items():
        back, shift = table[b, a]
        assert scale * back == 1 and offset * back + shift == 0
    with pytest.raises(ValueError):
        units.compositions((("a", "b", Fr(2), Fr(0)), ("b", "c", Fr(2), Fr(0)), ("a", "c", Fr(5), Fr(0))))


def test_lookup():
    lookup = Lookup([(1, "Carência Bioquímica de Oxigénio"), (1, "CBO5"), (2, "Carência Química de Oxigénio"), (3, "Azoto total"), (4, "Azoto amoniacal")])
    assert lookup("carencia bioquimica de oxigenio") == 1
    assert lookup("total azoto") == 3
    assert lookup("Carência Quím. de Ox.") == 2
    assert lookup("Azoto totla") == 3
    assert lookup("Azoto") is None and lookup("Boro") is None and lookup(None) is None and lookup("") is None


def test_unknown_units_are_reported_and_not_converted(spark, tmp_path, folder):
    from caudalix.plans import problems

    spark.read.parquet(f"{folder}/ref_valores.parquet").write.parquet(str(tmp_path / "ref_valores.parquet"))
    rows = [(1, "Carência Bioquímica de Oxigénio", "CBO5", "xyz", "25"), (2, "Carência Bioquímica de Oxigénio", "CBO5", "g/L", "0,025"), (3, "Carência Bioquímica de Oxigénio", "CBO5", "mg/L", "25")]
    schema = "cond_id long, parametro_doc string, parametro string, unidade string, vle string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "conditions.parquet"))
    assert [tuple(r) for r in problems.p5_unconnected(spark, str(tmp_path)).collect()] == [("xyz", "mg/l", 1)]
    assert [tuple(r) for r in problems.p5_found(spark, str(tmp_path)).collect()] == [(2, 25_000, 25_000)]
