"""PDF text and ruled tables, over documents made here."""

import zlib

from caudalix.operators.parsing import first_page_identity
from caudalix.sources import pdf


def document(contents: list[str], deflate: bool = True, to_unicode: str | None = None, packed: bool = False) -> bytes:
    """A small PDF with a page per content; ``packed`` puts the page tree into an object stream."""
    pages = range(10, 10 + len(contents))
    font = "<< /Type /Font /Subtype /Type0 /ToUnicode 5 0 R >>" if to_unicode else "<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>"
    plain = {2: f"<< /Type /Pages /Kids [{' '.join(f'{p} 0 R' for p in pages)}] /Resources << /Font << /F1 4 0 R >> >> >>", 4: font}
    plain |= {p: f"<< /Type /Page /Parent 2 0 R /Contents {p + 100} 0 R >>" for p in pages}
    out = b"%PDF-1.5\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n"

    def stream(number: int, data: bytes, extra: str = "") -> bytes:
        body = zlib.compress(data) if deflate else data
        kind = "/Filter /FlateDecode " if deflate else ""
        return f"{number} 0 obj << {extra}{kind}/Length {len(body)} >> stream\n".encode() + body + b"\nendstream endobj\n"

    if packed:
        bodies, head = "", []
        for number, body in plain.items():
            head.append(f"{number} {len(bodies)}")
            bodies += body + " "
        first = " ".join(head) + " "
        out += stream(3, (first + bodies).encode(), f"/Type /ObjStm /N {len(plain)} /First {len(first)} ")
    else:
        out += b"".join(f"{n} 0 obj {body} endobj\n".encode() for n, body in plain.items())
    if to_unicode:
        out += stream(5, to_unicode.encode())
    return out + b"".join(stream(p + 100, c.encode("cp1252")) for p, c in zip(pages, contents)) + b"%%EOF"


TABLE = """BT /F1 10 Tf 50 700 Td (Licen\\347a n.\\272 L1) Tj 0 -14 Td [(Val) -20 (idade) -400 (2030)] TJ ET
50 500 200 1 re f 50 520 200 1 re f 50 540 200 1 re f 50 500 1 41 re f 150 500 1 41 re f 250 500 1 41 re f
BT /F1 8 Tf 1 0 0 1 55 527 Tm (Par\\342metro) Tj 1 0 0 1 155 527 Tm (VLE) Tj 1 0 0 1 55 507 Tm (pH \\(20 \\260C\\)) Tj 1 0 0 1 155 507 Tm (6-9) Tj ET
BT /F1 10 Tf 12 TL 50 450 Td (Depois) Tj T* (da tabela) Tj ET"""
WANT = [("linha", "Licença n.º L1"), ("linha", "Validade 2030"), ("tabela", "Parâmetro VLE"), ("tabela", "pH (20 °C) 6-9"), ("linha", "Depois"), ("linha", "da tabela")]


def test_lines_and_ruled_rows_in_order():
    for deflate in (True, False):
        for packed in (True, False):
            got = list(pdf.read(document([TABLE, "BT /F1 10 Tf 50 700 Td (Fim) Tj ET"], deflate, None, packed)))
            assert [(kind, text) for page, _, kind, text, _ in got if page == 1] == WANT
            assert [cells for *_, kind, _, cells in got if kind == "tabela"] == [["Parâmetro", "VLE"], ["pH (20 °C)", "6-9"]]
            assert got[-1][:1] + got[-1][2:] == (2, "linha", "Fim", None)


def test_two_byte_font_with_unicode_map():
    cmap = "2 beginbfchar <0001> <0041> <0002> <00E7> endbfchar 1 beginbfrange <0010> <0012> <0061> endbfrange"
    got = list(pdf.read(document(["BT /F1 10 Tf 50 700 Td <00010002001000110012> Tj ET"], True, cmap)))
    assert [r[3] for r in got] == ["Açabc"]


def test_scan_skips_unreadable_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(document([TABLE] * 5))
    (tmp_path / "b.pdf").write_bytes(b"%PDF-1.4 broken")
    (tmp_path / "c.pdf").write_bytes(b"")
    (tmp_path / "d.pdf").write_bytes(document([TABLE]) + b"trailer << /Encrypt 9 0 R >>")
    (tmp_path / "e.pdf").write_bytes(document(["BT ET"]))
    rows = pdf.read_pdfs(spark, str(tmp_path / "*.pdf")).collect()
    assert {r["ficheiro"][-5:] for r in rows} == {"a.pdf"} and {r["pagina"] for r in rows} == {1, 2, 3, 4, 5} and len(rows) == 5 * len(WANT)
    texts = pdf.first_pages(spark, str(tmp_path / "*.pdf"), 2).collect()
    assert [r["texto"].split("\n") for r in texts] == [[t for _, t in WANT] * 2]


def test_identity_from_first_pages(spark):
    rows = [
        ("/a/x_01-02-2020_03.04.2030.pdf", "Licença\nEstabelecimento: ETAR de A\nData de emissão Data de validade\n01/01/2021 02-01-2021 03.01.2031"),
        ("/a/y.pdf", "Designação da rejeição\nETAR de B\nData  de validade\n05-05-2025 06-06-2026"),
        ("/a/z_01-02-2020_03.04.2030.pdf", "nada\nData de validade 01-01-2020"),
        ("/a/w.pdf", None),
    ]
    df = spark.createDataFrame(rows, "ficheiro string, texto string")
    got = {r["ficheiro"][3]: tuple(r)[1:] for r in first_page_identity(df, "ficheiro", "texto").collect()}
    assert got == {
        "x": ("ETAR de A", "02-01-2021", "03-01-2031", "texto"), "y": ("ETAR de B", "05-05-2025", "06-06-2026", "texto"),
        "z": ("", "01-02-2020", "03-04-2030", "nome do ficheiro"), "w": ("", "", "", "incompleta"),
    }
