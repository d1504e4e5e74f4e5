"""Text and ruled tables of PDF documents, in reading order, without a PDF library.

Documents are read as binary files and worked out one by one on the executors. Understood are classic and compressed
objects, deflated or plain content, simple and two-byte fonts with or without a Unicode map, text positions, and rules
drawn as lines or rectangles. Encrypted and broken files give no row.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "ficheiro string, pagina int, ordem int, tipo string, texto string, celulas array<string>"

_TOKEN = re.compile(
    rb"(?P<skip>(?:[\x00\t\n\x0c\r ]|%[^\r\n]*)+)|(?P<open><<|\[)|(?P<close>>>|\])|<(?P<hex>[0-9A-Fa-f\s]*)>|/(?P<name>[^\x00\t\n\x0c\r ()<>\[\]{}/%]*)"
    rb"|(?P<ref>\d+\s+\d+\s+R(?![A-Za-z]))|(?P<number>[+-]?(?:\d+\.?\d*|\.\d+))|(?P<text>\()|(?P<word>[^\x00\t\n\x0c\r ()<>\[\]{}/%]+)|(?P<other>.)",
    re.DOTALL,
)
_ESCAPES = {ord("n"): b"\n", ord("r"): b"\r", ord("t"): b"\t", ord("b"): b"\b", ord("f"): b"\f"}


class Name(str):
    """A name of the document's own language, as against a text."""


class Word(str):
    """An operator or keyword."""


@dataclass(frozen=True)
class Ref:
    number: int


def _text(data: bytes, at: int) -> tuple[bytes, int]:
    """The string whose inside starts at ``at``, and where it ends."""
    out, depth = bytearray(), 1
    while at < len(data):
        c = data[at]
        at += 1
        if c == 0x5C and at < len(data):  # a backslash
            c = data[at]
            at += 1
            if found := re.match(rb"[0-7]{1,3}", data[at - 1 : at + 2]):
                out.append(int(found[0], 8) & 0xFF)
                at += len(found[0]) - 1
            elif c not in (0x0A, 0x0D):
                out += _ESCAPES.get(c, bytes([c]))
            continue
        depth += (c == 0x28) - (c == 0x29)
        if not depth:
            break
        out.append(c)
    return bytes(out), at


def tokens(data: bytes, at: int = 0) -> Iterator[tuple[object, int]]:
    """Values and operators in order, each with the place behind it; arrays are lists, dictionaries dicts."""
    stack: list[list] = []
    while at < len(data):
        found = _TOKEN.match(data, at)
        kind, raw, at = found.lastgroup, found[found.lastgroup], found.end()
        if kind in ("skip", "other"):
            continue
        if kind == "open":
            stack.append([])
            continue
        if kind == "close":
            if not stack:
                continue
            inner = stack.pop()
            value = inner if raw == b"]" else {k: v for k, v in zip(inner[::2], inner[1::2]) if isinstance(k, str)}
        elif kind == "text":
            value, at = _text(data, at)
        elif kind == "hex":
            digits = re.sub(rb"\s", b"", raw)
            value = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        elif kind == "name":
            value = Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda m: bytes([int(m[1], 16)]), raw).decode("latin-1"))
        elif kind == "ref":
            value = Ref(int(raw.split()[0]))
        elif kind == "number":
            value = float(raw)
        else:
            value = Word(raw.decode("latin-1"))
        if stack:
            stack[-1].append(value)
        else:
            yield value, at


class Document:
    """The objects of a file by number; ``ValueError`` for what is no readable PDF."""

    def __init__(self, data: bytes):
        if not data.startswith(b"%PDF") or re.search(rb"/Encrypt\s+\d+\s+\d+\s+R", data):
            raise ValueError("no readable PDF")
        self.objects: dict[int, tuple[object, bytes | None]] = {}
        for found in re.finditer(rb"(?<!\d)(\d+)\s+\d+\s+obj\b", data):
            value, at = next(tokens(data, found.end()), (None, found.end()))
            stream = re.compile(rb"\s*stream\r?\n").match(data, at)
            content = None
            if stream and isinstance(value, dict):
                length = value.get("Length")
                end = stream.end() + int(length) if isinstance(length, float) else -1
                if end < 0 or not re.match(rb"\s*endstream", data[end : end + 20]):
                    end = data.find(b"endstream", stream.end())
                content = data[stream.end() : end]
            self.objects[int(found[1])] = (value, content)
        for value, content in list(self.objects.values()):
            if isinstance(value, dict) and value.get("Type") == "ObjStm" and content is not None:
                packed, first = self._decoded(value, content), int(value.get("First", 0))
                head = [int(x) for x, _ in tokens(packed[:first]) if isinstance(x, float)]
                for number, offset in zip(head[::2], head[1::2]):
                    self.objects.setdefault(number, (next(tokens(packed, first + offset), (None, 0))[0], None))

    def get(self, value: object) -> object:
        for _ in range(20):
            if not isinstance(value, Ref):
                return value
            value = self.objects.get(value.number, (None, None))[0]
        return None

    def _decoded(self, info: dict, content: bytes) -> bytes:
        filters = self.get(info.get("Filter")) or []
        for name in filters if isinstance(filters, list) else [filters]:
            if name != "FlateDecode":
                return b""
            content = zlib.decompressobj().decompress(content)
        return content

    def stream(self, ref: object) -> bytes:
        info, content = self.objects.get(ref.number, (None, None)) if isinstance(ref, Ref) else (None, None)
        return self._decoded(info, content) if content is not None else b""

    def pages(self) -> list[dict]:
        """The pages in order, with the resources they inherit."""
        roots = [v for v, _ in self.objects.values() if isinstance(v, dict) and v.get("Type") == "Catalog"]
        out: list[dict] = []

        def walk(ref: object, inherited: object, depth: int) -> None:
            node = self.get(ref)
            if not isinstance(node, dict) or depth > 50:
                return
            resources = node.get("Resources", inherited)
            if node.get("Type") == "Page":
                out.append(node | {"Resources": resources})
            for kid in self.get(node.get("Kids")) or []:
                walk(kid, resources, depth + 1)

        if roots:
            walk(roots[-1].get("Pages"), None, 0)
        return out

    def fonts(self, page: dict) -> dict[str, Font]:
        resources = self.get(page.get("Resources")) or {}
        return {name: self._font(self.get(ref) or {}) for name, ref in (self.get(resources.get("Font")) or {}).items()}

    def _font(self, info: dict) -> Font:
        wide = info.get("Subtype") == "Type0"
        codes: dict[int, str] = {}
        listed: list = []
        for value, _ in tokens(self.stream(info.get("ToUnicode"))):
            if isinstance(value, Word):
                if value == "endbfchar":
                    codes |= {int.from_bytes(a, "big"): b.decode("utf-16-be", "ignore") for a, b in zip(listed[::2], listed[1::2])}
                elif value == "endbfrange":
                    for a, b, to in zip(listed[::3], listed[1::3], listed[2::3]):
                        low, high = int.from_bytes(a, "big"), int.from_bytes(b, "big")
                        for i in range(low, min(high, low + 0xFFFF) + 1):
                            start = to[i - low] if isinstance(to, list) and i - low < len(to) else to
                            if isinstance(start, bytes):
                                shift = 0 if isinstance(to, list) else i - low
                                codes[i] = (start[:-2] + (int.from_bytes(start[-2:], "big") + shift).to_bytes(2, "big")).decode("utf-16-be", "ignore")
                listed = []
            elif isinstance(value, (bytes, list)):
                listed.append(value)
        return Font(wide, codes)


@dataclass(frozen=True)
class Font:
    wide: bool
    codes: dict[int, str]

    def read(self, raw: bytes) -> str:
        step = 2 if self.wide else 1
        numbers = [int.from_bytes(raw[i : i + step], "big") for i in range(0, len(raw), step)]
        plain = lambda n: "" if self.wide else bytes([n]).decode("cp1252", "ignore")
        return "".join(self.codes.get(n) or plain(n) for n in numbers)


@dataclass
class Page:
    """Text runs (x, y, size, text) and rules (x0, y0, x1, y1) of a page."""

    runs: list[tuple[float, float, float, str]] = field(default_factory=list)
    rules: list[tuple[float, float, float, float]] = field(default_factory=list)


def _times(a: tuple, b: tuple) -> tuple:
    return (
        a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3],
        a[4] * b[0] + a[5] * b[2] + b[4], a[4] * b[1] + a[5] * b[3] + b[5],
    )


def interpret(content: bytes, fonts: dict[str, Font]) -> Page:
    """What a page's operators draw."""
    page, whole = Page(), (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)
    place, line, text, saved = whole, whole, whole, []
    font, size, leading, point = Font(False, {}), 1.0, 0.0, (0.0, 0.0)
    args: list = []

    def show(raw: object) -> None:
        nonlocal text
        if isinstance(raw, bytes) and (said := font.read(raw)):
            at = _times(text, place)
            height = size * (abs(at[3]) or abs(at[1]) or 1.0)
            page.runs.append((at[4], at[5], height, said))
            # Half the size is a fair mean width; positions of most documents are set anew for each run.
            text = _times((1, 0, 0, 1, 0.5 * size * len(said), 0), text)

    def rule(x0: float, y0: float, x1: float, y1: float) -> None:
        a, b = _times((1, 0, 0, 1, x0, y0), place)[4:], _times((1, 0, 0, 1, x1, y1), place)[4:]
        page.rules.append((min(a[0], b[0]), min(a[1], b[1]), max(a[0], b[0]), max(a[1], b[1])))

    for value, _ in tokens(content):
        if not isinstance(value, Word):
            args.append(value)
            continue
        n = [a for a in args if isinstance(a, float)]
        if value == "q":
            saved.append(place)
        elif value == "Q" and saved:
            place = saved.pop()
        elif value == "cm" and len(n) >= 6:
            place = _times(tuple(n[-6:]), place)
        elif value == "BT":
            line = text = whole
        elif value == "Tf" and args:
            font, size = fonts.get(next((a for a in args if isinstance(a, Name)), ""), font), n[-1] if n else size
        elif value == "TL" and n:
            leading = n[-1]
        elif value in ("Td", "TD") and len(n) >= 2:
            leading = -n[-1] if value == "TD" else leading
            line = text = _times((1, 0, 0, 1, n[-2], n[-1]), line)
        elif value == "Tm" and len(n) >= 6:
            line = text = tuple(n[-6:])
        elif value in ("T*", "'", '"'):
            line = text = _times((1, 0, 0, 1, 0, -leading), line)
            if value != "T*" and args:
                show(args[-1])
        elif value == "Tj" and args:
            show(args[-1])
        elif value == "TJ" and args and isinstance(args[-1], list):
            joined = b"".join(a if isinstance(a, bytes) else (b" " if isinstance(a, float) and a < -180 and not font.wide else b"") for a in args[-1])
            show(joined)
        elif value == "m" and len(n) >= 2:
            point = (n[-2], n[-1])
        elif value == "l" and len(n) >= 2:
            rule(*point, n[-2], n[-1])
            point = (n[-2], n[-1])
        elif value == "re" and len(n) >= 4:
            x, y, w, h = n[-4:]
            if abs(w) < 3 or abs(h) < 3:
                rule(x, y, x + w, y + h)
            else:
                for edge in ((x, y, x + w, y), (x, y + h, x + w, y + h), (x, y, x, y + h), (x + w, y, x + w, y + h)):
                    rule(*edge)
        args = []
    return page


def _joined(runs: list[tuple[float, float, float, str]]) -> list[str]:
    """Runs as lines from top to bottom: those at about one height in the order of their places."""
    lines: list[list[tuple[float, float, float, str]]] = []
    for run in sorted(runs, key=lambda r: (-r[1], r[0])):
        if lines and abs(lines[-1][0][1] - run[1]) <= 0.4 * max(run[2], 1.0):
            lines[-1].append(run)
        else:
            lines.append([run])
    return [" ".join(" ".join(r[3] for r in sorted(line, key=lambda r: r[0])).split()) for line in lines]


def _marks(values: list[float]) -> list[float]:
    """Distinct positions; those within two points are one."""
    out: list[float] = []
    for v in sorted(values):
        if not out or v - out[-1] > 2:
            out.append(v)
    return out


def _grids(rules: list[tuple[float, float, float, float]]) -> list[list[tuple[float, float, float, float]]]:
    """Rules that touch one another, as tables."""
    left, out = sorted(rules, key=lambda r: -r[3]), []
    while left:
        grid, grown = [left.pop(0)], True
        while grown:
            touching = [r for r in left if any(r[0] <= g[2] + 2 and g[0] <= r[2] + 2 and r[1] <= g[3] + 2 and g[1] <= r[3] + 2 for g in grid)]
            grown = bool(touching)
            grid += touching
            left = [r for r in left if r not in touching]
        out.append(grid)
    return out


def events(page: Page) -> list[tuple[str, str, list[str] | None]]:
    """(tipo, texto, celulas) from top to bottom: ``linha`` for a line of text, ``tabela`` for a row between rules."""
    found: list[tuple[float, str, str, list[str] | None]] = []
    inside: set[int] = set()
    for grid in _grids(page.rules):
        xs = _marks([x for r in grid if r[2] - r[0] <= 3 for x in (r[0],)])
        ys = _marks([y for r in grid if r[3] - r[1] <= 3 for y in (r[1],)])
        if len(xs) < 2 or len(ys) < 2:
            continue
        for low, high in zip(ys, ys[1:]):
            cells: list[list] = [[] for _ in xs[1:]]
            for i, run in enumerate(page.runs):
                if low <= run[1] + 0.3 * run[2] <= high and xs[0] - 1 <= run[0] <= xs[-1] and i not in inside:
                    inside.add(i)
                    cells[max(0, min(len(xs) - 2, sum(x <= run[0] + 1 for x in xs) - 1))].append(run)
            if any(cells):
                said = [" ".join(_joined(c)) for c in cells]
                found.append((high, "tabela", " ".join(x for x in said if x), said))
    rest = [r for i, r in enumerate(page.runs) if i not in inside]
    heights = sorted({r[1] for r in rest}, reverse=True)
    lines = _joined(rest)
    # Each line of the rest stands at the height of its first run.
    tops: list[float] = []
    for h in heights:
        size = max(r[2] for r in rest if r[1] == h)
        if not tops or tops[-1] - h > 0.4 * max(size, 1.0):
            tops.append(h)
    found += [(top, "linha", line, None) for top, line in zip(tops, lines) if line]
    return [(kind, text, cells) for _, kind, text, cells in sorted(found, key=lambda x: -x[0])]


def read(content: bytes, most_pages: int | None = None) -> Iterator[tuple[int, int, str, str, list[str] | None]]:
    """(pagina, ordem, tipo, texto, celulas) of a document's first ``most_pages`` pages, or of all."""
    document = Document(content)
    for number, page in enumerate(document.pages()[:most_pages], 1):
        contents = page.get("Contents")
        parts = contents if isinstance(contents, list) else document.get(contents) if isinstance(document.get(contents), list) else [contents]
        drawn = interpret(b"\n".join(document.stream(p) for p in parts), document.fonts(page))
        for order, (kind, text, cells) in enumerate(events(drawn), 1):
            yield number, order, kind, text, cells


def read_pdfs(spark: SparkSession, path: str, most_pages: int | None = None) -> DataFrame:
    """Lines and ruled rows of every PDF that matches ``path``, in reading order: ficheiro, pagina, ordem, tipo, texto,
    celulas. ``most_pages`` reads the first pages only (a cheap look at what a document is). Unreadable files are left
    out; a page without text gives no row."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                try:
                    found = [(name, *r) for r in read(bytes(content), most_pages)]
                except (ValueError, zlib.error, RecursionError, IndexError, KeyError, TypeError):
                    continue
                yield pd.DataFrame(found, columns=["ficheiro", "pagina", "ordem", "tipo", "texto", "celulas"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, SCHEMA)


def first_pages(spark: SparkSession, path: str, pages: int = 3) -> DataFrame:
    """ficheiro and the text of its first pages, line by line: enough to tell which document it is."""
    lines = read_pdfs(spark, path, pages)
    listed = F.array_sort(F.collect_list(F.struct("pagina", "ordem", "texto")))
    return lines.groupBy("ficheiro").agg(F.array_join(F.transform(listed, lambda x: x["texto"]), "\n").alias("texto"))
