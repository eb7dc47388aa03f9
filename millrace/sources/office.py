"""Word, Excel and PowerPoint files, read from their zipped XML with the standard library.

The reader functions yield raw elements in document order; numbering, breadcrumbs and table rendering
are DataFrame operations shared with the other formats. A broken file gives a failure row.
"""

import json
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime
from io import BytesIO
from typing import Any
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import normalize_text
from millrace.schema import as_sections
from millrace.sources.blocks import with_breadcrumb
from millrace.sources.structured import markdown_grid

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
DC, TERMS = "{http://purl.org/dc/elements/1.1/}", "{http://purl.org/dc/terms/}"
CORE = {"author": DC + "creator", "created": TERMS + "created", "modified": TERMS + "modified", "subject": DC + "subject"}
#: Fixed value: rows of a sheet that are read.
SHEET_ROWS = 5000

#: Names of what office_properties() gives.
PROPERTIES = ("author", "created", "modified", "subject", "paragraph_count", "table_count", "sheet_count", "sheets", "slide_count")

ELEMENT = "source_id string, pos int, type string, level int, text string, rows array<array<string>>, sheet string, slide int, meta map<string,string>, error string"
_ARROW = pa.schema(
    [("source_id", pa.string()), ("pos", pa.int32()), ("type", pa.string()), ("level", pa.int32()), ("text", pa.string()), ("rows", pa.list_(pa.list_(pa.string()))), ("sheet", pa.string()), ("slide", pa.int32()), ("meta", pa.map_(pa.string(), pa.string())), ("error", pa.string())]
)


def _relations(z: zipfile.ZipFile, part: str) -> dict[str, tuple[str, str]]:
    folder, name = posixpath.split(part)
    path = f"{folder}/_rels/{name}.rels"
    if path not in z.namelist():
        return {}
    out = {}
    for r in ET.fromstring(z.read(path)):
        target = r.get("Target", "")
        out[r.get("Id", "")] = (target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target)), r.get("Type", "").rsplit("/", 1)[-1])
    return out


def _word_text(p: ET.Element) -> str:
    parts = {W + "t": lambda e: e.text or "", W + "tab": lambda e: "\t", W + "br": lambda e: "\n", W + "cr": lambda e: "\n"}
    return "".join(parts[e.tag](e) for e in p.iter() if e.tag in parts)


def _core(z: zipfile.ZipFile) -> dict[str, str]:
    """Author, subject and times of a package; times as ISO 8601 if they can be read, else as they stand."""
    try:
        root = ET.fromstring(z.read("docProps/core.xml"))
    except (KeyError, ET.ParseError):
        return {}
    held = {name: e.text for name, tag in CORE.items() if (e := root.find(tag)) is not None and e.text}
    for name in ("created", "modified"):
        try:
            held[name] = datetime.fromisoformat(held[name].strip()).isoformat()
        except (KeyError, ValueError):
            pass
    return held


def read_word(data: bytes) -> Iterator[dict[str, Any]]:
    """Paragraphs by style (headings, list items) and tables, in body order; then the file's properties."""
    with zipfile.ZipFile(BytesIO(data)) as z:
        styles = {}
        if "word/styles.xml" in z.namelist():
            for s in ET.fromstring(z.read("word/styles.xml")).iter(W + "style"):
                name = s.find(W + "name")
                styles[s.get(W + "styleId")] = (name.get(W + "val") if name is not None else s.get(W + "styleId")) or ""
        body = ET.fromstring(z.read("word/document.xml")).find(W + "body")
        for child in body if body is not None else ():
            if child.tag == W + "p":
                ref = child.find(f"{W}pPr/{W}pStyle")
                style = styles.get(ref.get(W + "val"), ref.get(W + "val") or "").lower() if ref is not None else ""
                text = _word_text(child)
                if style.startswith("heading"):
                    number = re.search(r"\d+", style)
                    if text.strip():
                        yield {"type": "heading", "level": max(1, min(int(number[0]) if number else 1, 6)), "text": text.strip()}
                else:
                    yield {"type": "list_item" if style.startswith("list") else "paragraph", "text": text}
            elif child.tag == W + "tbl":
                rows = [["\n".join(map(_word_text, c.iter(W + "p"))).replace("\n", " ").strip() for c in r.findall(W + "tc")] for r in child.findall(W + "tr")]
                yield {"type": "table", "rows": rows, "meta": {"rows": str(len(rows)), "columns": str(max(map(len, rows), default=0))}}
        count = {n: str(len(body.findall(W + tag)) if body is not None else 0) for n, tag in (("paragraph_count", "p"), ("table_count", "tbl"))}
        yield {"type": "properties", "meta": {**_core(z), **count}}


def _cell(ref: str) -> tuple[int, int]:
    letters, digits = re.fullmatch(r"\$?([A-Z]+)\$?(\d+)", ref).groups()
    col = 0
    for c in letters:
        col = col * 26 + ord(c) - 64
    return int(digits), col


def _number(text: str) -> str:
    try:
        x = float(text)
    except ValueError:
        return text
    return text if re.fullmatch(r"-?\d+", text) else str(int(x)) if x.is_integer() and "e" not in text.lower() and "." not in text else str(x)


def read_sheets(data: bytes, max_rows: int = SHEET_ROWS, formulas: bool = False) -> Iterator[dict[str, Any]]:
    """Per sheet a heading and a table with merged ranges filled in; rows without any value are left out."""
    with zipfile.ZipFile(BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(S + "t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall(S + "si")]
        rel = _relations(z, "xl/workbook.xml")
        sheets = list(ET.fromstring(z.read("xl/workbook.xml")).iter(S + "sheet"))
        names = [sheet.get("name") or "" for sheet in sheets]
        yield {"type": "properties", "meta": {"sheet_count": str(len(names)), "sheets": json.dumps(names)}}
        for sheet, name in zip(sheets, names):
            yield {"type": "heading", "level": 1, "text": f"Sheet: {name}", "sheet": name}
            root = ET.fromstring(z.read(rel[sheet.get(R + "id")][0]))
            grid: dict[tuple[int, int], str] = {}
            deep = 0
            for r, row in enumerate(root.iter(S + "row"), 1):
                r = int(row.get("r") or r)
                deep = max(deep, r)
                if r > max_rows:
                    continue
                for c, cell in enumerate(row.findall(S + "c"), 1):
                    at = _cell(cell.get("r")) if cell.get("r") else (r, c)
                    v, f, kind = cell.find(S + "v"), cell.find(S + "f"), cell.get("t")
                    if kind == "inlineStr":
                        grid[at] = "".join(t.text or "" for t in cell.iter(S + "t"))
                    elif v is not None and v.text is not None:
                        grid[at] = shared[int(v.text)] if kind == "s" else ("True" if v.text == "1" else "False") if kind == "b" else v.text if kind in ("str", "e") else _number(v.text)
                    elif formulas and f is not None and f.text:
                        grid[at] = "=" + f.text
            height, width = max((k[0] for k in grid), default=0), max((k[1] for k in grid), default=0)
            merged = [m.get("ref", "") for m in root.iter(S + "mergeCell")]
            for ref in merged:
                (r0, c0), (r1, c1) = (_cell(x) for x in (ref.split(":") * 2)[:2])
                height, width = max(height, min(r1, max_rows)), max(width, c1)
                if (r0, c0) in grid:
                    grid.update({(r, c): grid[r0, c0] for r in range(r0, min(r1, max_rows) + 1) for c in range(c0, c1 + 1)})
            rows = [[grid.get((r, c), "") for c in range(1, width + 1)] for r in range(1, height + 1)]
            rows = [r for r in rows if any(x.strip() for x in r)]
            if not rows:
                yield {"type": "warning", "text": f"Sheet '{name}' is empty"}
                continue
            yield {"type": "table", "rows": rows, "sheet": name, "meta": {"rows": str(len(rows) - 1), "columns": str(width), "merged_ranges_expanded": str(len(merged)), "truncated": str(deep > max_rows)}}
            if deep > max_rows:
                yield {"type": "warning", "text": f"Sheet '{name}' exceeded {max_rows} rows and was truncated"}


def _slide_text(body: ET.Element | None) -> str:
    if body is None:
        return ""
    lines = ["".join(t.text or "" if t.tag == A + "t" else "\v" for t in p.iter() if t.tag in (A + "t", A + "br")) for p in body.findall(A + "p")]
    return "\n".join(x for x in lines if x.strip()).strip()


def read_slides(data: bytes) -> Iterator[dict[str, Any]]:
    """Per slide a heading, its shapes from top to bottom and left to right, and the speaker notes."""
    with zipfile.ZipFile(BytesIO(data)) as z:
        rel = _relations(z, "ppt/presentation.xml")
        slides = [rel[s.get(R + "id")][0] for s in ET.fromstring(z.read("ppt/presentation.xml")).iter(P + "sldId")]
        yield {"type": "properties", "meta": {"slide_count": str(len(slides))}}
        for n, part in enumerate(slides, 1):
            root = ET.fromstring(z.read(part))
            tree = root.find(f"{P}cSld/{P}spTree")
            shapes = []
            title, title_shape = "", None
            for shape in tree if tree is not None else ():
                if shape.tag not in (P + "sp", P + "graphicFrame"):
                    continue
                mark = shape.find(f"{P}nvSpPr/{P}nvPr/{P}ph")
                if title_shape is None and mark is not None and mark.get("type") in ("title", "ctrTitle"):
                    title_shape, title = shape, _slide_text(shape.find(P + "txBody"))
                off = next((o for o in shape.iter(A + "off")), None)
                top, left = (int(off.get("y", 0)), int(off.get("x", 0))) if off is not None else (0, 0)
                shapes.append((round(top, -4), left, shape))
            yield {"type": "heading", "level": 1, "text": title or f"Slide {n}", "slide": n}
            for _, _, shape in sorted(shapes, key=lambda s: s[:2]):
                table = next((t for t in shape.iter(A + "tbl")), None)
                if table is not None:
                    rows = [["\n".join("".join(t.text or "" for t in p.iter(A + "t")) for p in c.iter(A + "p")) for c in r.findall(A + "tc")] for r in table.findall(A + "tr")]
                    yield {"type": "table", "rows": rows, "slide": n, "meta": {"rows": str(len(rows))}}
                elif not (title and shape is title_shape) and (text := _slide_text(shape.find(P + "txBody"))):
                    yield {"type": "paragraph", "text": text, "slide": n}
            for target, kind in _relations(z, part).values():
                if kind == "notesSlide":
                    for shape in ET.fromstring(z.read(target)).iter(P + "sp"):
                        mark = shape.find(f"{P}nvSpPr/{P}nvPr/{P}ph")
                        if mark is not None and mark.get("type") == "body" and (text := _slide_text(shape.find(P + "txBody"))):
                            yield {"type": "paragraph", "text": text, "slide": n, "meta": {"source": "speaker_notes"}}


READERS: dict[str, Callable[..., Iterator[dict[str, Any]]]] = {"word": read_word, "sheet": read_sheets, "slides": read_slides}
NAMES = {"word": "a Word document", "sheet": "an Excel workbook", "slides": "a PowerPoint file"}


def read_elements(files: DataFrame, family: str, **options: Any) -> DataFrame:
    """files (source_id, filename, content) -> raw elements; a file that can't be read gives one row with an error."""
    reader, what = READERS[family], NAMES[family]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    found = [{**e, "source_id": row["source_id"], "pos": i} for i, e in enumerate(reader(row["content"], **options))]
                except Exception as e:  # whatever a damaged file raises becomes data
                    found = [{"source_id": row["source_id"], "pos": 0, "type": "error", "error": f"Could not open {row['filename']} as {what}: {type(e).__name__}: {e}"}]
                full = [{n: list(e["meta"].items()) if n == "meta" and e.get("meta") else e.get(n) for n in _ARROW.names} for e in found]
                if full:
                    yield pa.RecordBatch.from_pylist(full, schema=_ARROW)

    return files.select("source_id", "filename", "content").mapInArrow(run, ELEMENT)


def office_blocks(elements: DataFrame, unicode: bool = True) -> DataFrame:
    """Sections of raw elements: headings above each block, tables as Markdown."""
    rows = elements.where(~F.col("type").isin("error", "warning", "properties"))
    grid = F.when(F.size("rows") > 0, markdown_grid(F.col("rows"), one_line=True)).otherwise(F.lit(""))
    rows = rows.withColumn("content", F.when(F.col("type") == "table", grid).otherwise(normalize_text(F.col("text"), unicode)))
    rows = rows.where((F.col("type") == "table") | (F.col("content") != ""))
    rows = with_breadcrumb(rows, "pos").withColumn("location", F.struct(F.lit(None).cast("int").alias("page"), "sheet", "slide")).withColumn("metadata", F.col("meta"))
    return as_sections(rows.withColumn("block_id", F.row_number().over(Window.partitionBy("source_id").orderBy("pos")) - 1))


def office_failures(elements: DataFrame) -> DataFrame:
    return elements.where("type = 'error'").select(F.col("source_id").alias("source"), "error", F.lit("parse_error").alias("kind"))


def office_warnings(elements: DataFrame) -> DataFrame:
    return elements.where("type = 'warning'").select("source_id", F.col("text").alias("warning"))


def office_properties(elements: DataFrame) -> DataFrame:
    """source_id, properties: what the files say about themselves."""
    kinds = {"sheets": lambda x: F.from_json(x, "array<string>")} | {n: lambda x: x.try_cast("int") for n in ("paragraph_count", "table_count", "sheet_count", "slide_count")}
    fields = [kinds.get(n, lambda x: x)(F.try_element_at("meta", F.lit(n))).alias(n) for n in PROPERTIES]
    return elements.where("type = 'properties'").select("source_id", F.struct(*fields).alias("properties")).groupBy("source_id").agg(F.first("properties").alias("properties"))
