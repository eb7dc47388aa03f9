import random
import zipfile
from io import BytesIO

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.schema import SECTION
from millrace.sources import blocks, formats, office, structured, web


def sources(spark, *raw):
    return spark.createDataFrame([(f"s{i}", r) for i, r in enumerate(raw)], "source_id string, raw string")


def rows(df, *names):
    return [tuple(r) for r in df.orderBy("source_id", "block_id").select(*names).collect()]


GUIDE = """# Chapter 1
intro text

## 1.1 Overview
| a | b |
|---|---|
| 1 | 2 |

```python
print("x")
```
### Deep
words
# Chapter 2
end"""


def test_markdown(spark):
    got = rows(blocks.markdown_blocks(sources(spark, GUIDE)), "type", "content", "heading_path", "level")
    assert [g[0] for g in got] == ["heading", "paragraph", "heading", "table", "code_block", "heading", "paragraph", "heading", "paragraph"]
    assert got[4][1:3] == ('print("x")', ["Chapter 1", "1.1 Overview"])
    assert got[6][2] == ["Chapter 1", "1.1 Overview", "Deep"] and got[8][2] == ["Chapter 2"]


def test_markdown_equals_a_line_by_line_reading(spark):
    r = random.Random(3)
    lines = ["# A", "## B", "### C", "#### D", "text one", "", "", "| x |", "```", "~~~ sql", "  ", "more  ", "#no heading"]
    raw = ["\n".join(r.choice(lines) for _ in range(r.randint(0, 25))) for _ in range(80)]

    def brute(text):
        out, stack, buf, code = [], [], [], None

        def flush():
            import re

            joined = "\n".join(x.rstrip() for x in re.sub(r"\n{3,}", "\n\n", "\n".join(buf)).split("\n")).strip()
            buf.clear()
            out.extend(("paragraph", p.strip(), [t for _, t in stack]) for p in re.split(r"\n\s*\n", joined) if p.strip())

        for line in text.split("\n"):
            fence = line.lstrip().startswith(("```", "~~~"))
            if fence and code is None:
                flush()
                code = []
            elif fence:
                if code:
                    out.append(("code_block", "\n".join(code), [t for _, t in stack]))
                code = None
            elif code is not None:
                code.append(line)
            elif line.startswith("#") and line.lstrip("#")[:1] == " ":
                flush()
                level = len(line) - len(line.lstrip("#"))
                while stack and stack[-1][0] >= level:
                    stack.pop()
                out.append(("heading", line.lstrip("#").strip(), [t for _, t in stack]))
                stack.append((level, line.lstrip("#").strip()))
            else:
                buf.append(line)
        if code:
            out.append(("code_block", "\n".join(code), [t for _, t in stack]))
        flush()
        merged = []
        for kind, content, path in out:
            if kind == "paragraph" and content.startswith("|"):
                if merged and merged[-1][0] == "run":
                    merged[-1][1].append(content)
                else:
                    merged.append(("run", [content], path))
            else:
                merged.append((kind, content, path))
        return [("table", "\n".join(c), p) if k == "run" else (k, c, p) for k, c, p in merged]

    got = {}
    for s, *rest in rows(blocks.markdown_blocks(sources(spark, *raw)), "source_id", "type", "content", "heading_path"):
        got.setdefault(s, []).append(tuple(rest))
    assert got == {f"s{i}": brute(t) for i, t in enumerate(raw) if brute(t)}


def test_plain_and_code(spark):
    assert rows(blocks.plain_blocks(sources(spark, "one\n\n\n\ntwo  \r\nmore\n \nＡＢ", "", None)), "content") == [("one",), ("two\nmore",), ("AB",)]
    code = sources(spark, "x = 1\n").withColumns({"filename": F.lit("a.py"), "format_type": F.lit("py")})
    assert rows(blocks.code_blocks(code), "type", "content", "level") == [("heading", "a.py", 1), ("code_block", "x = 1", None)]


def test_empty_inputs_have_the_schema(spark):
    none = sources(spark, "x").where("false")
    for df in (blocks.plain_blocks(none), blocks.markdown_blocks(none), blocks.web_blocks(none), structured.delimited_blocks(none)):
        assert df.count() == 0 and [f.name for f in df.schema] == [f.name for f in SECTION]


PAGE = '<html><head><title> The\n Title </title><style>p{}</style><script>var x="</p>";</script></head><body><nav>Menu</nav><header>Top</header><p>One &amp; two<br>three</p><div>&lt;b&gt;</div><!-- gone --><footer>Foot</footer></body></html>'


def test_web(spark):
    p = spark.createDataFrame([("a", PAGE), ("b", "<h1>H <i>x</i></h1>")], "source_id string, html string")
    got = {r.source_id: r for r in web.extract_pages(p).collect()}
    assert got["a"].title == "The Title" and got["b"].title == "H x"
    assert "Menu" not in got["a"].raw and "Foot" not in got["a"].raw and "var x" not in got["a"].raw
    assert "One & two\nthree" in got["a"].raw and "<b>" in got["a"].raw
    s = sources(spark, "# T\ntext\n\n| a |\n|---|\n| 1 |\n\n| lone |")
    assert rows(blocks.web_blocks(s), "type", "heading_path") == [("heading", []), ("paragraph", ["T"]), ("table", ["T"]), ("paragraph", ["T"])]


def test_delimited(spark):
    s = sources(spark, 'name,role\nAnn,"a|b"\n,\nBob\n')
    assert rows(structured.delimited_blocks(s), "content") == [("| name | role |\n|---|---|\n| Ann | a\\|b |\n| Bob |  |",)]
    wide = ",".join(f"c{i}" for i in range(19)) + ",\n" + ",".join(str(i) if i % 2 == 0 else "" for i in range(20)) + "\n"
    got = rows(structured.delimited_blocks(sources(spark, wide)), "type", "content")
    assert got[0] == ("heading", "Wide table (transposed)")
    assert got[1][1].split("\n")[:2] == ["**Record 1**", "- c0: 0"]


def test_json_and_yaml(spark):
    s = sources(spark, '{"db": {"host": "localhost", "port": 5}, "tags": ["a", "b"], "n": null, "e": [], "d": {}}', "{broken")
    got, warned = structured.json_blocks(s)
    assert rows(got, "content")[0][0].split("\n") == ["db.host: localhost", "db.port: 5", "tags[0]: a", "tags[1]: b", "n: None", "e: []"]
    assert rows(got, "content")[1] == ("{broken",) and warned.count() == 1
    lines, bad = structured.json_line_blocks(sources(spark, '{"a": 1}\nnope\n\n{"a": {}}'))
    assert rows(lines, "content") == [("record[0].a: 1",), ("(empty)",)] and "Line 2" in bad.first().warning
    got, _ = structured.yaml_blocks(sources(spark, "a: [1, {b: true}]", "just text", "a: : :"))
    assert [r[0] for r in rows(got, "content")] == ["a[0]: 1\na[1].b: True", "just text", "a: : :"]


def test_encodings(spark):
    data = [("é ü", "utf-8"), ("中文文本", "gb18030"), ("naïve\r\nx", "latin-1")]
    df = spark.createDataFrame([(i, bytearray(t.encode(e))) for i, (t, e) in enumerate(data)], "i int, content binary")
    got = [r[0] for r in df.orderBy("i").select(structured.decode(F.col("content"))).collect()]
    assert got[0] == "é ü" and got[1] == "中文文本"
    assert structured_lenient(spark) == "a�"


def structured_lenient(spark):
    df = spark.createDataFrame([(bytearray(b"a\xff"),)], "content binary")
    return df.select(structured.decode(F.col("content"), lenient=True)).first()[0]


def test_router_and_ids(spark):
    assert len(formats.supported_extensions()) == 57
    files = spark.createDataFrame([("a/guide.md",), ("archive.xyz",)], "source string")
    got = formats.identify(files)
    assert {r.source: r.family for r in got.collect()} == {"a/guide.md": "markdown", "archive.xyz": None}
    assert "Supported: bash" in formats.unsupported(got).first().error
    assert formats.missing(spark, ["a/guide.md", "gone.md"], files).first().source == "gone.md"
    import hashlib

    assert got.where("source = 'a/guide.md'").first().source_id == "guide_" + hashlib.sha1(b"a/guide.md").hexdigest()[:8]


def zipped(**parts):
    out = BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name.replace("__", "/"), text)
    return out.getvalue()


CORE = '<c:coreProperties xmlns:c="http://schemas.openxmlformats.org/package/2006/metadata/core-properties" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:t="http://purl.org/dc/terms/"><dc:creator>Ann</dc:creator><dc:subject/><t:created>2024-01-02T03:04:05Z</t:created><t:modified>some day</t:modified></c:coreProperties>'


def word(body, **more):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    styles = "".join(f'<w:style w:styleId="{i}"><w:name w:val="{n}"/></w:style>' for i, n in (("H1", "heading 1"), ("H2", "heading 2"), ("H3", "heading 3"), ("LB", "List Bullet")))
    return zipped(**{"word__document.xml": f"<w:document {w}><w:body>{body}</w:body></w:document>", "word__styles.xml": f"<w:styles {w}>{styles}</w:styles>", **more})


def par(text, style=""):
    return f"<w:p>{f'<w:pPr><w:pStyle w:val={chr(34)}{style}{chr(34)}/></w:pPr>' if style else ''}<w:r><w:t>{text}</w:t></w:r></w:p>"


def files(spark, *data):
    return spark.createDataFrame([(f"f{i}", f"f{i}", bytearray(d)) for i, d in enumerate(data)], "source_id string, filename string, content binary")


def test_word(spark):
    cell = lambda t: f"<w:tc>{par(t)}</w:tc>"
    table = f"<w:tbl><w:tr>{cell('k')}{cell('v')}</w:tr><w:tr>{cell('a|b')}{cell('2')}</w:tr></w:tbl>"
    e = office.read_elements(files(spark, word(par("One", "H1") + par("Two", "H2") + par("item", "LB") + par("Three", "H3") + table + par("Again", "H2")), b"PK\x03\x04broken"), "word")
    got = rows(office.office_blocks(e), "type", "level", "content", "heading_path")
    assert [g[1] for g in got if g[0] == "heading"] == [1, 2, 3, 2]
    assert got[2] == ("list_item", None, "item", ["One", "Two"])
    assert got[4][2] == "| k | v |\n|---|---|\n| a\\|b | 2 |" and got[4][3] == ["One", "Two", "Three"]
    assert "as a Word document" in office.office_failures(e).first().error


def test_properties(spark):
    body = par("One", "H1") + par("text") + "<w:tbl><w:tr/></w:tbl>"
    e = office.read_elements(files(spark, word(body, docProps__core_xml=""), word(body, **{"docProps__core.xml": CORE}), word(body, **{"docProps__core.xml": "<broken"}), b"PK"), "word")
    got = {r.source_id: r.properties for r in office.office_properties(e).collect()}
    assert set(got) == {"f0", "f1", "f2"} and got["f0"] == got["f2"]
    p = got["f1"]
    assert (p.author, p.subject, p.created, p.modified, p.paragraph_count, p.table_count) == ("Ann", None, "2024-01-02T03:04:05+00:00", "some day", 2, 1)
    assert (got["f0"].author, got["f0"].created, got["f0"].paragraph_count, got["f0"].sheets) == (None, None, 2, None)
    assert office.office_blocks(e).where("type = 'properties'").count() == 0


def test_sheets(spark):
    s, r = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    book = f'<workbook {s} {r}><sheets><sheet name="Main" r:id="r1"/><sheet name="Empty" r:id="r2"/></sheets></workbook>'
    rel = '<Relationships><Relationship Id="r1" Target="worksheets/a.xml" Type="x/worksheet"/><Relationship Id="r2" Target="worksheets/b.xml" Type="x/worksheet"/></Relationships>'
    cells = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1"><v>2.5</v></c></row><row r="3"><c r="A3" t="s"><v>1</v></c><c r="B3" t="b"><v>1</v></c></row><row r="4"><c r="A4"><f>SUM(B1)</f></c></row>'
    out = BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", book)
        z.writestr("xl/_rels/workbook.xml.rels", rel)
        z.writestr("xl/sharedStrings.xml", f"<sst {s}><si><t>top</t></si><si><t>merged</t></si></sst>")
        z.writestr("xl/worksheets/a.xml", f'<worksheet {s}><sheetData>{cells}</sheetData><mergeCells><mergeCell ref="A3:A5"/></mergeCells></worksheet>')
        z.writestr("xl/worksheets/b.xml", f"<worksheet {s}><sheetData/></worksheet>")
    data = out.getvalue()
    e = office.read_elements(files(spark, data), "sheet")
    got = rows(office.office_blocks(e), "type", "content", "heading_path", "metadata")
    assert [g[1] for g in got if g[0] == "heading"] == ["Sheet: Main", "Sheet: Empty"]
    assert got[1][1].split("\n")[2:] == ["| merged | True |", "| merged |  |", "| merged |  |"] and got[1][3]["merged_ranges_expanded"] == "1"
    assert office.office_warnings(e).first().warning == "Sheet 'Empty' is empty"
    said = office.office_properties(e).first().properties
    assert (said.sheet_count, said.sheets) == (2, ["Main", "Empty"])
    f = office.office_blocks(office.read_elements(files(spark, data), "sheet", formulas=True))
    assert f.where("type = 'table'").count() == 1
    cut = office.office_blocks(office.read_elements(files(spark, data), "sheet", max_rows=2)).where("type = 'table'").first()
    assert cut.metadata["truncated"] == "True"


def test_slides(spark):
    p, a, r = ('xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main"', 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"', 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"')

    def shape(text, x, y, ph=""):
        mark = f'<p:nvSpPr><p:nvPr><p:ph type="{ph}"/></p:nvPr></p:nvSpPr>' if ph else "<p:nvSpPr><p:nvPr/></p:nvSpPr>"
        return f'<p:sp>{mark}<p:spPr><a:xfrm><a:off x="{x}" y="{y}"/></a:xfrm></p:spPr><p:txBody><a:p><a:r><a:t>{text}</a:t></a:r></a:p></p:txBody></p:sp>'

    out = BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("ppt/presentation.xml", f'<p:presentation {p} {r}><p:sldIdLst><p:sldId r:id="r1"/></p:sldIdLst></p:presentation>')
        z.writestr("ppt/_rels/presentation.xml.rels", '<Relationships><Relationship Id="r1" Target="slides/s1.xml" Type="x/slide"/></Relationships>')
        z.writestr("ppt/slides/s1.xml", f"<p:sld {p} {a}><p:cSld><p:spTree>{shape('right', 900, 50001)}{shape('left', 10, 50100)}{shape('The title', 0, 0, 'title')}</p:spTree></p:cSld></p:sld>")
        z.writestr("ppt/slides/_rels/s1.xml.rels", '<Relationships><Relationship Id="n" Target="../notesSlides/n1.xml" Type="x/notesSlide"/></Relationships>')
        z.writestr("ppt/notesSlides/n1.xml", f"<p:notes {p} {a}><p:cSld><p:spTree>{shape('spoken', 0, 0, 'body')}</p:spTree></p:cSld></p:notes>")
    got = rows(office.office_blocks(office.read_elements(files(spark, out.getvalue()), "slides")), "type", "content", "heading_path", "metadata")
    assert [g[1] for g in got] == ["The title", "left", "right", "spoken"]
    assert got[3][3] == {"source": "speaker_notes"} and got[1][2] == ["The title"]


@pytest.mark.parametrize("text,want", [("a\r\nb", "a\nb"), ("  x  ", "x"), ("a\n\n\n\nb", "a\n\nb"), ("ﬁ  y", "fi  y"), ("t \t\nu", "t\nu")])
def test_normalize(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(tx.normalize_text(F.col("t"))).first()[0] == want


def test_odd_files_never_fail_a_task(spark):
    deep, wide = "[" * 20_000 + "]" * 20_000, "a,b\n" + "x" * 140_000 + ",y"
    rows = [("deep", deep), ("date", "a: 2021-99-99"), ("flow", "[" * 3000 + "]" * 3000), ("key", "? [1, 2]\n: 3")]
    src = spark.createDataFrame(rows, "source_id string, raw string")
    for read in (structured.json_blocks, structured.yaml_blocks):
        blocks, warnings = read(src)
        assert {r.source_id for r in blocks.collect()} == {"deep", "date", "flow", "key"} and warnings.count() >= 2
    _, warnings = structured.json_line_blocks(src.where("source_id = 'deep'"))
    assert warnings.count() == 1
    table = structured.delimited_blocks(spark.createDataFrame([("w", wide)], "source_id string, raw string")).first()
    assert "x" * 140_000 in table.content


def test_long_runs_of_white_space_take_no_time(spark):
    import time

    from millrace.functions import text

    row = spark.createDataFrame([("a" + " " * 20_000 + "b \t\n\u3000c\u2009",)], "t string")
    began = time.time()
    got = row.select(text.normalize_text(F.col("t")).alias("n"), text.strip(F.col("t")).alias("s"), text.rstrip(F.lit(" \x1fx\x85 ")).alias("r"), text.lstrip(F.lit("\xa0\ufeffy ")).alias("l")).first()
    assert got.n == "a" + " " * 20_000 + "b\n c" and got.s.endswith("c") and got.r == " \x1fx" and got.l == "\ufeffy "
    assert time.time() - began < 20
