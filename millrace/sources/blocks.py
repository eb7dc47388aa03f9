"""Texts to typed blocks: plain text, Markdown, extracted web text and program code.

Every function takes a table of sources (source_id, raw) and returns sections. Lines become rows and
the parser's state becomes window functions over a source's lines, so one shuffle by source_id serves
a whole parse. A null text has no blocks. Repeated source ids are one source: give each text its own.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import WS, lstrip, normalize_text, paragraphs, strip
from millrace.schema import as_sections

FENCE = rf"\A{WS}*(```+|~~~+){WS}*([^\t-\r\x1c-\x20\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]*)"
HEADING = rf"(?s)\A(#{{1,6}}){WS}+(.*)\z"


def _numbered(df: DataFrame, *order: str) -> DataFrame:
    return df.withColumn("block_id", F.row_number().over(Window.partitionBy("source_id").orderBy(*order)) - 1)


def with_breadcrumb(rows: DataFrame, *order: str) -> DataFrame:
    """rows (source_id, level, content, ...) with heading_path: titles of the headings above, outermost first.

    Of each level the last heading before the row counts, if no heading of a lower level follows it
    and it is lower than the row's own level (7 for anything but a heading).
    """
    numbered = rows.withColumn("_n", F.row_number().over(Window.partitionBy("source_id").orderBy(*order)))
    before = Window.partitionBy("source_id").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    for k in range(1, 7):
        numbered = numbered.withColumn(f"_h{k}", F.last(F.when(F.col("level") == k, F.struct(F.col("_n").alias("n"), F.col("content").alias("t"))), ignorenulls=True).over(before))
    own, path = F.coalesce(F.col("level"), F.lit(7)), []
    for k in range(1, 7):
        ok = F.col(f"_h{k}").isNotNull() & (own > k)
        for j in range(1, k):
            ok = ok & (F.col(f"_h{j}").isNull() | (F.col(f"_h{j}.n") < F.col(f"_h{k}.n")))
        path.append(F.when(ok, F.col(f"_h{k}.t")))
    return numbered.withColumn("heading_path", F.array_compact(F.array(*path))).drop("_n", *(f"_h{k}" for k in range(1, 7)))


def plain_blocks(sources: DataFrame, unicode: bool = True) -> DataFrame:
    """Paragraphs between blank lines, each normalised."""
    parts = sources.select("source_id", F.posexplode(F.split("raw", rf"\n{WS}*\n")).alias("pos", "part"))
    parts = parts.select("source_id", "pos", F.lit("paragraph").alias("type"), normalize_text(F.col("part"), unicode).alias("content")).where("content != ''")
    return as_sections(_numbered(parts, "pos"))


def code_blocks(sources: DataFrame, unicode: bool = True) -> DataFrame:
    """Program files (columns filename and format_type too): a heading with the name and one block of code."""
    head = F.struct(F.lit(0).alias("block_id"), F.lit("heading").alias("type"), F.array().cast("array<string>").alias("heading_path"), F.col("filename").alias("content"), F.lit(1).alias("level"), F.lit(None).cast("map<string,string>").alias("metadata"))
    code = F.struct(F.lit(1).alias("block_id"), F.lit("code_block").alias("type"), F.array("filename").alias("heading_path"), F.col("_code").alias("content"), F.lit(None).cast("int").alias("level"), F.create_map(F.lit("language"), F.col("format_type"), F.lit("filename"), F.col("filename")).alias("metadata"))
    return as_sections(sources.withColumn("_code", normalize_text(F.col("raw"), unicode)).select("source_id", F.inline(F.array(head, code))))


def markdown_blocks(sources: DataFrame, unicode: bool = True) -> DataFrame:
    """Headings, paragraphs, tables and fenced code, each with the headings above it.

    Any fence line opens or closes code. Consecutive paragraphs that begin with a pipe are one table.
    """
    order = Window.partitionBy("source_id").orderBy("pos")
    lines = sources.select("source_id", F.posexplode(F.split("raw", "\n")).alias("pos", "line"))
    lines = lines.withColumn("fence", F.col("line").rlike(FENCE))
    lines = lines.withColumn("fences", F.sum(F.col("fence").cast("int")).over(order))
    lines = lines.withColumn("code", ~F.col("fence") & (F.col("fences") % 2 == 1))
    lines = lines.withColumn("level", F.when(~F.col("fence") & ~F.col("code") & F.col("line").rlike(HEADING), F.length(F.regexp_extract("line", HEADING, 1))))
    # a fence or a heading ends the text before it; part counts these ends
    lines = lines.withColumn("part", F.sum((F.col("fence") | F.col("level").isNotNull()).cast("int")).over(order))
    heads = lines.where("level IS NOT NULL").select("source_id", "pos", F.lit("heading").alias("type"), "level", strip(F.regexp_extract("line", HEADING, 2)).alias("content"), F.lit(None).cast("string").alias("language"))
    bodies = lines.where("level IS NULL AND NOT fence").groupBy("source_id", "part", "code").agg(F.min("pos").alias("pos"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("text"))
    opened = lines.where("fence").select("source_id", "part", F.regexp_extract("line", FENCE, 2).alias("language"))
    code = bodies.where("code").join(opened, ["source_id", "part"]).select("source_id", "pos", F.lit("code_block").alias("type"), F.lit(None).cast("int").alias("level"), F.col("text").alias("content"), "language")
    text = bodies.where("NOT code").select("source_id", "pos", F.posexplode(paragraphs(normalize_text(F.col("text"), unicode))).alias("sub", "content"))
    text = text.select("source_id", "pos", "sub", F.lit("paragraph").alias("type"), F.lit(None).cast("int").alias("level"), "content", F.lit(None).cast("string").alias("language"))
    rows = with_breadcrumb(heads.unionByName(code).withColumn("sub", F.lit(0)).unionByName(text), "pos", "sub")
    return as_sections(_numbered(join_tables(rows), "pos", "sub"))


def join_tables(rows: DataFrame) -> DataFrame:
    """Runs of paragraphs that begin with a pipe become one table with the first one's path."""
    order = Window.partitionBy("source_id").orderBy("pos", "sub")
    piped = (F.col("type") == "paragraph") & F.startswith(lstrip(F.col("content")), F.lit("|"))
    rows = rows.withColumn("_piped", piped).withColumn("_run", F.sum((~F.col("_piped")).cast("int")).over(order))
    first = F.min(F.struct("pos", "sub", "heading_path"))
    tables = rows.where("_piped").groupBy("source_id", "_run").agg(first.alias("f"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "sub", "content"))), lambda x: x["content"]), "\n").alias("content"))
    tables = tables.select("source_id", F.col("f.pos").alias("pos"), F.col("f.sub").alias("sub"), F.lit("table").alias("type"), F.lit(None).cast("int").alias("level"), F.col("f.heading_path").alias("heading_path"), "content", F.create_map(F.lit("rows"), F.size(F.split("content", "\n")).cast("string")).alias("metadata"))
    language = F.when(F.col("type") == "code_block", F.create_map(F.lit("language"), F.col("language")))
    others = rows.where("NOT _piped").select("source_id", "pos", "sub", "type", "level", "heading_path", "content", language.alias("metadata"))
    return others.unionByName(tables)


def web_blocks(sources: DataFrame, unicode: bool = True) -> DataFrame:
    """Extracted web text (Markdown or stripped): headings, tables of two lines or more, paragraphs."""
    order = Window.partitionBy("source_id").orderBy("pos")
    lines = sources.select("source_id", F.posexplode(F.split("raw", "\n")).alias("pos", "line"))
    lines = lines.withColumn("level", F.when(F.col("line").rlike(HEADING), F.length(F.regexp_extract("line", HEADING, 1))))
    lines = lines.withColumn("part", F.sum(F.col("level").isNotNull().cast("int")).over(order))
    heads = lines.where("level IS NOT NULL").select("source_id", "pos", F.lit(0).alias("sub"), "level", strip(F.regexp_extract("line", HEADING, 2)).alias("content"))
    text = lines.where("level IS NULL").groupBy("source_id", "part").agg(F.min("pos").alias("pos"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("text"))
    text = text.select("source_id", "pos", F.posexplode(paragraphs(normalize_text(F.col("text"), unicode))).alias("sub", "content")).select("source_id", "pos", "sub", F.lit(None).cast("int").alias("level"), "content")
    rows = with_breadcrumb(heads.unionByName(text), "pos", "sub")
    n = F.size(F.split("content", "\n"))
    table = F.col("level").isNull() & F.startswith(lstrip(F.col("content")), F.lit("|")) & (n >= 2)
    kind = F.when(F.col("level").isNotNull(), "heading").when(table, "table").otherwise("paragraph")
    rows = rows.withColumn("type", kind).withColumn("metadata", F.when(table & (n > 2), F.create_map(F.lit("rows"), (n - 2).cast("string"))))
    return as_sections(_numbered(rows, "pos", "sub"))
