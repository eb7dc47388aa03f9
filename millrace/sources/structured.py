"""Encodings, delimited tables, JSON and YAML: parsed in Arrow batches, rendered as blocks.

A file that can't be parsed gives warnings or a failure row, never a failed task.
"""

import csv
import io
import json
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import strip
from millrace.schema import as_sections
from millrace.sources.blocks import plain_blocks

#: Encodings in the order they are tried, and the widest table shown as a table.
ENCODINGS = ["utf-8", "utf-8-sig", "gb18030", "big5", "latin-1"]
WIDEST = 12
#: Keys of a lot, in which rows are numbered.
LOT = 4096


def decode(content: Column, lenient: bool = False) -> Column:
    """Bytes to text by the first encoding that fits (lenient: UTF-8 with replacement), lines ended by line feeds."""

    def one(data: bytes | None) -> str | None:
        if data is None:
            return None
        if lenient:
            return data.decode("utf-8", "replace")
        for name in ENCODINGS:
            try:
                return data.decode(name).replace("\r\n", "\n").replace("\r", "\n")
            except UnicodeDecodeError:
                continue
        return None

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([one(x) for x in part.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(content)


def _map(kind: str, fn: Callable[[str], Any], arrow: pa.DataType) -> Callable[[Column], Column]:
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([None if x is None else fn(x) for x in part.to_pylist()], arrow)

    return lambda c: F.arrow_udf(run, kind)(c)


def read_cells(raw: Column, delimiter: str = ",") -> Column:
    """array<array<string>>: rows with at least one cell that isn't blank."""

    def cells(text: str) -> list[list[str]]:
        csv.field_size_limit(max(csv.field_size_limit(), len(text) + 1))
        try:
            return [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=delimiter) if any(c.strip() for c in r)]
        except csv.Error:  # no table: each line is one cell
            return [[line] for line in text.split("\n") if line.strip()]

    return _map("array<array<string>>", cells, pa.list_(pa.list_(pa.string())))(raw)


def markdown_grid(rows: Column, escape_head: bool = True, one_line: bool = False) -> Column:
    """Cells as a Markdown table: rows padded to the widest, pipes escaped."""
    width = F.array_max(F.transform(rows, lambda r: F.size(r)))

    def line(r: Column, escape: Column) -> Column:
        padded = F.concat(r, F.array_repeat(F.lit(""), width - F.size(r)))
        cell = lambda c: F.when(escape, F.replace(c, F.lit("|"), F.lit("\\|"))).otherwise(c)
        cells = F.transform(padded, lambda c: F.replace(cell(c), F.lit("\n"), F.lit(" ")) if one_line else cell(c))
        return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    lines = F.transform(rows, lambda r, i: line(r, (i > 0) | F.lit(escape_head)))
    rule = F.concat(F.lit("|"), F.array_join(F.array_repeat(F.lit("---"), width), "|"), F.lit("|"))
    return F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))), "\n")


def table_blocks(tables: DataFrame) -> DataFrame:
    """tables (source_id, rows array<array<string>>, the first is the header) -> one table, or a record per row if it is wide.

    Body rows are cut or padded to the header's width; a wide table's blank cells are left out.
    """
    t = tables.where(F.size("rows") > 0).select("source_id", F.transform(F.element_at("rows", 1), lambda c: strip(c)).alias("head"), F.slice("rows", 2, F.size("rows")).alias("body"))
    n = F.size("head")
    fit = F.transform("body", lambda r: _fit(r, n))
    meta = F.create_map(F.lit("columns"), n.cast("string"), F.lit("rows"), F.size("body").cast("string"))
    narrow = t.where(n <= WIDEST).select("source_id", F.lit(0).alias("block_id"), F.lit("table").alias("type"), markdown_grid(F.concat(F.array("head"), fit), escape_head=False).alias("content"), meta.alias("metadata"))
    wide = t.where(n > WIDEST)
    head = wide.select("source_id", F.lit(0).alias("block_id"), F.lit("heading").alias("type"), F.lit(1).alias("level"), F.lit("Wide table (transposed)").alias("content"), meta.alias("metadata"))
    records = _record_texts(wide.select("source_id", "head", F.posexplode("body").alias("i", "row")))
    rows = _record_sections(records, F.row_number().over(Window.partitionBy("source_id").orderBy("i")))
    out = as_sections(narrow).unionByName(as_sections(head))
    return out.unionByName(rows)


def numbered(rows: DataFrame, key: str, name: str) -> DataFrame:
    """rows with `name`: the place, from 0, in its source by a whole-number key that is unique there.

    A place is the offset of the key's lot plus the place in the lot, so no task holds a whole source.
    """
    lots = rows.withColumn("_lot", F.floor(F.col(key) / LOT))
    counts = lots.groupBy("source_id", "_lot").agg(F.count("*").alias("_n"))  # a row for each LOT keys
    offsets = counts.select("source_id", "_lot", (F.sum("_n").over(Window.partitionBy("source_id").orderBy("_lot")) - F.col("_n")).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("source_id", "_lot").orderBy(key)) - 1
    return lots.withColumn("_place", place).join(offsets, ["source_id", "_lot"]).withColumn(name, (F.col("_offset") + F.col("_place")).cast("int")).drop("_lot", "_place", "_offset")


def record_blocks(records: DataFrame) -> DataFrame:
    """The records that table_blocks makes of a wide table, from its body rows (source_id, head, i, row), of any number."""
    n = F.size("head")
    got = _record_texts(records.select("source_id", F.transform("head", lambda c: strip(c)).alias("head"), "i", _fit(F.col("row"), n).alias("row")))
    return _record_sections(numbered(got, "i", "_block"), F.col("_block") + 1)


def _fit(row: Column, n: Column) -> Column:
    return F.transform(F.slice(F.concat(row, F.array_repeat(F.lit(""), F.greatest(n - F.size(row), F.lit(0)))), 1, n), lambda c: strip(c))


def _record_texts(records: DataFrame) -> DataFrame:
    """source_id, i, content of the rows (source_id, head, i, row) that aren't blank."""
    pairs = F.filter(F.arrays_zip(F.col("head").alias("h"), F.slice("row", 1, F.size("head")).alias("c")), lambda x: F.coalesce(strip(x["c"]), F.lit("")) != "")
    named = F.transform("head", lambda h, j: F.when(h == "", F.concat(F.lit("col"), j.cast("string"))).otherwise(h))
    records = records.withColumn("head", named).withColumn("pairs", pairs).where(F.size("pairs") > 0)
    said = F.transform("pairs", lambda x: F.concat(F.lit("- "), x["h"], F.lit(": "), strip(x["c"])))
    return records.select("source_id", "i", F.concat(F.lit("**Record "), (F.col("i") + 1).cast("string"), F.lit("**\n"), F.array_join(said, "\n")).alias("content"))


def _record_sections(texts: DataFrame, block_id: Column) -> DataFrame:
    return as_sections(texts.select("source_id", block_id.alias("block_id"), F.lit("paragraph").alias("type"), "content", F.create_map(F.lit("record_index"), F.col("i").cast("string")).alias("metadata")))


def delimited_blocks(sources: DataFrame, delimiter: str = ",") -> DataFrame:
    return table_blocks(sources.select("source_id", read_cells(F.col("raw"), delimiter).alias("rows")))


def flatten(value: Any, prefix: str = "") -> str:
    """Leaves of nested data as `path: value` lines; an empty list shows as [], no leaf at all as (empty)."""
    out: list[str] = []
    stack = [(value, prefix)]
    while stack:
        node, path = stack.pop()
        if isinstance(node, dict):
            stack += [(v, f"{path}.{k}" if path else str(k)) for k, v in reversed(node.items())]
        elif isinstance(node, list) and node:
            stack += [(v, f"{path}[{i}]") for i, v in reversed(list(enumerate(node)))]
        else:
            out.append(f"{path}: {node}")
    return "\n".join(out) or "(empty)"


def _json(text: str) -> dict:
    try:
        data = json.loads(text)
        return {"flat": flatten(data), "root": type(data).__name__, "warning": None}
    except (ValueError, RecursionError) as e:  # too deep for the parser, too: the text is taken as it is
        return {"flat": None, "root": None, "warning": f"Invalid JSON, falling back to plain text: {e}"}


def _yaml(text: str) -> dict:
    try:
        import yaml
    except ImportError:
        return {"flat": None, "root": None, "warning": "PyYAML not installed (pip install pyyaml); treating as plain text"}
    try:
        data = yaml.safe_load(text)
        return {"flat": flatten(data) if isinstance(data, (dict, list)) else None, "root": type(data).__name__, "warning": None}
    except (yaml.YAMLError, ValueError, TypeError, OverflowError, RecursionError) as e:  # impossible dates, keys that can't be hashed, depth
        return {"flat": None, "root": None, "warning": f"Invalid YAML, treating as plain text: {e}"}


def _records(text: str) -> list[dict]:
    out, n = [], 0
    for i, line in enumerate(text.split("\n"), 1):
        if not line.strip():
            continue
        try:
            out.append({"i": n, "flat": flatten(json.loads(line), f"record[{n}]"), "warning": None})
            n += 1
        except (ValueError, RecursionError) as e:
            out.append({"i": None, "flat": None, "warning": f"Line {i} is not valid JSON: {e}"})
    return out


_FLAT = pa.struct([("flat", pa.string()), ("root", pa.string()), ("warning", pa.string())])
flatten_json = _map("struct<flat:string,root:string,warning:string>", _json, _FLAT)
flatten_yaml = _map("struct<flat:string,root:string,warning:string>", _yaml, _FLAT)
json_records = _map("array<struct<i:int,flat:string,warning:string>>", _records, pa.list_(pa.struct([("i", pa.int32()), ("flat", pa.string()), ("warning", pa.string())])))


def _nested(sources: DataFrame, flat: Callable[[Column], Column], root_key: str | None) -> tuple[DataFrame, DataFrame]:
    got = sources.select("source_id", "raw", flat(F.col("raw")).alias("x"))
    meta = F.create_map(F.lit(root_key), F.col("x.root")) if root_key else F.lit(None).cast("map<string,string>")
    good = as_sections(got.where("x.flat IS NOT NULL").select("source_id", F.lit(0).alias("block_id"), F.lit("paragraph").alias("type"), F.col("x.flat").alias("content"), meta.alias("metadata")))
    plain = plain_blocks(got.where("x.flat IS NULL").select("source_id", "raw"))
    return good.unionByName(plain), got.where("x.warning IS NOT NULL").select("source_id", F.col("x.warning").alias("warning"))


def json_blocks(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sections and warnings (source_id, warning); invalid JSON falls back to plain text."""
    return _nested(sources, flatten_json, "json_root_type")


def yaml_blocks(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _nested(sources, flatten_yaml, None)


def json_line_blocks(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One paragraph per valid line, numbered among the valid ones; warnings for the others."""
    got = sources.select("source_id", F.explode(json_records(F.col("raw"))).alias("x"))
    rows = got.where("x.i IS NOT NULL").select("source_id", F.col("x.i").alias("block_id"), F.lit("paragraph").alias("type"), F.col("x.flat").alias("content"), F.create_map(F.lit("record_index"), F.col("x.i").cast("string")).alias("metadata"))
    return as_sections(rows), got.where("x.warning IS NOT NULL").select("source_id", F.col("x.warning").alias("warning"))
