"""Page layout: words and boxes with coordinates become lines, columns and paragraphs."""

from collections.abc import Iterator
from importlib.util import find_spec
from math import inf, isfinite

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from millrace.functions.text import normalize_text
from millrace.schema import as_sections

#: Least words of a two-column page, half width of its gutter, words allowed in it, height of a line.
COLUMN_WORDS, GUTTER, GUTTER_SHARE, LINE = 60, 0.06, 0.03, 4
#: Gap between paragraphs in line heights, and the least text of a picture that isn't a diagram.
GAP, DENSITY = 1.8, 0.0005
HEADING_CHARS = 80
OCR_ENGINES = [("paddle", "paddleocr"), ("easyocr", "easyocr"), ("tesseract", "pytesseract")]


def outside_tables(words: DataFrame, boxes: DataFrame) -> DataFrame:
    """Words (source_id, page, x0, x1, top, bottom, ...) that lie in no table box of their page."""
    b = boxes.select(F.col("source_id").alias("_s"), F.col("page").alias("_p"), F.col("x0").alias("_x0"), F.col("top").alias("_t"), F.col("x1").alias("_x1"), F.col("bottom").alias("_b"))
    inside = (F.col("source_id") == F.col("_s")) & (F.col("page") == F.col("_p")) & (F.col("_x0") <= F.col("x0")) & (F.col("x1") <= F.col("_x1")) & (F.col("_t") <= F.col("top")) & (F.col("bottom") <= F.col("_b"))
    return words.join(b, inside, "left_anti")


def two_column_pages(words: DataFrame) -> DataFrame:
    """source_id, page, two_columns; words carry the page's width."""
    middle = F.abs(F.col("x0") - F.col("width") / 2) <= F.col("width") * GUTTER
    n = words.groupBy("source_id", "page").agg(F.count("*").alias("n"), F.count_if(middle).alias("m"))
    return n.select("source_id", "page", ((F.col("n") >= COLUMN_WORDS) & (F.col("m") / F.col("n") < GUTTER_SHARE)).alias("two_columns"))


def page_text(words: DataFrame) -> DataFrame:
    """source_id, page, text: words in lines of equal height (halves to even), columns one after the other."""
    columns = two_column_pages(words)
    w = words.join(columns, ["source_id", "page"]).withColumn("col", F.when(F.col("two_columns") & (F.col("x0") >= F.col("width") / 2), 1).otherwise(0))
    w = w.withColumn("row", F.bround(F.col("top") / LINE, 0).cast("long"))
    lines = w.groupBy("source_id", "page", "col", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "top", "text"))), lambda x: x["text"]), " ").alias("line"))
    cols = lines.groupBy("source_id", "page", "col").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "line"))), lambda x: x["line"]), "\n").alias("text"))
    return cols.groupBy("source_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "text"))), lambda x: x["text"]), "\n\n").alias("text"))


def page_blocks(texts: DataFrame, unicode: bool = True) -> DataFrame:
    """Paragraphs between blank lines of each page (source_id, page, text)."""
    parts = texts.select("source_id", "page", F.posexplode(F.split("text", r"\n\s*\n")).alias("pos", "part")).withColumn("content", normalize_text(F.col("part"), unicode)).where("content != ''")
    order = Window.partitionBy("source_id").orderBy("page", "pos")
    place = F.struct("page", F.lit(None).cast("string").alias("sheet"), F.lit(None).cast("int").alias("slide"))
    return as_sections(parts.select("source_id", (F.row_number().over(order) - 1).alias("block_id"), F.lit("paragraph").alias("type"), "content", place.alias("location")))


def ocr_text_blocks(texts: DataFrame, engine: str, unicode: bool = True) -> DataFrame:
    """Recovered text (source_id, text): short single lines without a sentence's end are headings."""
    parts = texts.select("source_id", F.posexplode(F.split("text", r"\n\s*\n")).alias("pos", "part")).withColumn("content", normalize_text(F.col("part"), unicode)).where("content != ''")
    c = F.col("content")
    head = (F.length(c) < HEADING_CHARS) & ~F.contains(c, F.lit("\n")) & ~c.rlike(r"[.。!！?？;；]\z")
    order = Window.partitionBy("source_id").orderBy("pos")
    return as_sections(parts.select("source_id", (F.row_number().over(order) - 1).alias("block_id"), F.when(head, "heading").otherwise("paragraph").alias("type"), F.when(head, 1).alias("level"), "content", F.create_map(F.lit("ocr_engine"), F.lit(engine)).alias("metadata")))


def looks_scanned(sections: DataFrame, pages: DataFrame, least: int = 25) -> DataFrame:
    """source_id, scanned: pages (source_id, page_count) with too little text outside tables."""
    chars = sections.where("type != 'table'").groupBy("source_id").agg(F.sum(F.length("content")).alias("c"))
    return pages.join(chars, "source_id", "left").select("source_id", ((F.col("page_count") == 0) | (F.coalesce("c", F.lit(0)) < least * F.col("page_count"))).alias("scanned"))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted boxes with `line`. Heads that end above the next box are behind; those kept overlap it, so few are of like height."""
    source, heads, lines, first = object(), [], 0, True
    for batch in batches:
        out = []
        for sid, slack, top, height in zip(*(batch.column(c).to_pylist() for c in ("source_id", "slack", "top", "height")), strict=True):
            if sid != source:
                source, heads, lines, first = sid, [], 0, True
            n = None
            if top is not None and height is not None:
                centre = top + height / 2
                # NaN compares as in SQL: equal to itself, larger than all else
                heads = [h for h in heads if not h[2] < top - slack]
                for c, size, _, line in heads:
                    reach = (height if height != height or height > size else size) * 0.5
                    if reach != reach or abs(c - centre) <= reach:
                        n = line
                        break
                else:
                    # the first head and those without finite places are never behind: a box of endless height meets them
                    stays = not isfinite(centre) or not isfinite(height) or first
                    first = first and not isfinite(centre)
                    heads.append((centre, height, inf if stays else max(top, top + height), lines))
            if n is None:
                n, lines = lines, lines + 1
            out.append(n)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("source_id", "top", "left", "height", "text")), pa.array(out, pa.int32())], ["source_id", "top", "left", "height", "text", "line"])


def box_lines(boxes: DataFrame) -> DataFrame:
    """boxes (source_id, top, left, height, text) with `line`: the first line whose leading box is level with it.

    Greedy, in reading order, over one picture's boxes: what a box joins depends on those before it. They are read
    once, sorted, and only the leading boxes that can still be met are held.
    """
    b = boxes.select("source_id", *(F.col(c).cast("double").alias(c) for c in ("top", "left", "height")), "text")
    # how far above a box's top a leading box can end that is still level with it: by negative heights and by rounding
    size = [F.max(F.when(F.abs(c) < float("inf"), F.abs(c))) for c in (F.col("top"), F.col("height"))]
    reach = F.greatest(F.lit(0.0), -F.min(F.when(F.col("height") > float("-inf"), F.col("height"))))
    slack = b.groupBy("source_id").agg((F.coalesce(reach, F.lit(0.0)) + 1e-14 * (F.coalesce(size[0], F.lit(0.0)) + F.coalesce(size[1], F.lit(0.0)))).alias("slack"))
    met = b.join(slack.withColumnRenamed("source_id", "_s"), F.col("source_id").eqNullSafe(F.col("_s"))).drop("_s")
    order = met.repartition("source_id").sortWithinPartitions("source_id", "top", "left", "height", "text")
    return order.select(*b.columns, "slack").mapInArrow(_sweep, StructType([*b.schema.fields, StructField("line", IntegerType())]))


def box_blocks(boxes: DataFrame, engine: str = "ocr", unicode: bool = True) -> DataFrame:
    """Lines from left to right; a gap of more than 1.8 upper-median box heights begins a paragraph."""
    placed = box_lines(boxes)
    counts = boxes.groupBy("source_id", F.col("height").cast("double").alias("height")).count()
    by = Window.partitionBy("source_id")
    upto = F.sum("count").over(by.orderBy("height"))
    known = counts.where("height IS NOT NULL").withColumn("_upto", upto).withColumn("_all", F.sum("count").over(by))
    median = known.where(F.col("_upto") > F.floor(F.col("_all") / 2)).groupBy("source_id").agg(F.min("height").alias("median"))
    lines = placed.groupBy("source_id", "line").agg(F.min("top").alias("top"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("left", "top", "text"))), lambda x: x["text"]), " ").alias("text")).join(median, "source_id", "left")
    order = Window.partitionBy("source_id").orderBy("top", "line")
    far = F.coalesce(F.col("top") - F.lag("top").over(order) > F.col("median") * GAP, F.lit(False))
    lines = lines.withColumn("_far", far.cast("int")).withColumn("para", F.sum("_far").over(order)).withColumn("_n", F.row_number().over(order))
    paras = lines.groupBy("source_id", "para").agg(normalize_text(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "text"))), lambda x: x["text"]), "\n"), unicode).alias("content")) if not unicode else lines.groupBy("source_id", "para").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "text"))), lambda x: x["text"]), "\n").alias("t")).select("source_id", "para", normalize_text(F.col("t")).alias("content"))
    paras = paras.where("content != ''")
    return as_sections(paras.select("source_id", (F.row_number().over(Window.partitionBy("source_id").orderBy("para")) - 1).alias("block_id"), F.lit("paragraph").alias("type"), "content", F.create_map(F.lit("ocr_engine"), F.lit(engine)).alias("metadata")))


def text_density(images: DataFrame) -> DataFrame:
    """images (source_id, width, height, chars) with text_density and diagram."""
    d = F.col("chars") / F.greatest(F.col("width") * F.col("height"), F.lit(1))
    return images.withColumn("text_density", F.round(d, 6)).withColumn("diagram", d < DENSITY)


def expand_merged(cells: DataFrame, ranges: DataFrame) -> DataFrame:
    """cells (source_id, row, col, value) where each cell of a merged range shows its top-left value; a null one changes nothing."""
    first = ranges.join(cells.withColumnRenamed("value", "top_value"), (ranges["source_id"] == cells["source_id"]) & (F.col("min_row") == F.col("row")) & (F.col("min_col") == F.col("col"))).where("top_value IS NOT NULL").select(ranges["source_id"].alias("_s"), "min_row", "max_row", "min_col", "max_col", "top_value")
    hit = (F.col("source_id") == F.col("_s")) & F.col("row").between(F.col("min_row"), F.col("max_row")) & F.col("col").between(F.col("min_col"), F.col("max_col"))
    return cells.join(first, hit, "left").select("source_id", "row", "col", F.coalesce("top_value", "value").alias("value"))


def reading_order(shapes: DataFrame) -> DataFrame:
    """shapes (source_id, slide, top, left, ...) with `nth`: from top (to ten thousands, halves to even) to bottom, then from the left."""
    return shapes.withColumn("nth", F.row_number().over(Window.partitionBy("source_id", "slide").orderBy(F.bround("top", -4), "left")))


def ocr_engines() -> list[str]:
    return [name for name, module in OCR_ENGINES if find_spec(module)]
