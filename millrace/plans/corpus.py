"""From files to the two retrieval tiers: parse, clean, judge, chunk and summarise, catalogue."""

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import strip, word_count
from millrace.operators import catalog as cat
from millrace.operators import chunk, clean, layout, summarize, verdict
from millrace.schema import SECTION
from millrace.sources import blocks, formats, office, structured, web


@dataclass
class Parsed:
    """Sections, one row per parsed document, warnings and failures.

    A document's char_count is that of its decoded text (text formats only), properties what an Office file says of itself.
    """

    sections: DataFrame
    documents: DataFrame
    failures: DataFrame
    warnings: DataFrame


PROPERTIES = "source_id string, properties struct<author string, created string, modified string, subject string, paragraph_count int, table_count int, sheet_count int, sheets array<string>, slide_count int>"

#: Engines by family, added with register(): files -> raw elements of sources/office.py's schema. The last one wins.
ENGINES: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register(family: str, engine: Callable[[DataFrame], DataFrame]) -> None:
    """Use an engine for a format family, e.g. one that reads PDF pages or images."""
    ENGINES[family] = engine


def supports(format_type: str) -> bool:
    return format_type in formats.FAMILY


def parse(files: DataFrame, ocr: str | None = None) -> Parsed:
    """files (source, content) of any supported format -> Parsed; nothing a file holds fails a task."""
    spark = files.sparkSession
    known = formats.identify(files)
    of = lambda *f: known.where(F.col("family").isin(*f))
    found = {r[0] for r in known.select("format_type").distinct().collect()}  # at most the supported ones matter; absent formats get no branch
    has = lambda *exts: not found.isdisjoint(exts)
    paths = known.select(F.col("source_id").alias("_id"), F.col("source").alias("path"))
    by_path = lambda failed: failed.join(paths, F.col("source") == F.col("_id")).select(F.col("path").alias("source"), "error", "kind")
    text = of("plain", "markdown", "delimited", "json", "yaml", "code").withColumn("raw", structured.decode(F.col("content")))
    raw = lambda *exts: text.where(F.col("format_type").isin(*exts))
    sections, warnings = [spark.createDataFrame([], SECTION)], [spark.createDataFrame([], "source_id string, warning string")]
    failures, properties = [formats.unsupported(known)], []
    for family, read in (("plain", blocks.plain_blocks), ("markdown", blocks.markdown_blocks), ("code", blocks.code_blocks)):
        if has(*formats.FAMILIES[family]):
            sections.append(read(raw(*formats.FAMILIES[family])))
    for ext, delimiter in (("csv", ","), ("tsv", "\t")):
        if has(ext):
            sections.append(structured.delimited_blocks(raw(ext), delimiter))
    for exts, read in ((("json",), structured.json_blocks), (("jsonl", "ndjson"), structured.json_line_blocks), (("yaml", "yml"), structured.yaml_blocks)):
        if has(*exts):
            got, warned = read(raw(*exts))
            sections.append(got)
            warnings.append(warned)
    page = of("web").withColumn("html", structured.decode(F.col("content"), lenient=True))
    if has(*formats.FAMILIES["web"]):
        sections.append(web.page_blocks(page.select("source_id", "html")))
    for family in ("word", "sheet", "slides"):
        if has(*formats.FAMILIES[family]):
            elements = office.read_elements(of(family), family)
            sections.append(office.office_blocks(elements))
            warnings.append(office.office_warnings(elements))
            properties.append(office.office_properties(elements))
            failures.append(by_path(office.office_failures(elements)))
    for family, package in (("pdf", "pdfplumber"), ("image", "paddleocr")):
        if not has(*formats.FAMILIES[family]):
            continue
        if family in ENGINES:
            elements = ENGINES[family](of(family))
            sections.append(office.office_blocks(elements))
            properties.append(office.office_properties(elements))
            failures.append(by_path(office.office_failures(elements)))
        else:
            said = F.concat(F.lit("Format '"), "format_type", F.lit(f"' requires the '{package}' package, which is not installed. Install it with: pip install {package}"))
            failures.append(of(family).select("source", said.alias("error"), F.lit("missing_dependency").alias("kind")))
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    every, warned, failed = union(sections), union(warnings), union(failures)
    titles = page.select("source_id", web.page_title(F.col("html")).alias("web_title"))
    notes = warned.groupBy("source_id").agg(F.collect_list("warning").alias("warnings"))
    stats = every.groupBy("source_id").agg(F.sum(word_count(F.col("content"))).alias("word_count"), F.bool_or(F.col("type") == "heading").alias("has_headings"), F.count("*").alias("total_blocks_extracted"))
    good = known.where("family IS NOT NULL").join(failed.select("source"), "source", "left_anti").select("source_id", F.col("source").alias("source_path"), "format_type", "filename")
    docs = good.join(stats, "source_id", "left").join(notes, "source_id", "left")
    docs = docs.join(titles, "source_id", "left") if has(*formats.FAMILIES["web"]) else docs.withColumn("web_title", F.lit(None).cast("string"))
    counted = [f for n in ("plain", "markdown", "delimited", "json", "yaml", "code") for f in formats.FAMILIES[n]]
    if has(*counted):
        docs = docs.join(text.groupBy("source_id").agg(F.max(F.length("raw")).alias("char_count")), "source_id", "left")
    else:
        docs = docs.withColumn("char_count", F.lit(None).cast("int"))
    docs = docs.join(union(properties) if properties else spark.createDataFrame([], PROPERTIES), "source_id", "left")
    docs = docs.withColumn("title", F.coalesce("web_title", F.regexp_replace("filename", r"(?<=.)\.[^.]+\z", ""))).drop("web_title")
    docs = docs.withColumns({"word_count": F.coalesce("word_count", F.lit(0)), "has_headings": F.coalesce("has_headings", F.lit(False)), "warnings": F.coalesce("warnings", F.array().cast("array<string>"))})
    return Parsed(every, docs, failed, warned)


@dataclass
class Corpus:
    """Everything a run yields."""

    sections: DataFrame
    documents: DataFrame
    chunks: DataFrame
    summaries: DataFrame
    catalog: DataFrame
    review_queue: DataFrame
    failures: DataFrame
    report: DataFrame


@dataclass(frozen=True)
class Policy:
    """What a corpus fixes for all its documents."""

    cleaning: clean.Options = field(default_factory=clean.Options)
    cleaners: tuple[str, ...] | None = None
    chunking: chunk.Policy = field(default_factory=chunk.Policy)
    summary_budget: int = summarize.BUDGET
    only: tuple[str, ...] | None = None
    audit: bool = False


def build(parsed: Parsed, policy: Policy = Policy()) -> Corpus:
    """Clean, judge, and build both tiers; blocked documents reach only the review queue."""
    names = list(policy.cleaners) if policy.cleaners is not None else None
    docs = parsed.documents if policy.only is None else parsed.documents.where(F.col("source_id").isin(*policy.only))
    cleaned = clean.clean(parsed.sections, policy.cleaning, names).persist()  # verdict, chunks and summaries all read it
    stats = clean.cleaning_stats(parsed.sections, policy.cleaning, names) if policy.audit else clean.removals(parsed.sections, cleaned)
    judged = verdict.verdicts(docs.join(stats, "source_id", "left"), cleaned).persist()  # a row per document; gate, catalogue, queue and report read it
    good, _ = verdict.gate(judged)
    kept = cleaned.join(good.select("source_id"), "source_id", "left_semi")
    chunks, summaries = chunk.chunks(kept), summarize.summaries(kept)
    verified = cat.verify(judged, chunks, summaries)
    return Corpus(cleaned, judged, chunks, summaries, cat.catalog(judged, summaries, chunks), cat.review_queue(judged, verified, parsed.failures), parsed.failures, cat.run_report(judged, verified, parsed.failures))


def run(spark: SparkSession, path: str, recursive: bool = True, policy: Policy = Policy()) -> Corpus:
    return build(parse(formats.scan(spark, path, recursive)), policy)


def scanned_pdf(words: DataFrame, pages: DataFrame) -> DataFrame:
    """Sources (pages: source_id, page_count) whose native text is so thin that the OCR rung must read them."""
    return layout.looks_scanned(layout.page_blocks(layout.page_text(words)), pages).where("scanned").select("source_id")


def inspect(sections: DataFrame, first: int = 8) -> tuple[DataFrame, DataFrame]:
    """Counts by block type, and the first blocks of each source."""
    return sections.groupBy("source_id", "type").count(), sections.where(F.col("block_id") < first).select("source_id", "block_id", "type", F.substring(strip(F.col("content")), 1, 80).alias("start"))
