"""Web pages: main text by stripping tags, titles, and the ladder of extraction engines."""

from importlib.util import find_spec

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import WS, normalize_text, strip
from millrace.sources.blocks import web_blocks

#: Subtrees that go, elements whose end is a paragraph's, and entities in decoding order.
DROPPED = ["script", "style", "noscript", "svg", "nav", "footer", "header"]
CLOSERS = "p|div|li|h[1-6]|tr|section|article"
ENTITIES = [("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")]


def strip_tags(html: Column) -> Column:
    """Text of a page without scripts, styles and site chrome; block ends become blank lines."""
    text = F.regexp_replace(html, rf"(?is)<({'|'.join(DROPPED)})\b[^>]*>.*?</\1>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, rf"(?i)<br{WS}*/?>", "\n")
    text = F.regexp_replace(text, rf"(?i)</({CLOSERS})>", "\n\n")
    text = F.regexp_replace(text, r"<[^>]+>", "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def page_title(html: Column) -> Column:
    """The title element with white space folded, else the first h1 without its tags; 300 characters at most, null if neither."""
    title = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    head = F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    has = lambda tag: html.rlike(rf"(?is)<{tag}[^>]*>.*?</{tag}>")
    return F.when(has("title"), F.substring(strip(F.regexp_replace(title, rf"{WS}+", " ")), 1, 300)).when(has("h1"), F.substring(strip(F.regexp_replace(head, r"<[^>]+>", "")), 1, 300))


def engines() -> list[str]:
    """Engines of the extraction ladder that are installed, best first; stripping tags always works."""
    return [name for name, module in (("trafilatura", "trafilatura"), ("readability-lxml", "readability")) if find_spec(module)] + ["naive-strip"]


def extract_pages(pages: DataFrame, unicode: bool = True) -> DataFrame:
    """pages (source_id, html) -> source_id, title, raw (text), engine: the native rung of the ladder."""
    return pages.select("source_id", page_title(F.col("html")).alias("title"), normalize_text(strip_tags(F.col("html")), unicode).alias("raw"), F.lit("naive-strip").alias("engine"))


def page_blocks(pages: DataFrame, unicode: bool = True) -> DataFrame:
    return web_blocks(extract_pages(pages, unicode), unicode)
