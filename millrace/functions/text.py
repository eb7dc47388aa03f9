"""Text functions with the same meaning in every engine: Unicode classes are spelled out."""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, word characters and digits as Unicode has them, for Java's and RE2's regular expressions.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WS_IN_LINE = r"[\t\x0b-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: The same white space as characters.
WS_CHARS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"


def nfkc(text: Column) -> Column:
    """Unicode compatibility normalisation: the one scalar that Spark lacks, run in Arrow's own code."""

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pc.utf8_normalize(part, form="NFKC")

    return F.arrow_udf(run, "string")(text)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WS_CHARS))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(WS_CHARS))


def lstrip(text: Column) -> Column:
    return F.ltrim(text, F.lit(WS_CHARS))


def unix_lines(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def _tidy(text: Column) -> Column:
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    # a match starts where a run does and never gives back: linear in the text
    return strip(F.regexp_replace(text, rf"(?<!{WS_IN_LINE}){WS_IN_LINE}++(?=\n|\z)", ""))


def normalize_text(text: Column, unicode: bool = True) -> Column:
    """NFKC, line feeds only, two of them at most, no white space at line ends or around."""
    return _tidy(unix_lines(nfkc(text) if unicode else text))


def normalize_block(text: Column, unicode: bool = True) -> Column:
    """normalize_text() that also folds runs of spaces, tabs and wide spaces into one space."""
    text = unix_lines(nfkc(text) if unicode else text)
    return _tidy(F.regexp_replace(text, r"[ \t\x{a0}\x{3000}]{2,}", " "))


def paragraphs(text: Column) -> Column:
    """Array of the non-empty, stripped parts between blank lines."""
    parts = F.transform(F.split(text, rf"\n{WS}*\n"), lambda p: strip(p))
    return F.filter(parts, lambda p: p != "")


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, rf"{WS}+"), lambda w: w != ""))


def token_estimate(text: Column) -> Column:
    """A quarter of the characters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4).cast("int"))


def sha1_prefix(text: Column, n: int = 8) -> Column:
    return F.substring(F.sha1(F.encode(text, "UTF-8")), 1, n)


def percent(ratio: Column) -> Column:
    """A ratio as a whole percentage, halves to even."""
    return F.concat(F.bround(ratio * 100, 0).cast("long").cast("string"), F.lit("%"))


def source_id(source: Column) -> Column:
    """File stem, or last part of a URL, made safe for file names, with eight hex digits of the source's SHA-1."""
    name = F.regexp_extract(F.regexp_replace(source, r"/+\z", ""), r"([^/]*)\z", 1)
    stem = F.when(F.regexp_like(name, F.lit(r"\A\.[^.]*\z")), name).otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]+\z", ""))
    url = F.regexp_like(source, F.lit(r"\Ahttps?://"))
    part = F.when(url, F.when(name == "", F.lit("webpage")).otherwise(name)).otherwise(stem)
    safe = F.regexp_replace(part, r"[^\p{L}\p{N}_\-.]", "_")
    return F.concat(F.when(safe == "", F.lit("document")).otherwise(safe), F.lit("_"), sha1_prefix(source))
