"""The cleaning pipeline over sections: nine cleaners in a fixed order.

Each cleaner is DataFrame -> DataFrame. clean() runs those that are asked for, in the canonical order,
and says per source which of them changed the number of blocks.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import DIGIT, WORD, WS, normalize_block, rstrip, strip

#: Lines that are page numbers, stamps or noise.
PAGE_NUMBERS = [
    rf"\A{WS}*[-–—]?{WS}*{DIGIT}{{1,4}}{WS}*[-–—]?{WS}*\z",
    rf"(?i)\A{WS}*Page{WS}+{DIGIT}+({WS}+of{WS}+{DIGIT}+)?{WS}*\z",
    rf"\A{WS}*第{WS}*{DIGIT}+{WS}*页({WS}*[/共]{WS}*{DIGIT}+{WS}*页)?{WS}*\z",
    rf"\A{WS}*{DIGIT}+{WS}*/{WS}*{DIGIT}+{WS}*\z",
]
WATERMARKS = [
    rf"(?i)\A{WS}*(confidential|internal use only|draft|do not distribute){WS}*\z",
    rf"\A{WS}*(机密|内部资料|仅供内部使用|草稿|禁止外传){WS}*\z",
    rf"(?i)\A{WS}*downloaded{WS}+(from|by){WS}+.*\z",
    rf"(?i)\A{WS}*www\.[\p{{L}}\p{{N}}_\-.]+\.[a-z]{{2,}}{WS}*\z",
]
NOISE = r"\A[^\p{L}\p{N}_\x{4e00}-\x{9fff}]{1,6}\z"
HYPHENATED = rf"({WORD}+)-\n({WS}*)([a-z]{WORD}+)"
SENTENCE_END = r"[.。!！?？:：]\z"
FIXED = ["table", "code_block"]


@dataclass(frozen=True)
class Options:
    min_chars: int = 2
    merge_threshold: int = 80
    boilerplate_ratio: float = 0.35
    boilerplate_least: int = 3
    boilerplate_line: int = 200
    unicode: bool = True


def _rewritten(sections: DataFrame, content: Column) -> DataFrame:
    """sections with new content, computed once: a generator keeps the optimiser from copying the expression into later filters and cleaners."""
    return sections.withColumn("content", F.explode(F.array(content)))


def _lines(content: Column, keep: Callable[[Column], Column]) -> Column:
    return strip(F.array_join(F.filter(F.split(content, "\n"), keep), "\n"))


def _drop_lines(sections: DataFrame, passed: list[str], keep: Callable[[Column], Column]) -> DataFrame:
    """Sections of the passed types stay as they are; others lose lines, and go if nothing is left."""
    out = _rewritten(sections, F.when(F.col("type").isin(passed), F.col("content")).otherwise(_lines(F.col("content"), keep)))
    return out.where(F.col("type").isin(passed) | (F.col("content") != ""))


def _none_of(patterns: list[str]) -> Callable[[Column], Column]:
    def keep(line: Column) -> Column:
        ok = ~line.rlike(patterns[0])
        for p in patterns[1:]:
            ok = ok & ~line.rlike(p)
        return ok

    return keep


def normalize(sections: DataFrame, opts: Options) -> DataFrame:
    out = _rewritten(sections, normalize_block(F.col("content"), opts.unicode))
    return out.where((F.col("content") != "") | (F.col("type") == "heading"))


def line_noise(sections: DataFrame, opts: Options) -> DataFrame:
    return _drop_lines(sections, FIXED, lambda x: (strip(x) != "") & ~strip(x).rlike(NOISE))


def page_artifacts(sections: DataFrame, opts: Options) -> DataFrame:
    return _drop_lines(sections, [*FIXED, "heading"], _none_of(PAGE_NUMBERS))


def watermarks(sections: DataFrame, opts: Options) -> DataFrame:
    return _drop_lines(sections, [*FIXED, "heading"], _none_of(WATERMARKS))


def boilerplate_lines(sections: DataFrame, opts: Options) -> DataFrame:
    """source_id, key: lines that stand in so many sections of a source that they are running heads.

    The threshold is floor(sections * ratio) in double arithmetic, boilerplate_least at least; sources
    of fewer than three sections have none.
    """
    keys = F.filter(F.array_distinct(F.transform(F.split("content", "\n"), lambda x: strip(x))), lambda x: (x != "") & (F.length(x) <= opts.boilerplate_line))
    keys = F.coalesce(F.when(~F.col("type").isin(FIXED), keys), F.array().cast("array<string>"))
    # a null key for each section counts them in the same pass; only counts are shuffled
    counts = sections.select("source_id", F.explode(F.concat(F.array(F.lit(None).cast("string")), keys)).alias("key")).groupBy("source_id", "key").agg(F.count("*").alias("c"))
    often = counts.where(F.col("key").isNull() | (F.col("c") >= opts.boilerplate_least))
    often = often.withColumn("n", F.max(F.when(F.col("key").isNull(), F.col("c"))).over(Window.partitionBy("source_id")))
    least = F.greatest(F.lit(opts.boilerplate_least).cast("long"), F.floor(F.col("n") * F.lit(float(opts.boilerplate_ratio))))
    return often.where(F.col("key").isNotNull() & (F.col("n") >= 3) & (F.col("c") >= least)).select("source_id", "key")


def boilerplate(sections: DataFrame, opts: Options) -> DataFrame:
    """Running heads go line by line; a heading stays even if it is left empty. Sources without any aren't touched."""
    found = boilerplate_lines(sections, opts).groupBy("source_id").agg(F.collect_set("key").alias("_keys"))  # fewer than 1 / ratio lines a section
    out = sections.join(found, "source_id", "left")
    hit = F.col("_keys").isNotNull() & ~F.col("type").isin(FIXED)
    out = _rewritten(out, F.when(hit, _lines(F.col("content"), lambda x: ~F.array_contains("_keys", strip(x)))).otherwise(F.col("content")))
    return out.where(~hit | (F.col("content") != "") | (F.col("type") == "heading")).drop("_keys")


def dehyphenate(sections: DataFrame, opts: Options) -> DataFrame:
    return _rewritten(sections, F.when(F.col("type") == "code_block", F.col("content")).otherwise(F.regexp_replace("content", HYPHENATED, "$1$3")))


def merge_fragments(sections: DataFrame, opts: Options) -> DataFrame:
    """Short or unfinished paragraphs take in the next one of the same path and location.

    A fold over a source's blocks in order: what comes next depends on what has been joined so far.
    Runs of blocks that can join at all are found first by windows, so the fold holds one run.
    """
    order = Window.partitionBy("source_id").orderBy("block_id")
    solid = F.col("type").isin([*FIXED, "heading"])
    rows = sections.withColumn("_solid", solid)
    same = F.col("heading_path").eqNullSafe(F.lag("heading_path").over(order)) & F.col("location").eqNullSafe(F.lag("location").over(order)) & ~F.lag("_solid").over(order) & ~F.col("_solid")
    rows = rows.withColumn("_same", F.coalesce(same, F.lit(False))).withColumn("_run", F.sum((~F.col("_same")).cast("int")).over(order))
    fields = ["block_id", "type", "heading_path", "content", "level", "location", "metadata"]
    runs = rows.groupBy("source_id", "_run").agg(F.array_sort(F.collect_list(F.struct(*fields)), lambda a, b: a["block_id"] - b["block_id"]).alias("xs"))
    item = runs.schema["xs"].dataType.simpleString()

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        open_ = (F.length(last["content"]) < opts.merge_threshold) | ~rstrip(last["content"]).rlike(SENTENCE_END)
        joined = strip(F.concat(F.regexp_replace(last["content"], r"-+\z", ""), F.when(F.endswith(last["content"], F.lit("-")), F.lit("")).otherwise(F.lit(" ")), x["content"]))
        merged = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(last.withField("content", joined)))
        return F.when((F.size(acc) > 0) & open_, merged).otherwise(F.concat(acc, F.array(x)))

    folded = F.aggregate("xs", F.array().cast(item), step)
    out = runs.select("source_id", F.inline(F.when(F.size("xs") == 1, F.col("xs")).otherwise(folded)))
    return out.where(F.col("type").isin([*FIXED, "heading"]) | (F.col("content") != "")).select("source_id", *fields)


def dedupe(sections: DataFrame, opts: Options) -> DataFrame:
    """Paragraphs and list items that stand earlier in the source with the same type and path go."""
    first = F.row_number().over(Window.partitionBy("source_id", "type", "heading_path", "content").orderBy("block_id")) == 1
    return sections.withColumn("_first", first).where(F.col("_first") | ~F.col("type").isin(["paragraph", "list_item"])).drop("_first")


def min_length(sections: DataFrame, opts: Options) -> DataFrame:
    return sections.where(F.col("type").isin(["heading", *FIXED]) | (F.length(strip(F.col("content"))) >= opts.min_chars))


#: In canonical order.
CLEANERS: dict[str, Callable[[DataFrame, Options], DataFrame]] = {
    "normalize": normalize,
    "line_noise": line_noise,
    "page_artifacts": page_artifacts,
    "watermarks": watermarks,
    "boilerplate": boilerplate,
    "dehyphenate": dehyphenate,
    "merge_fragments": merge_fragments,
    "dedupe": dedupe,
    "min_length": min_length,
}


def reindex(sections: DataFrame) -> DataFrame:
    return sections.withColumn("block_id", F.row_number().over(Window.partitionBy("source_id").orderBy("block_id")) - 1)


def chosen(names: list[str] | str | None) -> list[str]:
    """Cleaners in canonical order; None means all. Unknown names are an error."""
    if names is None:
        return list(CLEANERS)
    asked = [n.strip() for n in (names.split(",") if isinstance(names, str) else names) if n.strip()]
    if unknown := set(asked) - set(CLEANERS):
        raise ValueError(f"unknown cleaners: {', '.join(sorted(unknown))}")
    return [n for n in CLEANERS if n in asked]


def clean(sections: DataFrame, opts: Options = Options(), enabled: list[str] | str | None = None) -> DataFrame:
    """The cleaned sections with contiguous block ids."""
    for name in chosen(enabled):
        sections = CLEANERS[name](sections, opts)
    return reindex(sections)


def removals(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """source_id, blocks_before, blocks_after, blocks_removed from the two ends of the pipeline."""
    before = raw.groupBy("source_id").agg(F.count("*").alias("blocks_before"))
    after = cleaned.groupBy("source_id").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return before.join(after, "source_id", "left").select("source_id", "blocks_before", n.alias("blocks_after"), (F.col("blocks_before") - n).alias("blocks_removed"))


def cleaning_stats(sections: DataFrame, opts: Options = Options(), enabled: list[str] | str | None = None) -> DataFrame:
    """Per source: cleaners_applied (those that changed the number of blocks), blocks_before, _after, _removed.

    It counts after every cleaner, so it runs the chain once for each: an audit. removals() has the
    counts that a verdict needs.
    """
    names = chosen(enabled)
    step = sections
    counts = sections.groupBy("source_id").agg(F.count("*").alias("n0"))
    for i, name in enumerate(names, 1):
        step = CLEANERS[name](step, opts)
        counts = counts.join(step.groupBy("source_id").agg(F.count("*").alias(f"n{i}")), "source_id", "left")
    n = [F.coalesce(F.col(f"n{i}"), F.lit(0)) for i in range(len(names) + 1)]
    applied = F.array_compact(F.array(*(F.when(n[i] != n[i + 1], name) for i, name in enumerate(names)))) if names else F.array().cast("array<string>")
    return counts.select("source_id", applied.alias("cleaners_applied"), n[0].alias("blocks_before"), n[-1].alias("blocks_after"), (n[0] - n[-1]).alias("blocks_removed"))
