"""Chunks: the fine tier of retrieval."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import sha1_prefix, strip, token_estimate


@dataclass(frozen=True)
class Policy:
    """Token bounds of a corpus; a policy beats any judgement by document."""

    least: int = 128
    target: int = 512
    most: int = 1024
    overlap: float = 0.15
    short: int = 500
    child: int = 320
    parent: int = 1500
    protected: tuple[str, ...] = ("table", "code_block")


def chunks(sections: DataFrame) -> DataFrame:
    """Body blocks under each heading, one chunk; a heading without a body has none.

    Columns: chunk_id, source_id, chunk_index, text (with the heading), raw_text, heading_path,
    token_count, is_full_document. Blocks before any heading form a chunk without a path.
    """
    order = Window.partitionBy("source_id").orderBy("block_id")
    rows = sections.withColumn("part", F.sum((F.col("type") == "heading").cast("int")).over(order))
    parts = rows.groupBy("source_id", "part").agg(
        F.min(F.when(F.col("type") == "heading", F.col("content"))).alias("heading"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("type") != "heading", F.struct("block_id", "content")))), lambda x: x["content"]), "\n").alias("body"),
    )
    parts = parts.withColumn("raw_text", strip(F.col("body"))).where("raw_text != ''")
    parts = parts.withColumn("chunk_index", F.row_number().over(Window.partitionBy("source_id").orderBy("part")) - 1)
    named = F.coalesce("heading", F.lit("")) != ""
    return parts.select(
        F.concat_ws("::", "source_id", F.col("chunk_index").cast("string"), sha1_prefix(F.substring("raw_text", 1, 80))).alias("chunk_id"),
        "source_id",
        "chunk_index",
        F.when(named, F.concat("heading", F.lit("\n\n"), "raw_text")).otherwise(F.col("raw_text")).alias("text"),
        "raw_text",
        F.when(named, F.array("heading")).otherwise(F.array().cast("array<string>")).alias("heading_path"),
        token_estimate(F.col("raw_text")).alias("token_count"),
        F.lit(False).alias("is_full_document"),
    )


def breadcrumb_text(chunk: DataFrame) -> DataFrame:
    """Chunks whose text begins with the whole path."""
    return chunk.withColumn("text", F.when(F.size("heading_path") > 0, F.concat(F.array_join("heading_path", " > "), F.lit("\n\n"), "raw_text")).otherwise(F.col("raw_text")))


def keep_short_whole(sections: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """chunks(), but a document of up to policy.short tokens is one chunk."""
    sizes = sections.groupBy("source_id").agg(F.sum(token_estimate(F.col("content"))).alias("tokens"))
    short = sizes.where(F.col("tokens") <= policy.short).select("source_id")
    whole = sections.join(short, "source_id").groupBy("source_id").agg(strip(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_id", "content"))), lambda x: x["content"]), "\n")).alias("raw_text")).where("raw_text != ''")
    whole = whole.select(F.concat_ws("::", "source_id", F.lit("0"), sha1_prefix(F.substring("raw_text", 1, 80))).alias("chunk_id"), "source_id", F.lit(0).alias("chunk_index"), F.col("raw_text").alias("text"), "raw_text", F.array().cast("array<string>").alias("heading_path"), token_estimate(F.col("raw_text")).alias("token_count"), F.lit(True).alias("is_full_document"))
    return chunks(sections.join(short, "source_id", "left_anti")).unionByName(whole)


#: Where a sentence that is too long is cut, first choice first; what is left is cut at any character.
FINER = ("\n", "; ", ",", " ")


def _pieces(content: Column, most: int) -> Column:
    """The sentences of a text, none of more than `most` characters; joined they are the text."""

    def cut(parts: Column, by: Callable[[Column], Column]) -> Column:
        return F.flatten(F.transform(parts, lambda s: F.when(F.length(s) > most, by(s)).otherwise(F.array(s))))

    out = F.split(content, r"(?<=\n\n)|(?<=[.!?] )")
    for sep in FINER:
        out = cut(out, lambda s: F.split(s, f"(?<={sep})"))
    return cut(out, lambda s: F.regexp_extract_all(s, F.lit(f"(?s).{{1,{most}}}"), F.lit(0)))


def packed(sections: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Chunks near the target size: each holds the sentences that end in its stretch of policy.target tokens; protected blocks stay whole.

    A sentence of more than a quarter of the target is cut at the next finer separator, at last at any
    character, so a chunk has at most 1.25 times the target and the overlap: it begins again with the
    last sentences of the one before, as far as they fit. nth counts from 0 without gaps (a stretch of
    white space alone is left out). Blocks are joined by a line end.
    Columns: source_id, part, nth, text, token_count, oversized.
    """
    order = Window.partitionBy("source_id").orderBy("block_id")
    rows = sections.withColumn("part", F.sum(((F.col("type") == "heading") | F.col("type").isin(*policy.protected)).cast("int")).over(order) * 2 + F.col("type").isin(*policy.protected).cast("int") - 1)
    atoms = rows.where(F.col("type").isin(*policy.protected)).select("source_id", F.col("block_id").alias("part"), F.lit(0).alias("nth"), F.col("content").alias("text"), token_estimate(F.col("content")).alias("token_count"))
    prose = rows.where(~F.col("type").isin("heading", *policy.protected))
    pieces = prose.select("source_id", "block_id", "part", F.posexplode(_pieces(F.concat("content", F.lit("\n")), max(4, policy.target))).alias("k", "s")).where("s != ''")
    w = Window.partitionBy("source_id", "part").orderBy("block_id", "k")
    pieces = pieces.withColumn("tokens", token_estimate(F.col("s"))).withColumn("upto", F.sum("tokens").over(w))
    pieces = pieces.withColumn("nth", F.floor((F.col("upto") - 1) / policy.target).cast("int"))
    ahead = Window.partitionBy("source_id", "part", "nth").orderBy(F.desc("block_id"), F.desc("k"))
    tail = F.sum("tokens").over(ahead) <= int(policy.target * policy.overlap)
    last = F.max("nth").over(Window.partitionBy("source_id", "part"))
    again = F.when(F.col("_tail") & (F.col("nth") < F.col("_last")), F.array("nth", F.col("nth") + 1)).otherwise(F.array("nth"))
    every = pieces.withColumn("_last", last).withColumn("_tail", tail).select("source_id", "part", F.explode(again).alias("nth"), "block_id", "k", "s")
    text = every.groupBy("source_id", "part", "nth").agg(F.min("block_id").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_id", "k", "s"))), lambda x: x["s"]), "").alias("text"))
    text = text.select("source_id", F.col("first").alias("part"), "nth", strip(F.col("text")).alias("text")).withColumn("token_count", token_estimate(F.col("text"))).where("text != ''")
    return text.unionByName(atoms).withColumn("oversized", F.col("token_count") > policy.most)


def parents(chunk: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Chunks with parent_id and sibling_offsets: consecutive chunks share a parent of about policy.parent tokens."""
    order = Window.partitionBy("source_id").orderBy("chunk_index")
    p = F.floor((F.sum("token_count").over(order) - F.col("token_count")) / policy.parent).cast("int")
    out = chunk.withColumn("_p", p).withColumn("parent_id", F.concat_ws("::", "source_id", F.lit("parent"), F.col("_p").cast("string")))
    inside = Window.partitionBy("parent_id").orderBy("chunk_index")
    around = F.array_compact(F.array(F.when(F.lag("chunk_index").over(inside).isNotNull(), F.lit(-1)), F.when(F.lead("chunk_index").over(inside).isNotNull(), F.lit(1))))
    return out.withColumn("sibling_offsets", around).drop("_p")


def window_text(chunk: DataFrame, before: int = 1, after: int = 1) -> DataFrame:
    """Chunks with `window`: their text with that of the neighbours in the document."""
    w = Window.partitionBy("source_id").orderBy("chunk_index").rowsBetween(-before, after)
    return chunk.withColumn("window", F.array_join(F.collect_list("raw_text").over(w), "\n"))


def document_sizes(sections: DataFrame) -> DataFrame:
    """Per source: tokens in all, shortest and longest paragraph, deepest heading, which kinds of block it has."""
    t = token_estimate(F.col("content"))
    para = F.when(F.col("type") == "paragraph", t)
    has = lambda kind: F.coalesce(F.bool_or(F.col("type") == kind), F.lit(False))
    return sections.groupBy("source_id").agg(F.sum(t).alias("total_tokens"), F.min(para).alias("shortest"), F.max(para).alias("longest"), F.max("level").alias("max_heading_depth"), has("table").alias("has_tables"), has("code_block").alias("has_code"), has("list_item").alias("has_lists"))


def oversized(chunk: DataFrame, policy: Policy = Policy()) -> DataFrame:
    return chunk.where(F.col("token_count") > policy.most).select("source_id", "chunk_id", "token_count")


def chunk_problems(chunk: DataFrame, sources: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """chunk_id, source_id, rule: every broken rule of the chunk checklist that data can show."""
    twice = Window.partitionBy("chunk_id")
    order = Window.partitionBy("source_id").orderBy("chunk_index", "chunk_id")
    c = chunk.join(sources.select("source_id").distinct().withColumn("_known", F.lit(True)), "source_id", "left")
    c = c.withColumn("_n", F.count("*").over(twice)).withColumn("_i", F.row_number().over(order) - 1)
    fences = F.size(F.split("text", "```")) - 1
    rules = {
        "no_empty_chunks": strip(F.coalesce("text", F.lit(""))) == "",
        "all_have_required_fields": F.col("chunk_id").isNull() | F.col("source_id").isNull() | F.col("chunk_index").isNull() | F.col("token_count").isNull(),
        "source_id_matches_parsed": F.col("_known").isNull(),
        "no_split_code_fences": fences % 2 == 1,
        "within_model_token_limit": F.col("token_count") > policy.most,
        "heading_path_is_list": F.col("heading_path").isNull(),
        "chunk_id_unique": F.col("_n") > 1,
        "chunk_index_contiguous": F.col("chunk_index") != F.col("_i"),
        "token_count_accurate": F.col("token_count") != token_estimate(F.col("raw_text")),
    }
    return c.select("chunk_id", "source_id", F.explode(F.array_compact(F.array(*(F.when(v, F.lit(k)) for k, v in rules.items())))).alias("rule"))


def duplicate_chunks(chunk: DataFrame) -> DataFrame:
    """chunk_id, kept: of chunks with the same path and text the first stays; tables and paths keep them apart."""
    w = Window.partitionBy("heading_path", F.sha2("raw_text", 256)).orderBy("source_id", "chunk_index")
    return chunk.select("chunk_id", F.first("chunk_id").over(w).alias("kept"))
