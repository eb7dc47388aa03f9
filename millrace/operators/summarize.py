"""Document summaries: the coarse tier of retrieval."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import WS, strip, token_estimate

#: Characters of a summary and of an outline's paragraph, topics, budget in tokens.
SUMMARY, OUTLINE, TOPICS, BUDGET = 200, 400, 4, 100


def topics(text: Column) -> Column:
    """The first four different words of more than three characters."""
    words = F.split(F.regexp_replace(text, r"[,.|]", " "), rf"{WS}+")
    return F.slice(F.array_distinct(F.filter(words, lambda w: F.length(w) > 3)), 1, TOPICS)


def summaries(sections: DataFrame) -> DataFrame:
    """source_id, title (first heading, else the id), summary (start of the body text), topics, token_count."""
    body = F.when(F.col("type").isin("paragraph", "table", "list_item"), F.struct("block_id", "content"))
    got = sections.groupBy("source_id").agg(F.min(F.when(F.col("type") == "heading", F.struct("block_id", "content"))).alias("head"), F.array_join(F.transform(F.array_sort(F.collect_list(body)), lambda x: x["content"]), " ").alias("text"))
    got = got.select("source_id", F.coalesce("head.content", "source_id").alias("title"), F.substring("text", 1, SUMMARY).alias("summary"))
    return got.withColumn("topics", topics(F.col("summary"))).withColumn("token_count", token_estimate(F.col("summary")))


def outlines(sections: DataFrame) -> DataFrame:
    """source_id, outline: headings with their level's marks, paragraphs cut short."""
    line = F.when(F.col("type") == "heading", F.concat(F.repeat(F.lit("#"), F.coalesce("level", F.lit(1))), F.lit(" "), F.col("content"))).when(F.col("type") == "paragraph", F.substring("content", 1, OUTLINE))
    return sections.withColumn("line", line).groupBy("source_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("block_id", "line")))), lambda x: x["line"]), "\n").alias("outline"))


def summary_problems(summary: DataFrame, sources: DataFrame, budget: int = BUDGET) -> DataFrame:
    """source_id, rule: every broken rule of the summary checklist that data can show."""
    known = sources.select("source_id").distinct().withColumn("_known", F.lit(True))
    n = F.size("topics")
    rules = {"has_source_id": F.col("_known").isNull(), "has_title": strip(F.coalesce("title", F.lit(""))) == "", "summary_not_empty": strip(F.coalesce("summary", F.lit(""))) == "", "within_budget": F.col("token_count") > budget, "has_topics": (n < 2) | (n > 5)}
    return summary.join(known, "source_id", "left").select("source_id", F.explode(F.array_compact(F.array(*(F.when(v, F.lit(k)) for k, v in rules.items())))).alias("rule"))


def scan_cost(summary: DataFrame) -> DataFrame:
    """One row: documents, tokens of a scan over all summaries, mean tokens."""
    return summary.agg(F.count("*").alias("documents"), F.coalesce(F.sum("token_count"), F.lit(0)).cast("long").alias("scan_tokens"), F.avg("token_count").alias("mean_tokens"))
