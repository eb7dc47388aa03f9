"""Tags of chunks under one schema for the corpus."""

import re
import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"
#: Shares above which a dimension is reported.
UNKNOWN_SHARE, DOMINANT_SHARE, DOMINANT_WARN = 0.20, 0.90, 0.80
ENTITIES = 5
RECENT_MONTHS = 24


def apply_schema(tags: DataFrame, schema: dict[str, list[str]]) -> DataFrame:
    """Each dimension's value if the schema allows it, otherwise unknown."""
    return tags.withColumns({d: F.when(F.col(d).isin(values), F.col(d)).otherwise(F.lit(UNKNOWN)) for d, values in schema.items()})


def verbatim_entities(entities: Column, text: Column, most: int = ENTITIES) -> Column:
    """Entities that stand in the text as they are, the first `most`."""
    return F.slice(F.filter(entities, lambda e: F.contains(text, e)), 1, most)


def time_period(published: Column, asof: Column) -> Column:
    """current within two years of the given day, else legacy; unknown without a date."""
    return F.when(published.isNull(), UNKNOWN).when(F.months_between(asof, published) <= RECENT_MONTHS, "current").otherwise("legacy")


def distribution(tags: DataFrame, dimensions: list[str]) -> DataFrame:
    """dimension, value, n: one pass over the tags for all dimensions."""
    pairs = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dimensions))).alias("x")
    return tags.select(pairs).select("x.*").groupBy("dimension", "value").agg(F.count("*").alias("n"))


def dimension_stats(tags: DataFrame, dimensions: list[str]) -> DataFrame:
    """dimension, total, unknown_rate, dominant_value, dominant_share, flags."""
    d = distribution(tags, dimensions)
    s = d.groupBy("dimension").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("value") == UNKNOWN, F.col("n")).otherwise(0)).alias("unknown"), F.max(F.struct("n", "value")).alias("top"))
    s = s.select("dimension", "total", (F.col("unknown") / F.col("total")).alias("unknown_rate"), F.col("top.value").alias("dominant_value"), (F.col("top.n") / F.col("total")).alias("dominant_share"))
    flags = F.array_compact(F.array(F.when(F.col("unknown_rate") > UNKNOWN_SHARE, F.lit("unknown_overuse")), F.when(F.col("dominant_share") > DOMINANT_SHARE, F.lit("poor_discrimination")).when(F.col("dominant_share") > DOMINANT_WARN, F.lit("dominant_value"))))
    return s.withColumn("flags", flags)


def consistent_documents(tags: DataFrame, dimension: str) -> DataFrame:
    """source_id, values, consistent: whether all chunks of a document share a value."""
    n = F.count_distinct(dimension)
    return tags.groupBy("source_id").agg(n.alias("values"), (n == 1).alias("consistent"))


def mean_entities(tags: DataFrame) -> DataFrame:
    return tags.agg(F.avg(F.size("entities")).alias("avg_entities"))


def propagate(document_tags: DataFrame, chunks: DataFrame) -> DataFrame:
    """Tags of a document on each of its chunks."""
    return chunks.select("chunk_id", "source_id").join(document_tags, "source_id")


def orphan_tags(tags: DataFrame, chunks: DataFrame) -> DataFrame:
    return tags.join(chunks.select("chunk_id"), "chunk_id", "left_anti")


def _cut(df: DataFrame) -> DataFrame:
    """df written to the folder in spark.checkpoint.dir, without its lineage; a local session may do without the setting."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="millrace-"))
    return df.checkpoint()


def prune_descendants(matched: DataFrame, parents: DataFrame) -> DataFrame:
    """matched (item, node) without nodes that have a matched ancestor; parents (node, parent) is the hierarchy, of any depth.

    The closure is built by doubling: each step joins the ancestors found so far with themselves, until
    none is new. A hierarchy is small beside the data; its pairs stay on the executors.
    """
    closure = parents.where("parent IS NOT NULL").select("node", F.col("parent").alias("ancestor")).distinct()
    closure = _cut(closure)
    size, before = closure.count(), -1
    while size > before:
        further = closure.join(closure.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("far")), "ancestor").select("node", F.col("far").alias("ancestor"))
        closure = _cut(closure.union(further).distinct())
        before, size = size, closure.count()
    under = matched.join(closure, "node").select("item", "node", "ancestor").join(matched.select("item", F.col("node").alias("ancestor")), ["item", "ancestor"], "left_semi")
    return matched.join(under.select("item", "node").distinct(), ["item", "node"], "left_anti")


def proposals(tags: DataFrame, raw: DataFrame, schema: dict[str, list[str]]) -> DataFrame:
    """dimension, value, affected_chunks: values that the schema lacks, with how often they were wanted."""
    wanted = [F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in schema]
    allowed = F.create_map(*(x for d, v in schema.items() for x in (F.lit(d), F.array(*map(F.lit, v)))))
    pairs = raw.join(tags.select("chunk_id"), "chunk_id", "left_semi").select(F.explode(F.array(*wanted)).alias("x")).select("x.*").where("value IS NOT NULL")
    return pairs.where(~F.array_contains(F.element_at(allowed, F.col("dimension")), F.col("value"))).groupBy("dimension", "value").agg(F.count("*").alias("affected_chunks"))


def tag_problems(tags: DataFrame, chunks: DataFrame, schema: dict[str, list[str]], required: list[str]) -> DataFrame:
    """chunk_id, rule: broken rules of single tag rows; shares by dimension are in dimension_stats()."""
    t = tags.join(chunks.select("chunk_id", F.col("text").alias("_text")), "chunk_id", "left")
    rules = {f"missing_{d}": F.col(d).isNull() for d in required}
    rules |= {f"invalid_{d}": ~F.coalesce(F.col(d), F.lit(UNKNOWN)).isin([*v, UNKNOWN]) for d, v in schema.items()}
    rules |= {"unknown_chunk": F.col("_text").isNull(), "entities_not_in_text": F.exists("entities", lambda e: ~F.contains("_text", e)), "too_many_entities": F.size("entities") > ENTITIES}
    return t.select("chunk_id", F.explode(F.array_compact(F.array(*(F.when(v, F.lit(k)) for k, v in rules.items())))).alias("rule"))
