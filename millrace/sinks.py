"""Writers: nested documents as JSON, and JSON-line tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nested(documents: DataFrame, sections: DataFrame) -> DataFrame:
    """One row per document with its sections inside, in order: the contract that other tools read."""
    fields = [c for c in sections.columns if c != "source_id"]
    inside = sections.groupBy("source_id").agg(F.collect_list(F.struct(*fields)).alias("x"))
    by_id = F.array_sort("x", lambda a, b: a["block_id"] - b["block_id"])
    return documents.join(inside.select("source_id", by_id.alias("sections")), "source_id", "left").withColumn("sections", F.coalesce("sections", F.array().cast(inside.schema["x"].dataType)))


def as_json(documents: DataFrame) -> DataFrame:
    """source_id, value: one JSON object per document."""
    return documents.select("source_id", F.to_json(F.struct(*documents.columns)).alias("value"))


def write_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line, in as many files as there are partitions."""
    df.write.mode("overwrite").json(path)


def write_runs(documents: DataFrame, path: str) -> None:
    """A folder per document."""
    documents.write.mode("overwrite").partitionBy("source_id").json(path)


def envelope(documents: DataFrame) -> DataFrame:
    """value: {"documents": [...]} for a handful of documents; a corpus is written as lines."""
    return documents.agg(F.to_json(F.struct(F.sort_array(F.collect_list(F.struct("source_id", *(c for c in documents.columns if c != "source_id")))).alias("documents"))).alias("value"))


def summary(documents: DataFrame, failures: DataFrame) -> DataFrame:
    """One row: total, succeeded, failed, failures."""
    ok = documents.agg(F.count("*").alias("succeeded")).withColumn("_k", F.lit(1))
    bad = failures.agg(F.count("*").alias("failed"), F.sort_array(F.collect_list(F.struct("source", "error", "kind"))).alias("failures")).withColumn("_k", F.lit(1))
    return ok.join(bad, "_k").select((F.col("succeeded") + F.col("failed")).alias("total"), "succeeded", "failed", "failures")
