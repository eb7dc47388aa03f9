"""Catalogue, review queue, verification and reports: how the two tiers are tied together."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def catalog(documents: DataFrame, summaries: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row per deliverable document: summary, status (its verdict, ok where unknown), chunk_count, token_count."""
    n = chunks.groupBy("source_id").agg(F.count("*").alias("chunk_count"))
    status = documents.select("source_id", F.col("verdict").alias("status")).where("status != 'unusable' OR status IS NULL")
    out = summaries.join(status, "source_id").join(n, "source_id", "left")
    return out.select("source_id", "title", "summary", "topics", F.coalesce("status", F.lit("ok")).alias("status"), F.coalesce("chunk_count", F.lit(0)).cast("long").alias("chunk_count"), "token_count")


def review_queue(documents: DataFrame, verified: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """source_id, reason, reasons: documents that are unusable or whose artefacts are incomplete, and sources that failed."""
    blocked = documents.where("verdict = 'unusable'").select("source_id", F.lit("unusable").alias("reason"), F.col("verdict_reasons").alias("reasons"))
    partial = verified.where("NOT complete").select("source_id", F.lit("incomplete").alias("reason"), F.col("problems").alias("reasons"))
    out = blocked.unionByName(partial)
    if failures is not None:
        out = out.unionByName(failures.select(F.col("source").alias("source_id"), F.lit("failed").alias("reason"), F.array("error").alias("reasons")))
    return out


def verify(documents: DataFrame, chunks: DataFrame, summaries: DataFrame) -> DataFrame:
    """source_id, chunks_ok, summary_ok, problems, complete of each deliverable document, from the artefacts themselves."""
    c = chunks.groupBy("source_id").agg(F.count_if((F.coalesce("chunk_id", F.lit("")) == "") | (F.coalesce("text", F.lit("")) == "")).alias("bad"))
    s = summaries.select("source_id", (F.coalesce("summary", F.lit("")) != "").alias("said"))
    d = documents.where("verdict != 'unusable'").select("source_id").join(c, "source_id", "left").join(s, "source_id", "left")
    d = d.select("source_id", (F.coalesce("bad", F.lit(-1)) == 0).alias("chunks_ok"), F.coalesce("said", F.lit(False)).alias("summary_ok"), F.col("bad").isNull().alias("_none"), F.col("said").isNull().alias("_unsaid"))
    problems = F.array_compact(F.array(F.when(F.col("_none"), F.lit("no chunks")).when(~F.col("chunks_ok"), F.lit("chunks with missing fields")), F.when(F.col("_unsaid"), F.lit("no summary")).when(~F.col("summary_ok"), F.lit("empty summary"))))
    return d.withColumn("problems", problems).withColumn("complete", F.col("chunks_ok") & F.col("summary_ok")).drop("_none", "_unsaid")


def reconcile(deliverable: DataFrame, verified: DataFrame, replies: DataFrame) -> DataFrame:
    """source_id, complete, state: verified facts where there are any, a worker's reply (source_id, ok) otherwise."""
    v = verified.select("source_id", F.col("complete").alias("_v"))
    r = replies.select("source_id", F.col("ok").alias("_r"))
    out = deliverable.select("source_id").join(v, "source_id", "left").join(r, "source_id", "left")
    return out.select("source_id", F.coalesce("_v", "_r", F.lit(False)).alias("complete"), F.when(F.col("_v").isNotNull(), "verified").otherwise("unverified").alias("state"))


def unreachable(catalog_: DataFrame, chunks: DataFrame) -> DataFrame:
    """Catalogued documents without chunks."""
    return catalog_.join(chunks, "source_id", "left_anti").select("source_id")


def invisible(catalog_: DataFrame, chunks: DataFrame) -> DataFrame:
    """Documents with chunks that the catalogue lacks."""
    return chunks.select("source_id").distinct().join(catalog_, "source_id", "left_anti")


def in_both(catalog_: DataFrame, queue: DataFrame) -> DataFrame:
    """Documents in the catalogue and in the review queue; must be empty."""
    return catalog_.join(queue, "source_id", "left_semi").select("source_id")


def run_report(documents: DataFrame, verified: DataFrame, failures: DataFrame) -> DataFrame:
    """One row of counts over a run."""
    d = documents.agg(F.count("*").alias("selected"), F.count_if(F.col("verdict") != "unusable").alias("deliverable"), F.count_if(F.col("verdict") == "unusable").alias("blocked"))
    v = verified.agg(F.count_if("complete").alias("verified_complete"), F.count_if(~F.col("complete")).alias("incomplete"))
    f = failures.agg(F.count("*").alias("failed"))
    one = lambda x: x.withColumn("_k", F.lit(1))  # noqa: E731  single rows
    out = one(d).join(one(v), "_k").join(one(f), "_k").drop("_k")
    return out.withColumn("found", F.col("selected") + F.col("failed"))


def languages(summaries: DataFrame) -> DataFrame:
    """One row: the summaries' languages in order, and whether there is more than one."""
    found = F.array_sort(F.collect_set("language"))
    return summaries.agg(found.alias("languages"), (F.size(found) > 1).alias("mixed"))


def already_present(incoming: DataFrame, known: DataFrame) -> DataFrame:
    """incoming (source, content) with state: present (same path and content), changed, new."""
    h = incoming.withColumn("hash", F.sha2("content", 256))
    k = known.select(F.col("source").alias("_s"), F.col("hash").alias("_h"))
    out = h.join(k, F.col("source") == F.col("_s"), "left")
    return out.select("source", "hash", F.when(F.col("_s").isNull(), "new").when(F.col("_h") == F.col("hash"), "present").otherwise("changed").alias("state"))


def pending(documents: DataFrame, manifest: DataFrame, stages: list[str]) -> DataFrame:
    """source_id, stage: the first stage of each document (source_id, hash) that the manifest doesn't show done for its content."""
    order = documents.select("source_id", "hash", F.posexplode(F.array(*map(F.lit, stages))).alias("_n", "stage"))
    todo = order.join(manifest.where("status = 'done'").select("source_id", "stage", "hash"), ["source_id", "stage", "hash"], "left_anti")
    return todo.groupBy("source_id").agg(F.min(F.struct("_n", "stage")).alias("x")).select("source_id", F.col("x.stage").alias("stage"))
