"""The quality verdict of a document, with stated reasons."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import percent, strip
from millrace.schema import TYPES, VERDICTS

#: Least characters a page in documents of several pages, largest share that cleaning may remove.
CHARS_PER_PAGE = 25
REMOVED = 0.5


def verdicts(documents: DataFrame, sections: DataFrame) -> DataFrame:
    """documents (source_id and, where known, page_count, is_scanned, warnings, blocks_before, blocks_removed) with verdict and verdict_reasons.

    The first rule that holds decides: nothing extracted, too little text for the pages, then whatever
    makes it degraded. Lengths alone are read from sections. Where only blocks_before is given, the
    sections that are left tell how many cleaning removed.
    """
    kinds = {"page_count": "int", "is_scanned": "boolean", "warnings": "array<string>", "blocks_before": "long", "blocks_removed": "long"}
    docs = documents.select(*documents.columns, *(F.lit(None).cast(k).alias(c) for c, k in kinds.items() if c not in documents.columns))
    sizes = sections.groupBy("source_id").agg(F.count("*").alias("n_sections"), F.sum(F.length("content")).alias("total_chars"))
    docs = docs.join(sizes, "source_id", "left").withColumns({"n_sections": F.coalesce("n_sections", F.lit(0)), "total_chars": F.coalesce("total_chars", F.lit(0))})
    if "blocks_before" in documents.columns and "blocks_removed" not in documents.columns:
        docs = docs.withColumn("blocks_removed", F.col("blocks_before") - F.col("n_sections"))
    per_page = F.col("total_chars") / F.col("page_count")
    empty = F.col("n_sections") == 0
    sparse = (F.col("page_count") > 1) & (per_page < CHARS_PER_PAGE)
    share = F.when(F.col("blocks_before") > 0, F.col("blocks_removed") / F.col("blocks_before"))
    soft = F.concat(
        F.coalesce("warnings", F.array().cast("array<string>")),
        F.array_compact(
            F.array(
                F.when(F.col("is_scanned"), F.lit("text was recovered by OCR — verify accuracy on a sample")),
                F.when(share > REMOVED, F.concat(F.lit("cleaning removed "), percent(share), F.lit(" of blocks — check the source is not mostly boilerplate the pipeline misread as content"))),
            )
        ),
    )
    few = F.concat(F.lit("only "), F.bround(per_page, 0).cast("long").cast("string"), F.lit(" chars/page across "), F.col("page_count").cast("string"), F.lit(" pages — likely a scanned document; install an OCR engine (pip install paddleocr) and re-run with --strategy ocr"))
    reasons = F.when(empty, F.array(F.lit("no sections extracted"))).when(sparse, F.array(few)).otherwise(soft)
    verdict = F.when(empty | sparse, "unusable").when(F.size("_soft") > 0, "degraded").otherwise("ok")
    return docs.withColumn("_soft", soft).withColumns({"verdict": verdict, "verdict_reasons": reasons}).drop("_soft", *(c for c in kinds if c not in documents.columns))


def violations(documents: DataFrame, sections: DataFrame) -> DataFrame:
    """source_id, problem: every breach of the output contract, one row each; healthy documents have none."""
    bad = F.array_compact(
        F.array(
            F.when(F.coalesce("source_id", F.lit("")) == "", F.lit("source_id is empty")),
            F.when(F.coalesce("format_type", F.lit("")).isin("", "unknown"), F.lit("format_type was not set by the parser")),
            F.when(~F.coalesce("verdict", F.lit("")).isin(VERDICTS), F.concat(F.lit("unknown verdict '"), F.coalesce("verdict", F.lit("")), F.lit("'"))),
        )
    )
    of_docs = documents.select("source_id", F.explode(bad).alias("problem"))
    rows = sections.withColumn("_i", F.row_number().over(Window.partitionBy("source_id").orderBy("block_id")) - 1)
    i = F.col("_i").cast("string")
    wrong = F.array_compact(
        F.array(
            F.when(F.col("block_id") != F.col("_i"), F.concat(F.lit("section["), i, F.lit("].block_id is "), F.col("block_id").cast("string"), F.lit(", expected "), i)),
            F.when(~F.col("type").isin(TYPES), F.concat(F.lit("section["), i, F.lit("] has unknown type '"), F.col("type"), F.lit("'"))),
            F.when((F.col("type") != "heading") & (strip(F.col("content")) == ""), F.concat(F.lit("section["), i, F.lit("] ("), F.col("type"), F.lit(") has empty content"))),
        )
    )
    return of_docs.unionByName(rows.select("source_id", F.explode(wrong).alias("problem")))


def gate(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deliverable documents, and blocked ones (verdict unusable)."""
    blocked = F.col("verdict") == "unusable"
    return documents.where(~blocked), documents.where(blocked)
