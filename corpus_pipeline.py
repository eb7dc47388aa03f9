"""The corpus pipeline: five of the training-data operators, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents. Null and empty
texts pass every stage: they are not toxic, lose no line, are like nothing and hold no benchmark.
Texts of any length are taken whole. Repeated rows of one id share every decision; equal texts and
ties go to the smaller id. Empty tables give empty results. Further columns, whatever their names,
are kept up to the last stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import WRITTEN, free_name, remove, stored, table
from millrace.llm.decontaminate import decontaminate
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.near_duplicates import drop_near_duplicates
from millrace.llm.sentencepiece_codec import encode_texts
from millrace.llm.toxicity import REJECT, fit, score_toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches REJECT go."""
    model, name = fit(docs, table(spark, sf_dir, "labels")), free_name(docs, "toxicity")
    return score_toxicity(docs, model).where(F.col(name)["score"] < REJECT).drop(name)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier go; so do documents that had words and lost every line with words."""
    got = dedup_lines(docs)
    lines = F.col(free_name(docs, "lines"))
    empty = (lines["n_lines"] > 0) & (lines["n_exact"] + lines["n_near"] == lines["n_lines"])
    changed = lines["n_exact"] + lines["n_near"] > 0
    new = {"text": lines["kept"], "n_chars": F.when(changed, F.length(lines["kept"]).cast("long")).otherwise(F.col("n_chars"))}
    return got.where(~empty).select(*(new.get(c, F.col(c)).alias(c) for c in docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id stays."""
    return drop_near_duplicates(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule marks go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What training reads: the token ids of each text, which decode to it again."""
    return encode_texts(docs).select("doc_id", "lang", "source", "n_chars", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("SentencePiece encoding and decoding", token_stage),
]

#: Nearest-neighbour votes and subword merges have no SQL form: tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's working files go once its output is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for n, (_, stage) in enumerate(STAGES):
        made = len(WRITTEN)
        out = stored(stage(spark, docs, sf_dir), f"stage{n}")
        done = WRITTEN[-1]
        remove(spark, [p for p in [*WRITTEN[made:-1], before] if p])
        docs, before = out, done
    return docs
