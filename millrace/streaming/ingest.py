"""Incremental ingestion: new files as a stream, changed ones by their times, a whole file at a time.

A batch ends with its rows in the log: one for each source, with the time of the file that it read. The log
says which state of a source holds, also if that state has no chunks or is unusable.
"""

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.plans.corpus import Policy, build, parse
from millrace.sources import formats

TABLES = ("catalog", "chunks", "review_queue")
BINARY = "path string, modificationTime timestamp, length long, content binary"


def file_stream(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """source, content, modified of the files that arrive under a path."""
    found = spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", str(recursive).lower()).load(path)
    return found.select(F.col("path").alias("source"), "content", F.col("modificationTime").alias("modified"))


def latest(rows: DataFrame) -> DataFrame:
    """The newest state of each source in a batch."""
    newest = Window.partitionBy("source").orderBy(F.desc("modified"), F.sha2("content", 256))
    return rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def _write(rows: DataFrame, out: str, batch: str, policy: Policy) -> DataFrame:
    """Parse rows (source, content, modified) into the folders of a batch, the log last; returns the catalogue."""
    spark = rows.sparkSession
    files = latest(rows)
    corpus = build(parse(files.select("source", "content")), policy)
    for name in TABLES:
        getattr(corpus, name).write.mode("overwrite").parquet(f"{out}/{name}/batch={batch}")
    corpus.sections.unpersist()
    corpus.documents.unpersist()
    formats.identify(files.select("source", "modified")).select("source_id", "source", "modified").write.mode("overwrite").parquet(f"{out}/log/batch={batch}")
    return spark.read.parquet(f"{out}/catalog/batch={batch}")


def ingest(spark: SparkSession, path: str, out: str, checkpoint: str, policy: Policy = Policy(), then: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Parse what arrives and write catalogue rows, chunks and review queue, a folder for each batch.

    A batch that is run again overwrites its own folder, so results stay exactly once. The stream
    remembers paths: a file that is written anew under its own path is for refresh().
    """

    def batch(rows: DataFrame, n: int) -> None:
        written = _write(rows, out, f"s{n}", policy)
        if then:
            then(written, n)

    return file_stream(spark, path).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def refresh(spark: SparkSession, path: str, out: str, policy: Policy = Policy(), recursive: bool = True) -> bool:
    """Parse anew the files under a path that are younger than what the log has of them; whether there were any.

    Only files from the first change on are opened: their time is a filter of the scan. Files that the
    stream hasn't taken yet are left to it. A run that breaks off leaves no log rows, and the next one does its work.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    held = log(spark, out).groupBy(F.col("source").alias("path")).agg(F.max("modified").alias("held"))
    first = files.select("path", "modificationTime").join(held, "path").where(F.col("modificationTime") > F.col("held")).agg(F.min("modificationTime")).first()[0]
    if first is None:
        return False
    changed = files.where(F.col("modificationTime") >= F.lit(first)).join(held, "path").where(F.col("modificationTime") > F.col("held"))
    _write(changed.select(F.col("path").alias("source"), "content", F.col("modificationTime").alias("modified")), out, f"r{uuid4().hex}", policy)
    return True


def log(spark: SparkSession, out: str) -> DataFrame:
    """source_id, source, modified, batch: what every finished batch has read."""
    return spark.read.parquet(f"{out}/log")


def current(spark: SparkSession, out: str, table: str) -> DataFrame:
    """Rows of each source's newest state; none if that state yields none. Batches without log rows don't count.

    Two batches that read the same state of a file hold the same rows: one of them counts.
    """
    last = log(spark, out).groupBy("source").agg(F.max_by(F.struct("source_id", "batch"), F.struct("modified", "batch")).alias("x"))
    keys = last.select(F.explode(F.array_distinct(F.array("x.source_id", "source"))).alias("source_id"), "x.batch")  # failures carry the path itself
    return spark.read.parquet(f"{out}/{table}").join(keys, ["source_id", "batch"], "left_semi").drop("batch")
