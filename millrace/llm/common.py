"""Helpers that the training-data operators share."""

import ctypes
import re
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of the contract's alphanumeric words, once A-Z are lower-cased.
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Maps a UTF-8 byte to what the same words need: A-Z lower-cased, separators to spaces.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_table(spark: SparkSession, columns: list[pa.Array], names: list[str]) -> DataFrame:
    """A table of rows that the driver holds. From Arrow it is part of the plan; from a list executors would start
    Python workers of another kind to convert it, whose daemon then stays beside the one that all operators use."""
    return spark.createDataFrame(pa.table(columns, names))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share: spark.checkpoint.dir, or what setCheckpointDir() was given.

    A local session may do without: its tasks and the driver are one process, which gets a folder of
    its own. Anywhere else a missing setting is an error, as files of one machine are lost to the others.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = held.get() if held.isDefined() else None
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='millrace-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: Folders that stored() has written in this process, oldest first.
WRITTEN: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: lineage is cut and nothing is computed twice.

    Executors may be lost after that: the files stay. They remain until remove() or the cluster's
    own clearing of the folder, since a lazy result may still need them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of stored() that nothing reads any more."""
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        WRITTEN.remove(p)


class Steps:
    """The stored tables of one run of an operator, each deleted as soon as no later step reads it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.held: list[tuple[DataFrame, str]] = []

    def put(self, df: DataFrame, name: str) -> DataFrame:
        out = stored(df, name)
        self.held.append((out, WRITTEN[-1]))
        return out

    def drop(self, *frames: DataFrame) -> None:
        remove(self.spark, [path for frame, path in self.held if any(frame is f for f in frames)])
        self.held = [(frame, path) for frame, path in self.held if not any(frame is f for f in frames)]

    def drop_all_but(self, *frames: DataFrame) -> None:
        self.drop(*(frame for frame, _ in self.held if not any(frame is f for f in frames)))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; a text of ASCII only takes the faster built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The contract's alphanumeric words of a text, in order; null has none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def texts(batches: Iterator[pa.RecordBatch], *names: str, keep: bool = False) -> Iterator[tuple]:
    """Columns of each Arrow batch as Python lists, 512 rows at a time. What per_process() holds goes first, unless the task keeps it."""
    if not keep:
        let_go()
    give_back()
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            yield tuple(part.column(part.schema.get_field_index(n)).to_pylist() for n in names)
    give_back()


def give_back() -> None:
    """Return to the system what this process has freed: workers live on between tasks, and allocators keep freed memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


class Bloom:
    """A set of 64-bit hashes in an array of bits. It may let strangers pass, never stops a member.

    It only spares work: what passes is still joined exactly, so a full filter costs time, not results.
    It has sixteen bits or more for each key counted, from LEAST up to MOST bits (32 MB): that bounds what is
    collected and broadcast. From some 16 million keys on more and more strangers pass.
    """

    LEAST, MOST = 1 << 22, 1 << 28

    def __init__(self, words: np.ndarray):
        self.words = words
        self.bits = len(words) << 6

    @classmethod
    def of(cls, df: DataFrame, name: str) -> "Bloom":
        """A filter of a stored table's column."""
        return cls.several(df.select(name, F.lit(0).alias("rank")), name, 1)[0]

    @classmethod
    def several(cls, df: DataFrame, name: str, n: int) -> list["Bloom"]:
        """One filter for each rank of 0 to n - 1 (column `rank`) of a stored table, each of its own size."""
        keys = dict(df.groupBy("rank").count().collect())
        sizes = [min(cls.MOST, max(cls.LEAST, 1 << (16 * keys.get(k, 0)).bit_length())) for k in range(n)]
        bits = F.element_at(F.array(*(F.lit(x).cast("long") for x in sizes)), F.col("rank") + 1) - 1
        places = F.array(*(F.shiftrightunsigned(F.col(name), s).bitwiseAND(bits) for s in (0, 32)))
        found = df.select("rank", F.explode(places).alias("p")).groupBy("rank", F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(p & 63L AS INT))")).alias("b")).toArrow()
        out = [cls(np.zeros(x >> 6, np.uint64)) for x in sizes]
        for part in found.to_batches():
            ranks, at, values = (part.column(c).to_numpy() for c in ("rank", "w", "b"))
            for k in np.unique(ranks).tolist():
                out[k].words[at[ranks == k]] = values[ranks == k].view(np.uint64)
        return out

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether each of the hashes (any 64-bit type) may be a member."""
        keys = keys.view(np.uint64)
        out = np.ones(len(keys), bool)
        for s in (0, 32):
            at = (keys >> np.uint64(s)) & np.uint64(self.bits - 1)
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def per_process(key: str, make: Callable[[], Any]) -> Any:
    """What make() returned when a Python worker first asked for this key; later tasks of the worker get the same.

    A worker holds one such value: the next key takes its place, and tasks that use none call let_go(), so no
    operator's state outlives the next one's start.
    """
    held = sys.modules.setdefault("millrace_worker_state", types.ModuleType("millrace_worker_state")).__dict__
    if held.get("key") != key:
        held.pop("value", None)
        held["value"] = make()
        held["key"] = key
    return held["value"]


def let_go() -> None:
    """Drop what per_process() holds in this worker."""
    if held := sys.modules.get("millrace_worker_state"):
        held.__dict__.pop("key", None)
        held.__dict__.pop("value", None)


def sent(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a value of bounded size; tasks call the result to get it.

    A worker unpickles it once and drops it with the first task that doesn't use it.
    """
    held = spark.sparkContext.broadcast(value)
    return lambda: held.value


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of texts go to Python workers in pieces of 4 MB instead of Spark's 64 MB, unless the session says otherwise."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b":
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def free_name(df: DataFrame, name: str) -> str:
    """A name for a new column of df: `name`, with underscores behind it as long as df has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pieces(rows: list[str], chars: int = 1 << 20, most: int = 512) -> Iterator[list[str]]:
    """rows in order, a bounded number of characters and rows at a time; a longer text comes alone."""
    start = size = 0
    for k, t in enumerate(rows):
        if k > start and (size + len(t) > chars or k - start >= most):
            yield rows[start:k]
            start, size = k, 0
        size += len(t)
    if rows:
        yield rows[start:]
