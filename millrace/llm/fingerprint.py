"""Canonical exact digests of documents.

A text is normalised (NFKC, case folding, NFKC again, white space runs to one space, trimmed) and
hashed to 128 bits with xxh3. Rows of one digest form a bucket; inside buckets of several rows the
canonical bytes are compared, so a hash collision never merges two different texts.
"""

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import Bloom, Steps, sent, small_batches, table, texts


def canonical(text: str) -> bytes:
    """The bytes that two texts share if they count as equal."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    else:
        text = text.lower()
    return " ".join(text.split()).encode()


def digest(canon: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(canon)


def _keys(hexes: list[str]) -> np.ndarray:
    return np.array([int(h[:16], 16) for h in hexes], np.uint64).view(np.int64)


def buckets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per different canonical text that shares its digest with another row: digest, canon,
    n_rows, first_id (smallest id) and nth (0 for the smallest canonical text of the digest).

    Only rows of digests that occur twice move: a Bloom filter of bounded size tells them, and each
    task sends a text once however many copies it has. Null texts count as empty.
    """

    small_batches(docs.sparkSession)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (rows,) in texts(batches, "text"):
            yield pa.record_batch({"digest": [digest(canonical(t or "")) for t in rows]})

    one = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    keys = one.select("text").mapInArrow(digests, "digest string")
    twice = keys.groupBy("digest").count().where("count > 1").select(F.conv(F.substring("digest", 1, 16), 16, -10).cast("long").alias("k"))
    steps = Steps(docs.sparkSession)
    twice = steps.put(twice, "fingerprint-twice")
    members = sent(docs.sparkSession, Bloom.of(twice, "k"))
    steps.drop(twice)

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = members()
        for ids, rows in texts(batches, "id", "text"):
            canon = [canonical(t or "") for t in rows]
            hexes = [digest(c) for c in canon]
            at = np.flatnonzero(known.has(_keys(hexes))) if hexes else []
            yield pa.record_batch({"id": pa.array([ids[i] for i in at], pa.int64()), "digest": pa.array([hexes[i] for i in at], pa.string()), "canon": pa.array([canon[i] for i in at], pa.binary())})

    compared = one.mapInArrow(bytes_of, "id long, digest string, canon binary").groupBy("digest", "canon").agg(F.count("*").alias("n_rows"), F.min("id").alias("first_id"))
    return compared.withColumn("nth", F.row_number().over(Window.partitionBy("digest").orderBy("canon")) - 1)


def collisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[bytes, str]:
    """Fingerprints of canonical texts whose digest another text has too: all but the first get a suffix.

    There are 2^128 digests, so this is empty but for crafted texts; each entry is one such text.
    """
    found = buckets(docs, id_col, text_col).where("nth > 0").select("digest", "canon", "nth").toArrow().to_pylist()
    return {r["canon"]: f"{r['digest']}-{r['nth']}" for r in found}


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with a string column `fingerprint`, equal exactly for equal canonical texts."""
    special = collisions(docs, id_col, text_col)

    def mark(rows: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in rows:
            canon = [canonical(t or "") for t in part.to_pylist()]
            yield pa.array([special.get(c) or digest(c) for c in canon], pa.string())

    return docs.withColumn("fingerprint", F.arrow_udf(mark, "string")(F.col(text_col)))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows in blocks by descending id, so that each row's next one follows it in its partition.

    Columns: block, guest, id, tie, z (the text, compressed). The text moves once. The first row of
    a block also goes, as a guest, to the end of the block before it; that of the first block to
    the end of the last. Bounds are quantiles of the ids: their number follows the partitions, not
    the rows. Rows without an id come last; rows of one id are in the order of their text's hash.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = -(1 << 63)
    one = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(low)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = 4 * parts
    cuts = one.select(F.percentile_approx("id", [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    bounds = np.array(sorted(set(cuts)), np.int64)

    def block_of(ids: np.ndarray) -> np.ndarray:
        return len(bounds) - np.searchsorted(bounds, ids, "left")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            yield pa.record_batch({"id": batch.column(0), "block": pa.array(block_of(ids), pa.int32())})

    tops = sorted(map(tuple, one.select("id").mapInArrow(blocks, "id long, block int").groupBy("block").agg(F.max("id")).collect()))
    guest_in = {top: tops[i - 1][0] for i, (_, top) in enumerate(tops)}  # of the first: the last block

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(1).compress
        for ids, rows in texts(batches, "id", "text"):
            block = block_of(np.array(ids, np.int64)).tolist()
            data = [t.encode() for t in rows]
            tie = [xxhash.xxh3_64_intdigest(d) - (1 << 63) for d in data]
            z = [squeeze(d) for d in data]
            own = list(zip(block, [False] * len(ids), ids, tie, z, strict=True))
            own += [(guest_in[i], True, i, t, c) for i, t, c in zip(ids, tie, z, strict=True) if i in guest_in]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*own), (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()))] if own else [[]] * 5, ["block", "guest", "id", "tie", "z"])

    dealt = one.mapInArrow(deal, "block int, guest boolean, id long, tie long, z binary")
    return dealt.repartition(parts, "block").sortWithinPartitions("block", "guest", F.desc("id"), "tie")


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by the start of the document that follows."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text; likeness is 1 for equal canonical bytes, else 0."""
    docs = table(spark, sf_dir, "documents")
    special = collisions(docs)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        expand = zstandard.ZstdDecompressor().decompress
        last = None
        for blocks, guests, ids, zs in texts(batches, "block", "guest", "id", "z"):
            for block, guest, i, z in zip(blocks, guests, ids, zs, strict=True):
                if last is None and guest:
                    continue
                text = expand(z).decode()
                canon = canonical(text)
                if last is not None:
                    yield (*last[1:], text, canon)
                last = None if guest else (block, i, text, canon)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        out = []
        for i, text, canon, following, next_canon in pairs(batches):
            new = edited(text, following)
            new_canon = canonical(new)
            print_, new_print = (special.get(c) or digest(c) for c in (canon, new_canon))
            out.append((None if i == -(1 << 63) else i, len(text), hashlib.sha256(new.encode()).hexdigest(), print_, new_print, float(canon == new_canon), float(canon == next_canon)))
            if len(out) == 4096:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out = []
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return with_next(docs).mapInArrow(rows, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
