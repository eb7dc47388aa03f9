"""Keyword retrieval over both tiers.

Questions are few and entries many: the different terms of all questions travel to the entries, each
entry's words say which terms it contains, and these give it its scores where it lies. A score counts
the terms of a question that an entry's text contains.
"""

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from millrace.functions.text import WS

#: Fixed value: words longer than this are terms, measured before punctuation goes.
TERM_LENGTH = 4
#: Terms of a block, and the bytes of all questions' terms that may be broadcast.
BLOCK, MAX_BROADCAST = 4096, 8 << 20
#: Bytes of a term's beginning; words that a task remembers, and how long they are at most; scores held at once.
BEGIN, REMEMBERED, LONGEST, PLACES = 4, 200_000, 64, 1 << 20


def terms(question: Column, longer_than: int = TERM_LENGTH) -> Column:
    """Distinct lower-case terms of a question without ?., around them."""
    words = F.filter(F.split(question, rf"{WS}+"), lambda w: F.length(w) > longer_than)
    return F.array_distinct(F.transform(words, lambda w: F.regexp_replace(F.lower(w), r"\A[?.,]+|[?.,]+\z", "")))


class Terms:
    """Finds which of many terms a text contains: terms hold no white space, so each lies inside one word of the text.

    Words are looked up, new ones are searched by the terms' beginnings: a text costs its own length, however many terms there are.
    """

    def __init__(self, terms: list[bytes]):
        self.short = [(t, n) for n, t in enumerate(terms) if len(t) < BEGIN]
        self.number = {t: n for n, t in enumerate(terms) if len(t) >= BEGIN}
        self.sizes: dict[bytes, set[int]] = {}
        for t in self.number:
            self.sizes.setdefault(t[:BEGIN], set()).add(len(t))
        self.seen: dict[bytes, tuple[int, ...]] = {}

    def _inside(self, word: bytes) -> tuple[int, ...]:
        found = {n for t, n in self.short if t in word}
        for at in range(len(word) - BEGIN + 1):
            for size in self.sizes.get(word[at : at + BEGIN], ()):
                if (n := self.number.get(word[at : at + size])) is not None:
                    found.add(n)
        return tuple(found)

    def held(self, text: bytes) -> list[int]:
        """Numbers of the terms in a text, each once."""
        found = {n for t, n in self.short if not t}
        for word in set(text.split()):
            got = self.seen.get(word)
            if got is None:
                got = self._inside(word)
                if len(word) <= LONGEST:
                    if len(self.seen) >= REMEMBERED:
                        self.seen.clear()
                    self.seen[word] = got
            if got:
                found.update(got)
        return list(found)


def _pairs(held: list[list[int]], start: np.ndarray, asked: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, question, score) of rows that hold terms, a bounded number of scores at a time."""
    every = np.diff(start)
    group = np.cumsum([n + every[x].sum() for x in held]) // PLACES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(held)]
    for at, end in zip(cuts[:-1], cuts[1:]):
        some = held[at:end]
        term = np.fromiter(chain.from_iterable(some), np.int64)
        row = np.repeat(np.arange(len(some)), [len(x) for x in some])
        sizes = every[term]
        where = np.arange(sizes.sum()) + np.repeat(start[term] - np.cumsum(sizes) + sizes, sizes)
        score = np.bincount(np.repeat(row * n, sizes) + asked[where])
        place = np.flatnonzero(score)
        yield place // n + at, place % n, score[place]


def _best(rows: pa.Table, k: int) -> pa.Table:
    """The k best rows of each question, in order."""
    rows = rows.take(pc.sort_indices(rows, [("q", "ascending"), ("score", "descending"), ("key", "ascending")], null_placement="at_start"))
    q = rows.column("q").to_numpy()
    return rows.filter(pa.array(np.arange(len(q)) - np.searchsorted(q, q) < k))


def scored(questions: DataFrame, entries: DataFrame, key: str, text: Column, longer_than: int = TERM_LENGTH, k: int | None = None) -> DataFrame:
    """questions (question_id, question) x entries -> question_id, key, score of the entries that contain a term.

    Keys of entries are unique. Work grows with the entries' text and the scores made, not with the number of
    questions or terms; an entry that contains no term makes no row. Given k, each task leaves out what can't
    be among a question's k best by score, then key: ranked() with the same k finds those.
    """
    q = questions.select("question_id", F.explode(terms(F.col("question"), longer_than)).alias("term"))
    size = q.agg(F.coalesce(F.sum(F.octet_length("term") + 16), F.lit(0))).first()[0]
    e = entries.select(F.col(key), F.lower(text).alias("_text"))
    if size > MAX_BROADCAST:
        return _joined(q, e, key)
    asked = q.groupBy(F.col("term").cast("binary").alias("term")).agg(F.collect_list(F.struct("question_id")).alias("ids")).toArrow()
    kinds = (questions.schema["question_id"].dataType, entries.schema[key].dataType)
    ids = q.select("question_id").distinct().toArrow().column(0).combine_chunks()
    place = {i: at for at, i in enumerate(ids.to_pylist())}
    lists = [[place[x["question_id"]] for x in found] for found in asked.column("ids").to_pylist()]
    start = np.cumsum([0, *map(len, lists)])
    sent = entries.sparkSession.sparkContext.broadcast((asked.column("term").to_pylist(), ids, start, np.fromiter(chain.from_iterable(lists), np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ids, start, asked = sent.value
        words, best, least, last = Terms(words), None, np.zeros(len(ids), np.int64), None
        for batch in (b.slice(at, 1024) for b in batches for at in range(0, b.num_rows if len(ids) else 0, 1024)):
            keys, found = batch.column(0), [[] if t is None else words.held(t) for t in batch.column(1).to_pylist()]
            for row, q, score in _pairs(found, start, asked, len(ids)):
                if k is None:
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(q)), keys.take(pa.array(row)), pa.array(score, pa.int32())], names)
                    continue
                ahead = score >= least[q]
                row, q, score = row[ahead], q[ahead], score[ahead]
                if last is not None:  # of equal scores only keys before the last one kept
                    ahead = (score > least[q]) | pc.fill_null(pc.less(keys.take(pa.array(row)), last.take(pa.array(q))), True).to_numpy(zero_copy_only=False)
                    row, q, score = row[ahead], q[ahead], score[ahead]
                if len(row):
                    new = pa.table({"q": q, "score": score, "key": keys.take(pa.array(row))})
                    best = _best(new if best is None else pa.concat_tables([best, new]), k)
                    at = np.searchsorted(best.column("q").to_numpy(), np.arange(len(ids))) + k - 1
                    full = (at < len(best)) & (best.column("q").to_numpy()[np.minimum(at, len(best) - 1)] == np.arange(len(ids)))
                    least = np.where(full, best.column("score").to_numpy()[np.minimum(at, len(best) - 1)], 0)
                    last = best.column("key").combine_chunks().take(pa.array(np.where(full, at, 0), mask=~full))
        if best is not None:
            yield from pa.table([ids.take(best.column("q").combine_chunks()), best.column("key"), best.column("score").cast(pa.int32())], names).to_batches()

    names = ["question_id", key, "score"]
    return e.select(key, F.col("_text").cast("binary").alias("_text")).mapInArrow(run, StructType([StructField(c, t) for c, t in zip(names, (*kinds, IntegerType()), strict=True)]))


def _joined(q: DataFrame, e: DataFrame, key: str) -> DataFrame:
    """Scores where the questions' terms are too many to travel whole: blocks of them meet the entries in a join."""
    n = q.select("term").distinct().count()
    blocks = q.select("term").distinct().groupBy(F.pmod(F.xxhash64("term"), F.lit(max(1, -(-n // BLOCK)))).alias("_block")).agg(F.collect_list("term").alias("terms")).select("terms")
    held = e.crossJoin(blocks).select(key, F.explode(F.filter("terms", lambda t: F.contains("_text", t))).alias("term"))
    return held.join(q, "term").groupBy("question_id", key).agg(F.count("*").cast("int").alias("score"))


def catalog_text() -> Column:
    return F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit("")), F.array_join("topics", " "))


def broad(questions: DataFrame, catalog: DataFrame, longer_than: int = TERM_LENGTH, k: int | None = None) -> DataFrame:
    """question_id, source_id, score: documents by their catalogue entry alone; see scored() for k."""
    return scored(questions, catalog, "source_id", catalog_text(), longer_than, k)


def specific(questions: DataFrame, chunks: DataFrame, longer_than: int = TERM_LENGTH, k: int | None = None) -> DataFrame:
    """question_id, chunk_id, score over all chunks; see scored() for k."""
    return scored(questions, chunks, "chunk_id", F.col("text"), longer_than, k)


def ranked(scores: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """Scores with rank by score, then key; the k best if k is given."""
    out = scores.withColumn("rank", F.row_number().over(Window.partitionBy("question_id").orderBy(F.desc("score"), key)))
    return out if k is None else out.where(F.col("rank") <= k)


def two_stage(questions: DataFrame, catalog: DataFrame, chunks: DataFrame, documents: int = 5, longer_than: int = TERM_LENGTH) -> DataFrame:
    """Chunks scored inside the best documents of each question only."""
    best = ranked(broad(questions, catalog, longer_than, documents), "source_id", documents).select("question_id", "source_id")
    c = best.join(chunks.select("source_id", "chunk_id", F.lower("text").alias("_text")), "source_id")
    c = c.join(questions.select("question_id", terms(F.col("question"), longer_than).alias("terms")), "question_id")
    score = F.size(F.filter("terms", lambda t: F.contains("_text", t)))
    return c.select("question_id", "source_id", "chunk_id", score.alias("score")).where("score > 0")


def with_tag(chunks: DataFrame, tags: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Chunks that carry all wanted tag values: narrowed before any matching."""
    cond = F.lit(True)
    for d, v in wanted.items():
        cond = cond & (F.col(d) == v)
    return chunks.join(tags.where(cond).select("chunk_id"), "chunk_id", "left_semi")
