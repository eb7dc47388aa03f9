"""Line dedup over the whole corpus by deletion neighbourhoods, with words as the unit of edits.

A line is its words (split at white space, A-Z lower-cased). It goes if an equal line, or one within
one word edit (a word replaced, added or left out), stands earlier; order is by document id, then line.
Lines of fewer than MIN_WORDS words must be equal. Lines without words stay.

Each line emits a hashed key for itself and for each word left out. Equal keys meet: lines that leave
out the word at the same place differ in that word alone, and a whole line that equals another with a
word left out is that line but for the word. So the earliest line of a key stands for all others of
the key, and no pairs within a key are made. Found pairs are verified on their words.

Before that, lines without any partner are set aside: of two lines within one edit, the first or the
last half is the same, so a line whose halves occur in no other line emits nothing.
"""

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Bloom, Steps, free_name, give_back, sent, small_batches, table, texts

MIN_WORDS = 8
#: Order of rows without an id: after all others.
LAST = (1 << 63) - 1
#: Lines that a task remembers, so as not to emit the keys of a repeated line again.
REMEMBERED = 300_000
#: Words whose keys are made together; a longer line comes alone.
WORDS = 1 << 15
_BASES = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)
_KEY = ["h1", "h2"]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


class Lines:
    """The lines with words of a batch of texts, and 128-bit sums over their words (all modulo 2^64)."""

    def __init__(self, rows: list[str]):
        split = [[line.split() for line in (t or "").encode().lower().split(b"\n")] for t in rows]
        found = [(d, n, ws) for d, lines in enumerate(split) for n, ws in enumerate(lines) if ws]
        self.doc = np.array([f[0] for f in found], np.int64)
        self.line = np.array([f[1] for f in found], np.int32)
        self.words = [f[2] for f in found]
        self.n = np.array([len(w) for w in self.words], np.int64)
        self.end = np.cumsum(self.n)
        self.start = self.end - self.n
        total = int(self.end[-1]) if len(found) else 0
        w = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(self.words)), np.uint64, total)
        self.sums, self.back = [], []
        for base in _BASES:
            up = np.full(total + 1, base, np.uint64)
            down = np.full(total + 1, pow(base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            up, down = np.cumprod(up), np.cumprod(down)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * up[:-1])]))
            self.back.append(down)
            w = _mix(w + np.uint64(1))

    def hashes(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the words from start to end, wherever they stand."""
        one, two = ((s[end] - s[start]) * b[start] for s, b in zip(self.sums, self.back))
        return one, two

    def halves(self) -> tuple[np.ndarray, np.ndarray]:
        """(line, key): hashes of the first and last halves, for this length and the next."""
        long = np.flatnonzero(self.n >= MIN_WORDS)
        s, e, n = self.start[long], self.end[long], self.n[long]
        owner, keys = [], []
        for size in (n // 2, (n + 1) // 2):
            for side, (a, b) in enumerate(((s, s + size), (e - size, e))):
                owner.append(long)
                keys.append(_mix(self.hashes(a, b)[0] + (2 * size.astype(np.uint64) + np.uint64(side)) * np.uint64(_BASES[0])))
        return np.concatenate(owner), np.concatenate(keys)

    def neighbourhood(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(line, place, key, key) of the given lines: whole (place -1) and with each word left out."""
        n = self.n[which]
        owner = np.repeat(which, n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        s, e, at = self.start[owner], self.end[owner], self.start[owner] + place
        without = []
        for t, b in zip(self.sums, self.back):
            without.append(((t[at] - t[s]) + (t[e] - t[at + 1]) * b[1]) * b[s])
        whole = self.hashes(self.start[which], self.end[which])
        return np.concatenate([which, owner]), np.concatenate([np.full(len(which), -1), place]).astype(np.int32), np.concatenate([whole[0], without[0]]), np.concatenate([whole[1], without[1]])


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether two word sequences are at most one word edit apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + (len(a) == len(b)) :] == b[p + 1 :]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _ids(ids: list[int | None]) -> np.ndarray:
    return np.array([LAST if i is None else i for i in ids], np.int64)


def corpus_lines(one: DataFrame) -> DataFrame:
    """i, tk, line, h1, h2 and the half keys of every line with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tks, rows in texts(batches, "id", "tk", "text"):
            lines = Lines(rows)
            h1, h2 = lines.hashes(lines.start, lines.end)
            owner, keys = lines.halves()
            order = np.argsort(owner, kind="stable")
            sizes = np.zeros(len(h1) + 1, np.int32)
            np.cumsum(np.bincount(owner, minlength=len(h1)), out=sizes[1:])
            yield pa.record_batch({"i": pa.array(_ids(ids)[lines.doc]), "tk": pa.array(np.array(tks, np.int64)[lines.doc]), "line": pa.array(lines.line), "h1": _signed(h1), "h2": _signed(h2), "halves": pa.ListArray.from_arrays(pa.array(sizes), _signed(keys[order]))})

    return one.mapInArrow(run, "i long, tk long, line int, h1 long, h2 long, halves array<long>")


def deletion_keys(one: DataFrame, partnered: Callable[[], Bloom]) -> DataFrame:
    """v1, v2, place, h1, h2, i, line for each line that may have a partner; whole lines carry their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[int, int]] = {}
        known = partnered()
        for ids, rows in texts(batches, "id", "text"):
            lines = Lines(rows)
            owner, keys = lines.halves()
            may = np.unique(owner[known.has(keys)])
            if not len(may):
                continue
            h1, h2 = lines.hashes(lines.start, lines.end)
            i = _ids(ids)[lines.doc]
            fresh = []
            for k, h, order in zip(may.tolist(), h1[may].tolist(), zip(i[may].tolist(), lines.line[may].tolist())):
                if (before := seen.get(h)) is None or order < before:
                    seen[h] = order
                    fresh.append(k)
            if len(seen) > REMEMBERED:
                seen = {}
            which = np.array(fresh, np.int64)
            work = np.cumsum(lines.n[which]) // WORDS  # lines of some words are expanded together
            for at in np.split(which, np.flatnonzero(np.diff(work)) + 1) if len(which) else ():
                own, place, v1, v2 = lines.neighbourhood(at)
                said = [b" ".join(lines.words[k]).decode() for k in at.tolist()]
                yield pa.record_batch({"v1": _signed(v1), "v2": _signed(v2), "place": pa.array(place), "h1": _signed(h1[own]), "h2": _signed(h2[own]), "i": pa.array(i[own]), "line": pa.array(lines.line[own]), "words": pa.array(said + [None] * (len(own) - len(said)), pa.string())})

    return one.select("id", "text").mapInArrow(run, "v1 long, v2 long, place int, h1 long, h2 long, i long, line int, words string")


def near_lines(keys: DataFrame, steps: Steps) -> DataFrame:
    """h1, h2 of the lines that have an earlier line within one edit, verified on their words."""
    multi = keys.groupBy("v1", "v2").agg(F.min("h1").alias("low"), F.max("h1").alias("high"), F.min("h2").alias("low2"), F.max("h2").alias("high2")).where("low != high OR low2 != high2").select("v1", "v2")
    met = keys.join(multi, ["v1", "v2"]).groupBy("v1", "v2", "place", *_KEY).agg(F.min(F.struct("i", "line")).alias("o"))
    met = steps.put(met, "lines-met")
    at_place = met.groupBy("v1", "v2", "place").agg(F.min(F.struct("o", *_KEY)).alias("same"))
    at_key = at_place.groupBy("v1", "v2").agg(F.min(F.when(F.col("place") >= 0, F.col("same"))).alias("less"), F.min(F.when(F.col("place") < 0, F.col("same"))).alias("whole"))
    both = met.join(at_place, ["v1", "v2", "place"]).join(at_key, ["v1", "v2"])
    partner = F.when(F.col("place") < 0, F.col("less")).otherwise(F.least("same", "whole"))  # least() passes over nulls
    pairs = both.withColumn("p", partner).where(F.col("p.o") < F.col("o")).select(*_KEY, F.col("p.h1").alias("p1"), F.col("p.h2").alias("p2")).distinct()
    said = steps.put(keys.where("place = -1").groupBy(*_KEY).agg(F.min("words").alias("words")), "lines-words")
    pairs = pairs.join(said, _KEY).join(said.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("words").alias("earlier")), ["p1", "p2"])

    def verify(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in columns:
            yield pa.array([within_one(x.split(" "), y.split(" ")) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.bool_())

    return pairs.where(F.arrow_udf(verify, "boolean")("words", "earlier")).select(*_KEY).distinct()


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """i, tk, exact and near (sorted line numbers from 0): what each text loses; texts that lose nothing have no row."""
    small_batches(docs.sparkSession)
    steps = Steps(docs.sparkSession)
    one = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tk"), F.col(text_col).alias("text"))
    found = steps.put(corpus_lines(one), "lines-halves")
    halves = found.select("h1", "h2", F.explode("halves").alias("k"))
    shared = halves.groupBy("k").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low != high")
    shared = steps.put(shared.select("k"), "lines-shared")
    partnered = sent(docs.sparkSession, Bloom.of(shared, "k"))
    lines = steps.put(found.drop("halves"), "lines")
    steps.drop(found, shared)
    keys = steps.put(deletion_keys(one, partnered), "lines-keys")
    near = steps.put(near_lines(keys, steps).withColumn("near", F.lit(True)), "lines-near")
    steps.drop_all_but(lines, near)
    first = lines.groupBy(*_KEY).agg(F.min(F.struct("i", "line")).alias("o"), F.count("*").alias("n"))
    first = first.join(near, _KEY, "left").where("n > 1 OR near").select(*_KEY, "o", F.coalesce("near", F.lit(False)).alias("near"))
    gone = lines.select("i", "tk", "line", *_KEY).join(first, _KEY).where(F.col("near") | (F.col("o") < F.struct("i", "line"))).select("i", "tk", "line", "near")
    return gone.groupBy("i", "tk").agg(F.array_sort(F.collect_set(F.when(~F.col("near"), F.col("line")))).alias("exact"), F.array_sort(F.collect_set(F.when(F.col("near"), F.col("line")))).alias("near"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they were, with `lines`: kept (the text without dropped lines),
    n_lines (with words), n_exact and n_near (dropped).

    A null text stays null and counts as empty. A text of any length is one row, its lines are joined
    by line feeds as before. Rows of one id are one document: equal lines in them drop neither. Rows
    without an id come last in the order; ids are whole numbers (others are an error) below 2^63 - 1,
    which counts as none. If docs has a column `lines`, the new one has underscores behind its name
    (free_name()).
    """
    gone = dropped_lines(docs, id_col, text_col).select(F.col("i").alias("_i"), F.col("tk").alias("_tk"), "exact", "near")

    def rebuild(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        give_back()
        for whole in columns:
            parts = []
            for at in range(0, len(whole[0]), 512):
                kept, n = [], []
                text, exact, near = (x.slice(at, 512).to_pylist() for x in whole)
                for t, a, b in zip(text, exact, near, strict=True):
                    rows = (t or "").split("\n")
                    drop = {*(a or ()), *(b or ())}
                    kept.append(t if not drop else "\n".join(x for k, x in enumerate(rows) if k not in drop))
                    n.append(sum(bool(x.encode().split()) for x in rows))
                parts.append(pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array([len(a or ()) for a in exact], pa.int64()), pa.array([len(b or ()) for b in near], pa.int64())], ["kept", "n_lines", "n_exact", "n_near"]))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("kept", pa.string()), ("n_lines", pa.int64()), ("n_exact", pa.int64()), ("n_near", pa.int64())]))
        give_back()

    i = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    joined = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text_col).alias("_text"), i.alias("_i"), F.xxhash64(text_col).alias("_tk")).join(gone, ["_i", "_tk"], "left")
    # not called deterministic, else a filter on its result is pushed below it and it runs twice, in workers of its own
    lines = F.arrow_udf(rebuild, "kept string, n_lines long, n_exact long, n_near long").asNondeterministic()("_text", "exact", "near")
    return joined.select("_doc.*", lines.alias(free_name(docs, "lines")))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps of its lines."""
    got = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    x = F.col("lines")
    kept = F.coalesce(x["kept"], F.lit(""))
    return got.select("doc_id", x["n_lines"].alias("n_lines"), (x["n_lines"] - x["n_exact"] - x["n_near"]).alias("n_kept"), x["n_exact"].alias("n_exact"), x["n_near"].alias("n_near"), F.length(kept).cast("long").alias("n_chars"), F.sha2(kept, 256).alias("text_sha256"))


OP1_SQL = rf"""
WITH doc AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (
  SELECT doc_id, p, ls[p] AS raw,
         regexp_extract_all(translate(ls[p], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM doc, unnest(range(1, len(ls) + 1)) AS t(p)),
said AS (SELECT doc_id, p, raw, w, len(w) AS n, array_to_string(w, ' ') AS k FROM line),
first AS (SELECT k, any_value(w) AS w, any_value(n) AS n, min(row(doc_id, p)) AS o FROM said WHERE n > 0 GROUP BY k),
less AS (SELECT k, n, o, j, array_to_string(list_concat(w[1:j - 1], w[j + 1:]), ' ') AS v FROM first, unnest(range(1, n + 1)) AS t(j) WHERE n >= {MIN_WORDS}),
near AS (
  SELECT a.k FROM less a JOIN less b ON a.v = b.v AND a.j = b.j AND b.o < a.o
  UNION SELECT a.k FROM less a JOIN first b ON a.v = b.k AND b.n >= {MIN_WORDS} AND b.o < a.o
  UNION SELECT b.k FROM less a JOIN first b ON a.v = b.k AND b.n >= {MIN_WORDS} AND a.o < b.o),
judged AS (
  SELECT s.doc_id, s.p, s.raw, s.n > 0 AS wordy, near.k IS NOT NULL AS near, near.k IS NULL AND f.k IS NOT NULL AND f.o < row(s.doc_id, s.p) AS exact
  FROM said s LEFT JOIN first f ON s.k = f.k AND s.n > 0 LEFT JOIN near ON s.k = near.k AND s.n > 0),
kept AS (
  SELECT doc_id, count(*) FILTER (wordy) AS n_lines, count(*) FILTER (exact) AS n_exact, count(*) FILTER (near) AS n_near,
         coalesce(string_agg(raw, chr(10) ORDER BY p) FILTER (NOT near AND NOT exact), '') AS text
  FROM judged GROUP BY doc_id)
SELECT doc_id, n_lines, n_lines - n_exact - n_near AS n_kept, n_exact, n_near, length(text) AS n_chars, sha256(text) AS text_sha256 FROM kept
"""
