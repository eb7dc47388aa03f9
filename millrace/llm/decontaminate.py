"""Benchmark decontamination with DataFrame operations only.

The normalised test n-grams go to the executors as a hash set inside the plan (checked size);
every training window is looked up in it where the text is read, so only windows that hit ever
become rows. Hits are then verified by joining on the window's text. A benchmark whose set is
too large for that goes another way: windows become rows of a hash and a place, which meet the set's
hashes in a join, and only hits are verified on their texts.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Steps, table, words

WINDOW = 13
#: Windows of the benchmark that may travel inside the plan (8 bytes each).
MAX_IN_PLAN = 200_000
#: A document is contaminated if it has a hit and RATIO * hit words >= all its words.
RATIO = 20


def _windows(words_: Column, length: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(words_) - length), lambda p: F.slice(words_, p + 1, length))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per distinct window text: its length in words and the items that hold it.

    An item of fewer words than a window is one window; an item without words has none. A null
    id counts as the empty string; rows of equal id are one item.
    """
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    items = items.withColumn("len", F.least(F.size("w"), F.lit(window)))
    each = F.transform(F.sequence(F.lit(0), F.size("w") - F.col("len")), lambda p: F.slice("w", p + 1, F.col("len")))
    rows = items.select("item", "len", F.explode(each).alias("win"))
    return rows.select("item", "len", F.xxhash64("win").alias("h"), F.array_join("win", " ").alias("win")).groupBy("win", "len", "h").agg(F.collect_set("item").alias("items"))


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text", window: int = WINDOW, max_in_plan: int = MAX_IN_PLAN) -> DataFrame:
    """Every row of docs with the columns `keep`, n_words, n_hit, items (sorted strings) and spans (start, end of hit words).

    Rows stay apart whatever their ids: repeated rows each get their own result. A null or empty
    text has no words and no hits; texts of any length are scanned whole.
    """
    steps = Steps(docs.sparkSession)
    wins = steps.put(benchmark_windows(benchmark, window=window), "benchmark-windows")
    size = wins.count()
    lengths = sorted(r[0] for r in wins.select("len").distinct().collect())  # at most `window` values
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*(F.col(k) for k in keep)).alias("_keep"), F.col(text_col).alias("_text"))
    found = _in_plan(rows, wins, lengths) if size <= max_in_plan else _joined(steps.put(rows, "benchmark-rows"), wins, lengths)
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to"))
    union = F.aggregate("spans", start, lambda a, x: F.struct((a["n"] + F.greatest(x["to"] - F.greatest(x["at"], a["to"]), F.lit(0))).alias("n"), F.greatest(a["to"], x["to"]).alias("to")))
    return found.select("_keep.*", "n_words", union["n"].alias("n_hit"), "items", "spans")


def _starts(n: int) -> Column:
    return F.when(F.size("_w") >= n, F.sequence(F.lit(0), F.size("_w") - n)).otherwise(F.array().cast("array<int>"))


def _in_plan(rows: DataFrame, wins: DataFrame, lengths: list[int]) -> DataFrame:
    """_keep, n_words, items and spans of each row; the windows' hashes are part of the plan."""
    sets: dict[int, list[int]] = {n: [] for n in lengths}
    for r in wins.select("len", "h").collect():
        sets[r["len"]].append(r["h"])

    def places(n: int) -> Column:
        starts = F.filter(_starts(n), lambda p: F.xxhash64(F.slice("_w", p + 1, n)).isin(sets[n]))
        return F.transform(starts, lambda p: F.struct(p.alias("at"), F.lit(n).alias("len"), F.array_join(F.slice("_w", p + 1, n), " ").alias("win")))

    none = F.array().cast("array<struct<at:int,len:int,win:string>>")
    split = rows.select("_row", "_keep", words(F.col("_text")).alias("_w"))
    found = split.select("_row", "_keep", F.size("_w").cast("long").alias("n_words"), (F.concat(none, *map(places, lengths)) if lengths else none).alias("_c"))
    hits = found.select("_row", "_keep", "n_words", F.explode_outer("_c").alias("_c")).select("_row", "_keep", "n_words", F.col("_c.at").alias("at"), F.col("_c.len").alias("len"), F.col("_c.win").alias("win"))
    hits = hits.join(wins.select("win", "items"), "win", "left")  # Spark broadcasts the windows if their bytes allow it
    one = F.when(F.col("items").isNotNull(), F.struct("at", (F.col("at") + F.col("len")).alias("to")))
    return hits.groupBy("_row", "_keep", "n_words").agg(F.sort_array(F.collect_set(one)).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def _joined(rows: DataFrame, wins: DataFrame, lengths: list[int]) -> DataFrame:
    """The same by a join: of stored rows, each window becomes a row of its hash; texts aren't moved but for rows with hits."""

    def places(n: int) -> Column:
        return F.transform(_starts(n), lambda p: F.struct(p.alias("at"), F.lit(n).alias("len"), F.xxhash64(F.slice("_w", p + 1, n)).alias("h")))

    split = rows.select("_row", words(F.col("_text")).alias("_w"))
    each = split.select("_row", F.explode(F.concat(*map(places, lengths))).alias("_c")).select("_row", "_c.at", "_c.len", "_c.h")
    may = each.join(wins, ["h", "len"]).groupBy("_row").agg(F.collect_list(F.struct("at", "len", "win", "items")).alias("_may"))
    both = rows.join(may, "_row", "left").select("_row", "_keep", words(F.col("_text")).alias("_w"), "_may")
    real = F.filter(F.coalesce("_may", F.array().cast(may.schema["_may"].dataType)), lambda c: F.array_join(F.slice("_w", c["at"] + 1, c["len"]), " ") == c["win"])
    both = both.select("_keep", F.size("_w").cast("long").alias("n_words"), real.alias("_c"))
    spans = F.sort_array(F.array_distinct(F.transform("_c", lambda c: F.struct(c["at"].alias("at"), (c["at"] + c["len"]).alias("to")))))
    return both.select("_keep", "n_words", spans.alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.transform("_c", lambda c: c["items"])))).alias("items"))


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (RATIO * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns (whatever their names) as they were, without contaminated documents. Null and empty texts stay."""
    inside = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text_col).alias("_said"))
    return scan(inside, benchmark, ["_doc"], "_said").where(~contaminated()).select("_doc.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs with hit words cut from contaminated texts; words of those are joined by one space."""
    inside = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text_col).alias("_whole"), words(F.col(text_col)).alias("_said"))
    got = scan(inside, benchmark, ["_doc", "_said"], "_whole")
    left = F.array_join(F.filter("_said", lambda w, i: ~F.exists("spans", lambda s: (s["at"] <= i) & (i < s["to"]))), " ")
    return got.select(*(F.when(contaminated(), left).otherwise(F.col(f"_doc.{c}")).alias(c) if c == text_col else F.col(f"_doc.{c}") for c in docs.columns))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its hit words, the items found in it and whether the rule marks it."""
    got = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


OP9_SQL = r"""
WITH item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS win
  FROM item, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS t(p) WHERE len(w) > 0),
doc AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
place AS (
  SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM doc, (SELECT DISTINCT n FROM win), unnest(range(1, greatest(len(w) - n + 2, 1))) AS t(p)),
hit AS (SELECT r, p, place.n, item FROM place JOIN win ON place.win = win.win AND place.n = win.n),
covered AS (SELECT r, count(DISTINCT p + i) AS n_hit FROM hit, unnest(range(0, n)) AS t(i) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
