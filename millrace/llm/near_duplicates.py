"""Near-duplicate documents by bottom-k sketches of one hash function.

Texts of the same shingle set form a class; everything after works on classes. A class keeps the K
smallest hashes of its set. Inverted lists of these values yield candidates, the sketch of the union
estimates their similarity, full sets confirm it.

Values are taken rarest first, as many as a linked pair needs to share one (prefix filter), so a
passage that countless documents hold heads no list. Nothing is paired with everything: each list has
a pivot, the member whose values are the commonest (the original among edited copies), and members
meet their list's pivot only. What is linked becomes one component, and links within one change nothing.

Lists that then still hold several components are cut by the whole sets: their classes are found again
by the rarest of all their shingles, in lists that carry each class's size and how many values it can
still share from that place on. Two classes meet there only if sizes and places leave room for a link.
Again pivots go first, round after round as long as one links anything; then every pair of different
components that may be linked is compared. So no link between components is lost.

Two sets of similarity 0.75 share fewer than SHARED of their K sketch values with a probability below
1e-12; sets of up to K shingles are handled exactly.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Bloom, Steps, give_back, let_go, sent, small_batches, table, texts
from millrace.llm.components import components

SHINGLE = 5
#: Similarity as a fraction: linked if DEN * shared >= NUM * united.
NUM, DEN = 75, 100
K, SHARED = 64, 20


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def shingles(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct five-word shingles; fewer words are one shingle, none are none."""
    found = text.encode().lower().split()
    n = len(found)
    if not n:
        return np.empty(0, np.int64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    size = min(n, SHINGLE)
    h = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        h = _mix(h * np.uint64(0x9E3779B185EBCA87) + w[j : n - size + 1 + j])
    return np.unique(h.view(np.int64))


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    sizes = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64)))


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, tk (hash of the text), n (set size), sid (digest of the set; null without shingles), sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tks, rows in texts(batches, "id", "tk", "text"):
            sets = [shingles(t or "") for t in rows]
            yield pa.record_batch({"id": pa.array(ids, pa.int64()), "tk": pa.array(tks, pa.int64()), "n": pa.array(map(len, sets), pa.int64()), "sid": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()), "sketch": _lists([s[:K] for s in sets])})

    one = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tk"), F.col(text_col).alias("text"))
    return one.mapInArrow(run, "id long, tk long, n long, sid binary, sketch array<long>")


def full_sets(docs: DataFrame, id_col: str, text_col: str, wanted: Callable[[], Bloom]) -> DataFrame:
    """sid, n and the whole set of each document whose id passes the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted()
        for ids, rows in texts(batches, "id", "text"):
            keep = np.flatnonzero(known.has(np.array(ids, np.int64))).tolist()
            sets = [s for k in keep if len(s := shingles(rows[k] or ""))]
            yield pa.record_batch({"sid": pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), "n": pa.array(map(len, sets), pa.int64()), "set": _lists(sets)})

    one = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return one.mapInArrow(run, "sid binary, n long, set array<long>")


#: n and the label of a class travel with each of its keys; `left` is the most values that it can share from the key's place on.
KEY = "v long, sid binary, n long, left long, centre double"


def sketch_keys(classes: DataFrame, steps: Steps) -> DataFrame:
    """KEY: the sketch values by which a class must be found, rarest first. centre: how common its values are."""
    values = classes.select("sid", F.explode("sketch").alias("v"))
    counts = steps.put(values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1"), "near-values")
    often = sent(classes.sparkSession, Bloom.of(counts, "v"))

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        known = often()
        for batch in batches:
            sketch = batch.column("sketch")
            flat = sketch.flatten()
            ok = known.has(flat.to_numpy(zero_copy_only=False))
            owner = np.repeat(np.arange(batch.num_rows), sketch.value_lengths().to_numpy(zero_copy_only=False))[ok]
            # a set of which too few values occur elsewhere is linked with nothing
            n = batch.column("n").to_numpy()
            may = np.bincount(owner, minlength=batch.num_rows) >= np.where(n * DEN <= K * NUM, -(-n * NUM // DEN), SHARED)
            own = pa.array(owner[may[owner]])
            yield pa.record_batch({"sid": batch.column("sid").take(own), "n": batch.column("n").take(own), "v": flat.filter(pa.array(ok)).filter(pa.array(may[owner]))})
        give_back()

    shared = classes.select("sid", "n", "sketch").mapInArrow(passing, "sid binary, n long, v long").join(counts, "v")
    # of n values (K at most), a linked pair shares `need`; single values come first in the order and use up places
    need = F.when(F.col("n") * DEN <= K * NUM, F.ceil(F.col("n") * NUM / DEN)).otherwise(F.lit(SHARED))
    ranked = shared.groupBy("sid", "n").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"), F.sum(F.log2("df")).alias("centre"))  # K values at most
    take = (F.size("vs") - need + 1).cast("int")
    placed = ranked.withColumn("take", take).where("take > 0").select("sid", "n", "centre", F.size("vs").alias("m"), F.posexplode(F.slice("vs", F.lit(1), F.col("take"))).alias("p", "x"))
    return placed.select(F.col("x.v").alias("v"), "sid", "n", (F.col("m") - F.col("p")).cast("long").alias("left"), (F.col("centre") / F.least(F.col("n"), F.lit(K))).alias("centre"))


#: Values of whole sets are ordered by how many sets hold them, in these steps.
OFTEN = (2, 3, 4, 6, 8, 16, 32, 64, 128, 512, 2048, 8192)


def full_keys(sets: DataFrame, steps: Steps) -> DataFrame:
    """KEY: the same on whole sets of the classes that share sketch values.

    A class needs NUM / DEN of its shingles to occur in other sets, or nothing can be linked to it; of
    those that do, it is found by the rarest ones beyond that number less one. Nothing is estimated
    here: a Bloom filter that lets strangers pass keeps the order the same for all sets.
    """
    counts = sets.select(F.explode("set").alias("v")).groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    rank = sum(F.when(F.col("df") >= n, 1).otherwise(0) for n in OFTEN[1:])
    counts = steps.put(counts.select("v", rank.alias("top")), "near-df")
    each = counts.select("v", F.explode(F.sequence(F.lit(0), F.col("top"))).alias("rank"))
    get = sent(sets.sparkSession, Bloom.several(each, "v", len(OFTEN)))
    steps.drop(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        filters = get()
        for batch in batches:
            lists = batch.column("set")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            rank = np.zeros(len(flat), np.int8)
            at = np.arange(len(flat))
            for b in filters:  # a value that one filter stops isn't in the next
                at = at[b.has(flat[at])]
                rank[at] += 1
            owner, keys, left, centre = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
            for i, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
                often = a + np.flatnonzero(rank[a:b])
                take = len(often) + (-(b - a) * NUM // DEN) + 1
                centre.append(rank[a:b].sum() / max(1, b - a))
                if take > 0:
                    keys.append(flat[often[np.lexsort((flat[often], rank[often]))[:take]]])
                    owner.append(np.full(take, i))
                    left.append(len(often) - np.arange(take))
            own = np.concatenate(owner)
            yield pa.record_batch({"v": pa.array(np.concatenate(keys)), "sid": batch.column("sid").take(pa.array(own)), "n": batch.column("n").take(pa.array(own)), "left": pa.array(np.concatenate(left)), "centre": pa.array(np.array(centre, float)[own])})
        give_back()

    return sets.select("sid", "n", "set").mapInArrow(run, KEY)


def _room(na: Column, nb: Column, la: Column, lb: Column, whole: bool) -> Column:
    """Whether two classes can be linked if the key they meet by is the first value they share."""
    left = F.least(la, lb)
    enough = left * (NUM + DEN) >= NUM * (na + nb)
    if not whole:  # sketches of sets that don't fit one
        enough = F.when((na > K) | (nb > K), left >= SHARED).otherwise(enough)
    return (DEN * F.least(na, nb) >= NUM * F.greatest(na, nb)) & enough


def pivot_pairs(keys: DataFrame, turn: int, whole: bool) -> DataFrame:
    """a, b: each class with the pivots of its lists, of another label each."""
    order = F.struct("centre", "sid", "n", "left", "label") if not turn else F.struct(F.xxhash64("sid", F.lit(turn)).alias("h"), "sid", "n", "left", "label")
    pivot = keys.groupBy("v").agg(F.max(order).alias("p"), F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("v", "p")
    met = keys.join(pivot, "v").where((F.col("label") != F.col("p.label")) & _room(F.col("n"), F.col("p.n"), F.col("left"), F.col("p.left"), whole))
    return met.select(F.col("sid").alias("a"), F.col("p.sid").alias("b")).distinct()


def all_pairs(keys: DataFrame) -> DataFrame:
    """a, b: all pairs of classes with different labels that a list leaves room for.

    Lists are cut by size first, in steps of DEN : NUM: a class stands with its own step and the next,
    and a pair meets in the larger one's. There a class goes if the smallest size it may meet is too large for it.
    """
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(DEN / NUM)))
    cut = keys.withColumn("own", step).withColumn("step", F.explode(F.array("own", F.col("own") + 1)))
    part = cut.groupBy("v", "step").agg(F.min("n").alias("least"), F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("v", "step", "least")
    may = F.col("left") * (NUM + DEN) >= NUM * (F.col("n") + F.greatest(F.col("least"), F.ceil(F.col("n") * NUM / DEN)))
    cut = cut.join(part, ["v", "step"]).where(may).select("v", "step", "own", "sid", "n", "left", "label")
    one, other = (cut.select("v", "step", *(F.col(c).alias(f"{c}_{x}") for c in ("own", "sid", "n", "left", "label"))) for x in "ab")
    two = one.alias("one").join(other.alias("other"), (F.col("one.v") == F.col("other.v")) & (F.col("one.step") == F.col("other.step")) & (F.col("label_a") < F.col("label_b")) & (F.col("one.step") == F.greatest("own_a", "own_b")) & _room(F.col("n_a"), F.col("n_b"), F.col("left_a"), F.col("left_b"), True))
    return two.select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b")).distinct()


def confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs (a, b) those that are linked: first by the sketch of the union, then on full sets."""
    small = classes.select("sid", "n", "sketch")
    near = pairs.join(small.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka")), "a")
    near = near.join(small.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb")), "b")
    near = near.where(DEN * F.least("na", "nb") >= NUM * F.greatest("na", "nb"))
    union = F.slice(F.array_sort(F.array_union("ka", "kb")), 1, K)
    both = F.size(F.array_intersect(F.array_intersect("ka", "kb"), union))
    near = near.where(F.when(F.size(F.array_union("ka", "kb")) < K, DEN * both >= NUM * F.size(union)).otherwise(both >= SHARED)).select("a", "b")
    full = near.join(sets.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("set").alias("sa")), "a")
    full = full.join(sets.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("set").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb")).cast("long")
    return full.where(DEN * shared >= NUM * (F.col("na") + F.col("nb") - shared)).select("a", "b")


def relabelled(keys: DataFrame, labels: DataFrame) -> DataFrame:
    """The keys with their classes' components (a class without a link is its own), of lists that hold several."""
    named = keys.drop("label").join(labels.select(F.col("node").alias("sid"), "label"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    several = named.groupBy("v").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("v")
    return named.join(several, "v", "left_semi")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, tk (xxhash64 of the text), n_shingles, component_id.

    component_id is the smallest id among the rows that a row is linked to, directly or over others.
    A text without words (null, empty, white space) is linked with nothing: its component is its own
    id. Rows without an id share the class of rows of the same words; a class that only such rows hold
    is linked with nothing. Repeated rows get the same result. Texts of any length are taken whole: a
    long one is one row of its shingles' hashes. Columns other than id and text are ignored. Ids are
    whole numbers, or what a cast to long turns into one; other ids are an error.
    """
    spark = docs.sparkSession
    small_batches(spark)
    steps = Steps(spark)
    found = steps.put(sketches(docs, id_col, text_col), "near-sketches")
    classes = steps.put(found.where("sid IS NOT NULL").groupBy("sid").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "near-classes")
    members = steps.put(found.drop("sketch"), "near-members")
    steps.drop(found)

    keys = steps.put(sketch_keys(classes, steps), "near-keys")
    several = keys.groupBy("v").agg(F.count("*").alias("m")).where("m > 1").select("v")
    lists = steps.put(keys.withColumn("label", F.col("sid")).join(several, "v", "left_semi"), "near-lists")
    active = steps.put(lists.select("sid").distinct().join(classes.select("sid", "rep"), "sid"), "near-active")
    steps.drop_all_but(classes, members, lists, active)
    wanted = sent(spark, Bloom.of(active.where("rep IS NOT NULL"), "rep"))
    sets = steps.put(full_sets(docs, id_col, text_col, wanted).join(active.select("sid"), "sid", "left_semi").dropDuplicates(["sid"]), "near-sets")

    edges = steps.put(confirmed(pivot_pairs(lists, 0, False), classes, sets), "near-edges")
    labels = components(edges, steps)
    open_ = relabelled(lists, labels).select("sid").distinct()
    keys = steps.put(full_keys(sets.join(open_, "sid", "left_semi"), steps), "near-full-keys")
    steps.drop(lists, active)
    turn = 0
    while True:
        old, lists = lists, steps.put(relabelled(keys if not turn else lists, labels), f"near-full-lists{turn}")
        if turn:
            steps.drop(old)
        else:
            steps.drop(keys)
        more = steps.put(confirmed(pivot_pairs(lists, turn, True), classes, sets), f"near-edges{turn}")
        linked = more.limit(1).count()
        if not linked:
            more = steps.put(confirmed(all_pairs(lists), classes, sets), "near-edges-rest")
            if not more.limit(1).count():
                break
        before, edges = edges, steps.put(edges.union(more), f"near-edges-to{turn}")
        former, labels = labels, components(edges, steps)
        steps.drop(before, more, former)
        if not linked:
            break
        turn += 1

    named = classes.select("sid", "rep").join(labels.select(F.col("node").alias("sid"), "label"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    names = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_class = steps.put(named.join(names, "label").select("sid", "component_id"), "near-components")
    steps.drop_all_but(members, by_class)
    out = members.join(by_class, "sid", "left")
    return out.select("id", "tk", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they were, of which one document of each group stays: that of the smallest id.

    Rows without an id stay unless they are linked to a row with one. Repeated rows of one id stay
    together. Null, empty and very long texts are taken as near_duplicates() says. Columns may have any names.
    """
    found = near_duplicates(docs, id_col, text_col)
    gone = found.where((F.col("n_shingles") > 0) & F.col("component_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("component_id"))).select("id", "tk").distinct()
    inside = docs.select(F.struct(*docs.columns).alias("doc"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("doc_tk"))
    return inside.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("doc_tk") == F.col("tk")), "left_anti").select("doc.*")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set's size, its component and whether it is the one that stays."""
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


OP2_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, least(len(w), 5) || ' ' || array_to_string(w[p:p + least(len(w), 5) - 1], ' ') AS s
  FROM doc, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS t(p) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM common JOIN size a ON x = a.doc_id JOIN size b ON y = b.doc_id WHERE 100 * i >= 75 * (a.n + b.n - i)),
reach(x, y) AS (SELECT doc_id, doc_id FROM doc UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
SELECT doc.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c.component_id, doc.doc_id = c.component_id AS kept
FROM doc LEFT JOIN size USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) c USING (doc_id)
"""
