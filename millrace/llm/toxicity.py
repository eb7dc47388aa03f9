"""Toxicity by nearest labelled examples.

Labelled documents become TF-IDF vectors over all their words and word beginnings; a term weighs more
the closer it goes with the label (the square root of its chi-square), but none is left out. A text is
scored by its k nearest examples by exact cosine, found in a block-max inverted index: an upper bound
for each block of examples lets blocks be skipped without loss. The votes, weighted by similarity, are
calibrated on the examples themselves (each without its own vote).
"""

from collections import Counter
from collections.abc import Iterator
from math import exp, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import WORD_BYTES, Steps, free_name, give_back, let_go, pieces, sent, small_batches, small_table, table, texts

#: Bound of what is fitted: labelled documents of either class. Their terms are the vocabulary.
PER_CLASS = 3000
NEIGHBOURS, BLOCK, POWER = 15, 64, 4
#: Texts that are scored together.
QUERIES = 64
REJECT = 0.7
STEM = 4


def terms(text: str) -> Counter:
    """Counts of a text's words, and of the beginnings of longer words (marked ^)."""
    count = Counter((text or "").encode().translate(WORD_BYTES).decode().split())
    for w, n in list(count.items()):
        if len(w) > STEM:
            count["^" + w[:STEM]] += n
    return count


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")), F.lit(3)) == 1, F.lit(False))


def term_keys(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's terms in order, and their counts. Two terms of one 64-bit hash would count as one."""
    own = terms(text)
    keys = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    order = np.argsort(keys)
    return keys[order], np.fromiter(own.values(), np.int32, len(own))[order]


class Vectors:
    """A vocabulary (sorted hashes) with the weight of each term: its idf over the whole corpus times its bond with the label."""

    def __init__(self, keys: np.ndarray, weight: np.ndarray):
        self.keys, self.weight = keys, weight

    def find(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the vocabulary's terms in a whole text, in order, and their counts."""
        keys, counts = term_keys(text)
        if not len(self.keys) or not len(keys):
            return np.empty(0, np.int32), np.empty(0, np.int32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        there = self.keys[at] == keys
        return at[there].astype(np.int32), counts[there]

    def vector(self, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms, and their weights in a vector of length one."""
        w = (1 + np.log(counts)) * self.weight[at]
        return at, w / np.sqrt(w @ w) if len(w) else w


class BlockMaxIndex:
    """Exact top-k by inner product over lists of examples by term.

    The lists of common terms are cut into blocks of examples; each block holds all weights and the
    largest. The lists of other terms are short: they are added up as they are. A block's bound for a
    query is what its largest weights give, plus the best sum of the short lists in it. Many queries
    are answered at once, and a block is scored for those queries only whose bound for it is above
    their k-th best so far.
    """

    #: Terms of at least one in so many examples are common.
    COMMON = 16
    #: Blocks of the first look, for each query those of the highest bounds.
    FIRST = 8
    #: Similarities this close count as equal and go by number.
    CLOSE = 1e-5

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], size: int):
        self.n = len(vectors)
        blocks = -(-self.n // BLOCK) or 1
        sizes = np.array([len(at) for at, _ in vectors], np.int64)
        term = np.concatenate([np.empty(0, np.int64), *(at for at, _ in vectors)])
        weight = np.concatenate([np.empty(0), *(w for _, w in vectors)]).astype(np.float32)
        example = np.repeat(np.arange(self.n, dtype=np.int32), sizes)
        held = np.bincount(term, minlength=size)
        common = np.flatnonzero(held * self.COMMON >= max(self.n, 1))
        self.slot = np.full(size, -1, np.int32)
        self.slot[common] = np.arange(len(common))
        self.weights = np.zeros((blocks, len(common), BLOCK), np.float32)
        often = self.slot[term] >= 0
        self.weights[example[often] // BLOCK, self.slot[term[often]], example[often] % BLOCK] = weight[often]
        self.largest = np.ascontiguousarray(self.weights.max(2).T)
        order = np.argsort(term[~often], kind="stable")
        self.example, self.weight = example[~often][order], weight[~often][order]
        self.start = np.zeros(size + 1, np.int32)
        np.cumsum(np.where(self.slot < 0, held, 0), out=self.start[1:])

    def _short(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """What the short lists give each query for each example."""
        sizes = self.start[term + 1] - self.start[term]
        where = np.arange(sizes.sum()) + np.repeat(self.start[term] - np.cumsum(sizes) + sizes, sizes)
        width = len(self.weights) * BLOCK
        place = np.repeat(query * width, sizes) + self.example[where]
        return np.bincount(place, np.repeat(weight, sizes) * self.weight[where], n * width).astype(np.float32).reshape(n, len(self.weights), BLOCK)

    def _look(self, queries: np.ndarray, short: np.ndarray, mask: np.ndarray, least: np.ndarray, but: np.ndarray) -> list[np.ndarray]:
        """(query, example, similarity) of what lies in the masked blocks and isn't below `least`."""
        found: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32))]
        for b in range(len(self.weights)):
            own = np.flatnonzero(mask[:, b])
            if len(own):
                s = queries[own] @ self.weights[b] + short[own, b]
                d = b * BLOCK + np.arange(BLOCK)
                i, j = np.nonzero((s > 0) & (s >= least[own, None] - self.CLOSE) & (d != but[own, None]))
                found.append((own[i], d[j], s[i, j]))
        return [np.concatenate(x) for x in zip(*found)]

    @staticmethod
    def _top(q: np.ndarray, d: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((d, -np.round(s, 5), q))
        q, d, s = q[order], d[order], s[order]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < k
        return q[kept], d[kept], s[kept]

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, but: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query numbers and similarities of the k nearest examples, ties by number; `but` of each is left out."""
        n = len(vectors)
        query = np.repeat(np.arange(n), [len(at) for at, _ in vectors])
        term = np.concatenate([np.empty(0, np.int64), *(at for at, _ in vectors)])
        weight = np.concatenate([np.empty(0), *(w for _, w in vectors)]).astype(np.float32)
        often = self.slot[term] >= 0
        queries = np.zeros((n, len(self.largest)), np.float32)
        queries[query[often], self.slot[term[often]]] = weight[often]
        short = self._short(query[~often], term[~often], weight[~often], n)
        out_of = np.full(n, -1) if but is None else np.array(but)
        bound = queries @ self.largest + short.max(2) + 2 * self.CLOSE
        first = np.zeros(bound.shape, bool)
        np.put_along_axis(first, np.argsort(-bound, axis=1, kind="stable")[:, : self.FIRST], True, 1)
        # the k-th best of the first look is what another block must be able to beat
        ranks = np.argsort(~first, axis=1, kind="stable")[:, : self.FIRST]
        seen = np.take_along_axis(short, ranks[:, :, None], 1)
        for b in range(len(self.weights)):
            own, slot = np.nonzero(ranks == b)
            if len(own):
                seen[own, slot] += queries[own] @ self.weights[b]
        numbers = ranks[:, :, None] * BLOCK + np.arange(BLOCK)
        seen[numbers == out_of[:, None, None]] = 0
        flat = seen.reshape(n, -1)
        least = np.partition(flat, flat.shape[1] - k, axis=1)[:, flat.shape[1] - k] if flat.shape[1] >= k else np.zeros(n, np.float32)
        i, j = np.nonzero((flat > 0) & (flat >= least[:, None] - self.CLOSE))
        more = self._look(queries, short, (bound > least[:, None]) & ~first, least, out_of)
        q, d, s = self._top(*(np.concatenate(x) for x in zip((i, numbers.reshape(n, -1)[i, j], flat[i, j]), more)), k)
        cut = np.searchsorted(q, np.arange(n + 1))
        return [(d[a:b], s[a:b].astype(float)) for a, b in zip(cut[:-1], cut[1:])]


class Model:
    """Votes of the nearest examples, calibrated. Without examples of both classes every score is the share of toxic ones."""

    def __init__(self, vectors: Vectors, examples: list[tuple[int, int, np.ndarray, np.ndarray]], class_rows: tuple[int, int]):
        own = [(i, y, vectors.vector(at, n)) for i, y, at, n in examples if len(at)]
        own.sort(key=lambda e: (e[1], e[2][0][np.argmax(e[2][1])], e[0]))  # examples alike share blocks
        self.vectors = vectors
        self.ids, self.y = [e[0] for e in own], np.array([e[1] for e in own], float)
        got = Counter(e[1] for e in examples)
        self.worth = np.array([class_rows[c] / max(1, got[c]) for c in (0, 1)])  # rows that an example stands for
        self.prior = class_rows[1] / max(1, sum(class_rows))
        self.index = BlockMaxIndex([e[2] for e in own], len(vectors.weight))
        bare = [y for _, y, at, _ in examples if not len(at)]
        w = self.worth[np.array(bare, int)] if bare else np.zeros(0)
        self.bare = float((w @ np.array(bare) + self.prior) / (w.sum() + 1)) if got else self.prior
        self.slope, self.shift = 1.0, 0.0
        if got[0] and got[1] and own:
            votes = []
            for at in range(0, len(own), QUERIES):
                votes += self.votes([e[2] for e in own[at : at + QUERIES]], list(range(at, min(at + QUERIES, len(own)))))
            x = np.array([self._logit(v[0]) for v in votes])
            self._calibrate(x, self.y, self.worth[self.y.astype(int)])

    @staticmethod
    def _logit(p: float) -> float:
        p = min(max(p, 1e-3), 1 - 1e-3)
        return log(p / (1 - p))

    def _calibrate(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> None:
        """Logistic regression by Newton's steps, drawn a little towards the identity."""
        b = np.array([1.0, 0.0])
        features = np.stack([x, np.ones_like(x)], 1)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(features @ b, -30, 30)))
            grad = features.T @ (w * (y - p)) - (b - [1.0, 0.0])
            hess = (features * (w * p * (1 - p))[:, None]).T @ features + np.eye(2)
            b = b + np.linalg.solve(hess, grad)
        self.slope, self.shift = max(0.1, float(b[0])), float(b[1])

    def votes(self, vectors: list[tuple[np.ndarray, np.ndarray]], but: list[int] | None = None) -> list[tuple[float, np.ndarray, np.ndarray]]:
        out = []
        for d, s in self.index.nearest(vectors, NEIGHBOURS, but):
            y = self.y[d]
            v = s**POWER * self.worth[y.astype(int)]
            out.append((float((v @ y + 1e-3 * self.prior) / (v.sum() + 1e-3)), d, s))
        return out

    def scores(self, rows: list[str]) -> list[tuple[float, str]]:
        """Calibrated score and evidence of each text: the three nearest examples' ids with similarity."""
        out = [(self.bare, "")] * len(rows)
        found = [self.vectors.find(t) for t in rows] if self.ids else []
        some = [i for i, (at, _) in enumerate(found) if len(at)]
        for i, (p, d, s) in zip(some, self.votes([self.vectors.vector(*found[i]) for i in some]) if some else [], strict=True):
            z = self.slope * self._logit(p) + self.shift
            evidence = " ".join(f"{self.ids[k]}:{x:.3f}" for k, x in zip(d[:3].tolist(), s[:3].tolist()))
            out[i] = (1 / (1 + exp(-max(-30.0, min(30.0, z)))), evidence)
        return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Learn from labelled rows that aren't held out: at most per_class of each class, the smallest by hash of the id.

    Class shares are counted over all labelled rows, idf over all documents. A document labelled
    twice is toxic if one label says so; of several texts of one id the smallest counts; rows without
    an id or a label are passed over.
    """
    spark = docs.sparkSession
    small_batches(spark)
    steps = Steps(spark)
    known = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    rows = dict(known.groupBy("toxic").count().collect())
    picked = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).select("doc_id", "toxic").collect() for c in (0, 1)]
    ids, toxic = ([r[k] for c in picked for r in c] for k in ("doc_id", "toxic"))
    chosen = small_table(spark, [pa.array(ids, pa.int64()), pa.array(toxic, pa.int32())], ["doc_id", "toxic"])  # 2 x per_class rows at most
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = steps.put(found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxicity-sample")

    def term_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ys, rows in texts(batches, "toxic", "text"):
            for y, t in zip(ys, rows, strict=True):
                own = term_keys(t)[0].view(np.int64)
                yield pa.record_batch({"toxic": pa.array(np.full(len(own), y, np.int32)), "term": pa.array(own)})

    n = dict(sample.groupBy("toxic").count().collect())
    n1, n0 = n.get(1, 0), n.get(0, 0)
    held = sample.select("toxic", "text").mapInArrow(term_sets, "toxic int, term long").groupBy("term").agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b")).toArrow()  # the terms of the sample
    keys, a, b = held.column("term").to_numpy().view(np.uint64), held.column("a").to_numpy(), held.column("b").to_numpy()
    some = (a + b) * (n0 + n1 - a - b) * n1 * n0
    bond = np.sqrt(np.divide((n0 + n1) * (a * (n0 - b) - b * (n1 - a)) ** 2, some, out=np.zeros(len(a)), where=some > 0)) if n0 and n1 else np.ones(len(a))
    order = np.argsort(keys)
    order = order[bond[order] > 0]  # others weigh nothing
    keys, bond = keys[order], bond[order]
    plain = sent(spark, Vectors(keys, bond))

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = plain()
        df, total = np.zeros(len(known.keys), np.int64), 0
        for (rows,) in texts(batches, "text"):
            total += len(rows)
            for t in rows:
                df[known.find(t)[0]] += 1
        there = np.flatnonzero(df)
        yield pa.record_batch({"term": pa.array(np.append(there, -1).astype(np.int32)), "n": pa.array(np.append(df[there], total))})

    counted = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(document_counts, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    at, times = counted.column("term").to_numpy(), counted.column("n").to_numpy()
    df = np.zeros(len(keys))
    df[at[at >= 0]] = times[at >= 0]
    vectors = Vectors(keys, (np.log((times[at < 0].sum() + 1) / (df + 1)) + 1) * bond)

    def vector_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = plain()
        for ids, ys, rows in texts(batches, "doc_id", "toxic", "text"):
            found = [known.find(t) for t in rows]
            ends = pa.array(np.cumsum([0, *(len(at) for at, _ in found)], dtype=np.int32))
            at, times = (pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int32), *x]))) for x in zip(*found))
            yield pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "toxic": pa.array(ys, pa.int32()), "at": at, "n": times})

    got = sample.mapInArrow(vector_counts, "doc_id long, toxic int, at array<int>, n array<int>").toArrow()
    examples = []
    for part in got.to_batches():
        ends = part.column("at").offsets.to_numpy()
        at, times = part.column("at").values.to_numpy(), part.column("n").values.to_numpy()
        for k, (i, y) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("toxic").to_pylist(), strict=True)):
            examples.append((i, y, at[ends[k] : ends[k + 1]], times[ends[k] : ends[k + 1]]))
    steps.drop(sample)
    model = Model(vectors, sorted(examples, key=lambda e: e[0]), (rows.get(0, 0), rows.get(1, 0)))
    del got, held, examples, counted
    give_back()
    return model


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they were, with `toxicity` (struct of score and evidence).

    Null counts as empty; a text without a known term gets the share of toxic ones among such examples.
    Whole texts are scored, however long; repeated rows get the same result each. If docs has a column
    `toxicity`, the new one has underscores behind its name (free_name()).
    """
    small_batches(docs.sparkSession)
    get = sent(docs.sparkSession, model)  # its size is bounded by per_class examples and their terms

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go()
        give_back()
        model = get()
        for part in batches:
            got = []
            for at in range(0, len(part), 1024):
                for rows in pieces([t or "" for t in part.slice(at, 1024).to_pylist()], most=QUERIES):
                    got += model.scores(rows)
            yield pa.StructArray.from_arrays([pa.array([s for s, _ in got], pa.float64()), pa.array([e for _, e in got], pa.string())], ["score", "evidence"])
        del model
        give_back()

    return docs.withColumn(free_name(docs, "toxicity"), F.arrow_udf(run, "score double, evidence string")(F.col(text_col)))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model that is fitted on the labelled ones that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
    score = F.col("toxicity.score")
    return got.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= REJECT).cast("int").alias("predicted"), F.col("toxicity.evidence").alias("evidence"))
