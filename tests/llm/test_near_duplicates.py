import random

from millrace.llm import near_duplicates as nd


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + min(5, len(w))]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i), d)) for i, (d, _) in enumerate(docs)), key=str)


def edits(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"e{r.random():.6f}"
    return words


def corpus(seed):
    r = random.Random(seed)
    docs, i = [], 0
    hot = [f"hot{k}" for k in range(40)]
    for size in (3, 6, 12, 30, 62, 66, 90, 140, 400):
        for _ in range(6):
            base = [f"w{r.randrange(300)}" for _ in range(size)]
            for k in range(r.randint(1, 7)):
                i += 1
                docs.append((i, " ".join(edits(r, base, r.choice([0, 0, 1, 1, 2, max(1, size // 60)])))))
    for _ in range(40):  # a passage that many documents share
        i += 1
        docs.append((i, " ".join(hot + [f"u{r.random():.6f}" for _ in range(r.choice([4, 60]))])))
    base = [f"c{k}" for k in range(200)]
    for _ in range(60):  # one large group whose members lie at all distances
        i += 1
        docs.append((i, " ".join(edits(r, base, r.randint(0, 7)))))
    r.shuffle(docs)
    return docs + [(9000, None), (9001, ""), (9002, " \n\t"), (9003, "One"), (9004, "one"), (None, docs[0][1]), (None, ""), (docs[1][0], docs[1][1])]


def test_equals_brute_force(spark, write):
    for seed in (1, 2):
        docs = corpus(seed)
        got = nd.near_duplicates(nd.table(spark, write(documents=docs), "documents")).collect()
        assert sorted(((r.id, r.n_shingles, r.component_id) for r in got), key=str) == brute(docs)


def alike(seed, size, own, edited):
    """Documents that share a passage: their similarities lie on both sides of the threshold, no original among them."""
    r = random.Random(seed)
    passage = [f"p{seed}x{k}" for k in range(160)]
    return [(k, " ".join(edits(r, passage, edited) + [f"o{seed}x{k}x{j}" for j in range(own)])) for k in range(size)]


def test_groups_below_the_threshold(spark, write):
    docs = alike(1, 300, 25, 1) + [(1000 + i, t) for i, t in alike(2, 100, 0, 5)] + [(2000 + i, t) for i, t in alike(3, 60, 14, 0)]
    got = nd.near_duplicates(nd.table(spark, write(documents=docs), "documents")).collect()
    want = brute(docs)
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert len({c for i, _, c in want if i < 1000}) > 250 and any(c != i for i, _, c in want)


def test_dropping_keeps_columns_and_one_of_each(spark, write):
    docs = nd.table(spark, write(documents=[(3, "a b c d e f g"), (1, "A b c d e f g"), (2, "x y z"), (4, None), (5, None), (None, "a b c d e f g"), (None, "other words")]), "documents").withColumnRenamed("lang", "sid").withColumnRenamed("source", "_id").withColumnRenamed("n_chars", "id")
    kept = nd.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted((str(r.doc_id) for r in kept.collect())) == ["1", "2", "4", "5", "None"]


def test_empty_table(spark, write):
    assert nd.op2_near_duplicates(spark, write(documents=[])).count() == 0
