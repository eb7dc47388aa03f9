import random

from millrace.llm import line_dedup as ld


def close(a, b):
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < ld.MIN_WORDS:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(docs):
    """What each row keeps; order is by id (missing ones last), then line."""
    lines = []
    for n, (i, t) in enumerate(docs):
        for k, raw in enumerate((t or "").split("\n")):
            lines.append(((i is None, i or 0, k), n, raw, tuple(raw.encode().lower().split())))
    first = {}
    for o, _, _, w in lines:
        first[w] = min(first.get(w, o), o)
    near = {w for w in first if w and any(v != w and first[v] < first[w] and close(v, w) for v in first)}
    out = [[] for _ in docs]
    for o, n, raw, w in lines:
        if not w or w not in near and first[w] == o:
            out[n].append(raw)
    return out


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(30)]
    bases = [[r.choice(vocabulary) for _ in range(n)] for n in (1, 3, 7, 8, 9, 10, 15, 40) for _ in range(4)]
    docs = []
    for i in range(90):
        rows = []
        for _ in range(r.randint(0, 8)):
            w = list(r.choice(bases))
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                k = r.randrange(len(w) + 1)
                w[k : k + r.randint(0, 1)] = [r.choice(vocabulary)] * r.randint(0, 1)
            rows.append((" " * r.randint(0, 2)).join([""] + [x.upper() if r.random() < 0.1 else x for x in w]) if r.random() < 0.1 else " ".join(w))
        docs.append((r.randrange(10_000), "\n".join(rows)))
    ids = {i for i, _ in docs}
    docs = list({i: (i, t) for i, t in docs}.values()) + [(20_000, None), (20_001, ""), (20_002, "\n \n"), (None, "new line without an id\n" + docs[0][1])]
    assert ids
    return docs


def test_equals_brute_force(spark, write):
    for seed in range(3):
        docs = corpus(seed)
        got = ld.dedup_lines(ld.table(spark, write(documents=docs), "documents")).collect()
        want = {i: "\n".join(x) for (i, _), x in zip(docs, brute(docs))}
        assert {r.doc_id: r.lines.kept or "" for r in got} == want and len(got) == len(docs)


def test_repeated_rows_long_texts_and_clashing_names(spark, write):
    long = " ".join(f"w{k}" for k in range(40_000))
    docs = ld.table(spark, write(documents=[(1, "same line of text"), (1, "same line of text"), (2, "Same  line of text\nown"), (3, long), (4, long.replace("w777 ", "x "))]), "documents").withColumnRenamed("lang", "h1").withColumnRenamed("source", "exact")
    got = ld.dedup_lines(docs)
    assert got.columns == [*docs.columns, "lines"]
    by = sorted((r.doc_id, r.lines.n_lines, r.lines.n_exact, r.lines.n_near) for r in got.collect())
    assert by == [(1, 1, 0, 0), (1, 1, 0, 0), (2, 2, 1, 0), (3, 1, 0, 0), (4, 1, 0, 1)]


def test_empty_table(spark, write):
    assert ld.op1_line_dedup(spark, write(documents=[])).count() == 0


def test_word_edits():
    assert ld.within_one(["a", "b"], ["a", "c"]) and ld.within_one(["a"], ["a", "b"]) and ld.within_one([], ["x"]) and ld.within_one(["a"], ["a"])
    assert not ld.within_one(["a", "b"], ["b", "a"]) and not ld.within_one(["a"], ["a", "b", "c"])
