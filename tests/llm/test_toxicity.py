import random
import zlib
from collections import Counter

import numpy as np

from millrace.llm import toxicity as tox


def corpus(n=900, seed=1):
    r = random.Random(seed)
    plain = ["".join(r.choice("abdefhiklmnoprstu") for _ in range(r.randint(2, 9))) for _ in range(400)]
    bad = ["vilgr" + x for x in ("ak", "om", "et", "un", "ish")] + ["zorkface", "zorkhead"]
    docs, labels = [], []
    for i in range(n):
        y = r.random() < 0.2
        w = [r.choice(plain) for _ in range(r.randint(5, 80))]
        for _ in range(1 + len(w) // 15 if y else 0):
            w.insert(r.randint(0, len(w)), r.choice(bad))
        docs.append((i, " ".join(w)))
        if i % 5:
            labels.append((i, 1, int(y)))
    return docs, labels


def test_held_out_rows_are_told_apart(spark, write):
    docs, labels = corpus()
    docs += [(5000, None), (5001, ""), (5002, "zorkface " * 30_000), (None, "no id"), (1, docs[1][1])]
    got = tox.op7_toxicity(spark, write(documents=docs, labels=labels)).collect()
    assert len(got) == len(docs)
    truth = {i: y for i, _, y in labels}
    test = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert len(test) > 150 and np.mean([r.predicted == truth[r.doc_id] for r in test]) > 0.97
    by = {r.doc_id: r for r in got}
    assert by[5002].predicted == 1 and by[5000].score == by[5001].score < 0.7
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_held_out_labels_change_nothing(spark, write):
    docs, labels = corpus(300)
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, q, y in labels]
    a, b = (sorted(map(tuple, tox.op7_toxicity(spark, write(documents=docs, labels=x)).select("doc_id", "score").collect())) for x in (labels, flipped))
    assert a == b


def test_index_equals_brute_force():
    r = np.random.default_rng(4)
    size = 90

    def vector():
        at = np.sort(r.choice(size, r.integers(1, 12), replace=False))
        w = r.random(len(at)) + 0.01
        return at, w / np.sqrt(w @ w)

    own, queries = [vector() for _ in range(1500)], [vector() for _ in range(120)]
    index = tox.BlockMaxIndex(own, size)
    dense = np.zeros((len(own), size))
    for d, (at, w) in enumerate(own):
        dense[d, at] = w
    for (at, w), (d, s) in zip(queries, index.nearest(queries, 15)):
        every = dense[:, at] @ w
        want = np.sort(every[every > 0])[::-1][:15]
        assert np.allclose(s, want, atol=1e-4) and np.allclose(every[d], s, atol=1e-4)
    out = index.nearest(own[:50], 5, list(range(50)))
    assert all(i not in d for i, (d, _) in enumerate(out))


def test_without_labels_or_one_class(spark, write):
    docs, labels = corpus(60)
    for some in ([], [(1, 1, 0), (2, 1, 0), (None, 1, 1), (3, 1, None)]):
        got = tox.op7_toxicity(spark, write(documents=docs, labels=some)).collect()
        assert len(got) == 60 and all(r.predicted == 0 for r in got)
    assert tox.op7_toxicity(spark, write(documents=[], labels=labels)).count() == 0


def test_terms():
    assert tox.terms("The moron's Morons") == Counter({"the": 1, "moron": 1, "s": 1, "morons": 1, "^moro": 2})
