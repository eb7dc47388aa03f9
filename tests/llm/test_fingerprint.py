import hashlib

import pandas as pd
import xxhash

from millrace.llm import fingerprint as fp


def brute(docs):
    rows = sorted(((i, t or "") for i, t in docs), key=lambda r: -r[0])
    out = {}
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 3
        new = text[: len(text) - cut] + following[:cut]
        a, b, c = (fp.canonical(t) for t in (text, new, following))
        out[i] = (len(text), hashlib.sha256(new.encode()).hexdigest(), xxhash.xxh3_128_hexdigest(a), xxhash.xxh3_128_hexdigest(b), float(a == b), float(a == c))
    return out


def test_query_equals_brute_force(spark, write):
    texts = ["", None, "a", "Ab  C", "ab c", "ＡＢ c", "Straße", "STRASSE", "é" * 7, "long " * 50_000, "x y z"]
    docs = [(i * 3 - 5, texts[i % len(texts)]) for i in range(60)]
    got = fp.op10_fingerprint(spark, write(documents=docs)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute(docs)
    assert len(got) == len(docs)


def test_one_document_follows_itself(spark, write):
    got = fp.op10_fingerprint(spark, write(documents=[(7, "abcdef")])).collect()
    assert [(r.doc_id, r.edited_sha256) for r in got] == [(7, hashlib.sha256(b"abcdab").hexdigest())]


def test_empty_table_repeated_and_missing_ids(spark, write):
    assert fp.op10_fingerprint(spark, write(documents=[])).count() == 0
    got = fp.op10_fingerprint(spark, write(documents=[(1, "aaa"), (1, "aaa"), (None, "bbb")])).toPandas()
    assert sorted(got.doc_id.fillna(-1)) == [-1, 1, 1]


def test_collision_is_told_apart_by_bytes(spark, write, monkeypatch):
    docs = spark.createDataFrame([(1, "one", 9), (2, "two", 9), (3, " ONE", 9), (4, "four", 9)], "doc_id long, text string, fingerprint_ long")
    monkeypatch.setattr(fp, "digest", lambda c: "0" * 32)
    got = fp.fingerprints(docs).toPandas()
    assert isinstance(got, pd.DataFrame)
    prints = dict(zip(got.doc_id, got.fingerprint))
    assert prints[1] == prints[3] and len(set(prints.values())) == 3
