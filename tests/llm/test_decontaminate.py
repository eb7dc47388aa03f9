import hashlib
import re

import pytest

from millrace.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    wins = []
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        wins += [(tuple(w[p : p + n]), str(i)) for p in range(len(w) - n + 1) if n]
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for win, item in wins:
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p : p + len(win)]) == win:
                    hit |= set(range(p, p + len(win)))
                    ids.add(item)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, LONG), (2, "Short ITEM"), (2, "other text"), (10, " ".join(f"w{i}" for i in range(5, 25))), (3, ""), (4, None), (5, "Éa B-c")]
DOCS = [(1, LONG), (1, LONG), (2, None), (3, ""), (4, "x " * 5000 + LONG.upper()), (5, "a short item, Short item"), (6, "éa b c Éa b C"), (None, "other text"), (7, " ".join(f"w{i}" for i in range(12)))]


@pytest.mark.parametrize("limit", [dc.MAX_IN_PLAN, 0])
def test_equals_brute_force(spark, write, monkeypatch, limit):
    sf = write(documents=DOCS, benchmark=ITEMS)
    docs, items = (dc.table(spark, sf, t) for t in ("documents", "benchmark"))
    from pyspark.sql import functions as F

    got = dc.scan(docs, items, ["doc_id"], max_in_plan=limit).select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256), dc.contaminated())
    assert sorted(map(tuple, got.collect()), key=str) == brute(DOCS, ITEMS)


def test_empty_tables(spark, write):
    assert dc.op9_decontaminate(spark, write(documents=[], benchmark=ITEMS)).count() == 0
    got = dc.op9_decontaminate(spark, write(documents=DOCS, benchmark=[])).collect()
    assert len(got) == len(DOCS) and not any(r.contaminated or r.n_items for r in got)


def test_removal_keeps_columns(spark, write):
    sf = write(documents=DOCS, benchmark=ITEMS)
    docs = dc.table(spark, sf, "documents").withColumnRenamed("lang", "win").withColumnRenamed("source", "items")
    kept = dc.decontaminate(docs, dc.table(spark, sf, "benchmark"))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 7]
    cut = {r.doc_id: r.text for r in dc.remove_spans(docs.where("doc_id = 5"), dc.table(spark, sf, "benchmark")).collect()}
    assert cut == {5: "a"}
