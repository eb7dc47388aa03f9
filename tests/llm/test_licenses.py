import re

from millrace.llm import licenses as li

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = [
    (1, "Released under the MIT License."),
    (2, "x " * 3000 + "Licensed under the Apache License, Version 2.0. And the GNU general public\nlicense too."),
    (3, None),
    (4, ""),
    (5, "mit mit license license apache license"),
    (6, "This program is free software: you can redistribute it and/or modify it, truly, under the terms of the GNU General Public License as published by the Free Software Foundation"),
    (7, "All rights reserved"),
    (7, "All rights reserved"),
    (None, "MIT LICENSE"),
    (8, "permission is granted to nobody"),
]


def test_base_places_equal_brute_force(spark, write):
    got = li.op4_licenses(spark, write(documents=DOCS)).collect()
    want = []
    for i, t in DOCS:
        w = [x for x in WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))]
        at = [(p, v) for ph, v in li.PHRASES.items() for p in range(len(w)) if w[p : p + len(ph.split())] == ph.split()]
        want.append((i, len(w), len(at), min((p for p, _ in at), default=None), max((p for p, _ in at), default=None), ",".join(sorted({v for _, v in at}))))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    by = {r.doc_id: r for r in got}
    assert by[6].labels == "gpl" and by[6].score > 0.8  # one word more moves the diagonal, not the candidate
    assert by[7].labels == "proprietary" and by[8].labels == "" and by[8].score == 0
    assert by[2].labels == "apache,gpl" and all(0 <= r.score <= 1 for r in got)


def test_spans_and_clashing_columns(spark, write):
    docs = li.table(spark, write(documents=DOCS), "documents").withColumnRenamed("lang", "p").withColumnRenamed("source", "gram")
    got = {r.doc_id: r for r in li.license_scan(docs.select("doc_id", "text", "p"), ["doc_id", "text"]).collect()}
    assert [(s.label, s.first, s.last) for s in got[1].spans] == [("mit", 0, 4)]


def test_empty_table(spark, write):
    assert li.op4_licenses(spark, write(documents=[])).count() == 0
