import random
import re
import time

from pyspark.sql import functions as F

from millrace.operators import chunk, clean, layout, retrieve, summarize, tags, verdict
from millrace.schema import as_sections


def sections(spark, rows):
    return as_sections(spark.createDataFrame(rows, "source_id string, block_id int, type string, heading_path array<string>, content string"))


def simple(spark, *contents, kind="paragraph"):
    return sections(spark, [("d", i, kind, [], c) for i, c in enumerate(contents)])


def contents(df):
    return [r.content for r in df.orderBy("source_id", "block_id").collect()]


def test_a_dirty_text_is_cleaned(spark):
    got = contents(clean.clean(simple(spark, "Page 3 of 40\nretrie-\nval systems help", "CONFIDENTIAL", "- 12 -\nwww.example.com", "12"), clean.Options(min_chars=10)))
    assert got == ["retrieval systems help"]


def test_running_heads_go(spark):
    s = simple(spark, *(f"Body {i} text.\nACME Report" for i in range(5)))
    assert all("ACME" not in c for c in contents(clean.clean(s)))
    two = simple(spark, "a\nACME", "b\nACME")
    assert contents(clean.boilerplate(two, clean.Options())) == ["a\nACME", "b\nACME"]


def test_headings_survive_as_the_rules_say(spark):
    s = sections(spark, [("d", 0, "heading", [], " "), ("d", 1, "table", [], "***"), ("d", 2, "code_block", [], "12")])
    assert contents(clean.normalize(s, clean.Options())) == ["", "***", "12"]
    assert contents(clean.line_noise(s, clean.Options())) == ["***", "12"]


def fold(blocks, least=80):
    out, buf = [], None
    for b in blocks:
        if b[1] in ("table", "code_block", "heading"):
            if buf and buf[3]:
                out.append(tuple(buf))
            buf = None
            out.append(tuple(b))
        elif buf is None:
            buf = list(b)
        elif buf[2] == b[2] and (len(buf[3]) < least or not buf[3].rstrip().endswith(tuple(".。!！?？:："))):
            buf[3] = (re.sub("-+$", "", buf[3]) + ("" if buf[3].endswith("-") else " ") + b[3]).strip()
        else:
            if buf[3]:
                out.append(tuple(buf))
            buf = list(b)
    return out + ([tuple(buf)] if buf and buf[3] else [])


def test_merging_equals_a_fold(spark):
    r = random.Random(5)
    texts = ["short.", "ends open", "hyphen-", "x" * 79, "y" * 81 + ".", "z" * 90, "", "a --"]
    rows, want = [], []
    for d in range(60):
        own = [(i, r.choice(["paragraph", "paragraph", "paragraph", "list_item", "heading", "table"]), r.choice([["A"], ["A"], ["B"]]), r.choice(texts)) for i in range(r.randint(1, 14))]
        rows += [(f"d{d:02}", *b) for b in own]
        want += [(f"d{d:02}", b[0], b[1], b[3]) for b in fold(own)]
    got = clean.merge_fragments(sections(spark, rows), clean.Options())
    assert sorted(map(tuple, got.select("source_id", "block_id", "type", "content").collect())) == sorted(want)


def test_dedupe_and_names(spark):
    s = sections(spark, [("d", 0, "paragraph", ["A"], "same"), ("d", 1, "paragraph", ["A"], "same"), ("d", 2, "paragraph", ["B"], "same"), ("d", 3, "table", [], "t"), ("d", 4, "table", [], "t")])
    assert contents(clean.dedupe(s, clean.Options())) == ["same", "same", "t", "t"]
    assert clean.chosen("min_length , normalize") == ["normalize", "min_length"]
    try:
        clean.chosen("nope")
    except ValueError as e:
        assert "nope" in str(e)
    else:
        raise AssertionError


def test_verdict_boundaries(spark):
    docs = [("scan", 40, None, None, None), ("short", 1, None, None, None), ("lim1", 10, None, None, None), ("lim2", 10, None, None, None), ("ocr", 10, True, None, None), ("gut", None, None, 100, 95), ("light", None, None, 100, 8), ("half", None, None, 100, 50), ("none", None, None, None, None)]
    d = spark.createDataFrame(docs, "source_id string, page_count int, is_scanned boolean, blocks_before long, blocks_removed long")
    size = {"scan": 120, "short": 15, "lim1": 250, "lim2": 249, "ocr": 720, "gut": 9, "light": 9, "half": 9}
    s = sections(spark, [(k, 0, "paragraph", [], "x" * n) for k, n in size.items()])
    got = {r.source_id: r for r in verdict.verdicts(d, s).collect()}
    assert {k: r.verdict for k, r in got.items()} == {"scan": "unusable", "short": "ok", "lim1": "ok", "lim2": "unusable", "ocr": "degraded", "gut": "degraded", "light": "ok", "half": "ok", "none": "unusable"}
    assert got["none"].verdict_reasons == ["no sections extracted"] and "95%" in got["gut"].verdict_reasons[0] and "only 3 chars/page" in got["scan"].verdict_reasons[0]


def test_chunks_and_short_documents(spark):
    s = sections(spark, [("d", 0, "paragraph", [], "before"), ("d", 1, "heading", [], "H"), ("d", 2, "heading", [], "I"), ("d", 3, "paragraph", [], "one"), ("d", 4, "table", [], "| t |")])
    got = [tuple(r) for r in chunk.chunks(s).orderBy("chunk_index").select("text", "heading_path").collect()]
    assert got == [("before", []), ("I\n\none\n| t |", ["I"])]
    assert chunk.keep_short_whole(s).first().is_full_document
    assert chunk.breadcrumb_text(chunk.chunks(s)).count() == 2


def test_packed_chunks_keep_everything(spark):
    text = " ".join(f"Sentence number {i} is here." for i in range(400))
    s = sections(spark, [("d", 0, "heading", [], "H"), ("d", 1, "paragraph", ["H"], text), ("d", 2, "table", ["H"], "| x |" * 2000), ("d", 3, "paragraph", ["H"], "tail.")])
    got = chunk.packed(s, chunk.Policy(target=100, most=150, overlap=0.2)).orderBy("part", "nth").collect()
    assert [r.oversized for r in got if r.text.startswith("| x |")] == [True]
    prose = [r for r in got if "Sentence" in r.text]
    assert len(prose) > 10 and all(f"number {i} " in " ".join(p.text for p in prose) for i in range(400))
    assert not any(r.oversized for r in prose)


def test_packed_chunks_cut_long_sentences(spark):
    texts = {"cjk": "\u6587" * 9000, "words": "word " * 3000, "clauses": "some clause, " * 900, "signs": "\U0001f600" * 3000, "blank": " ", "none": ""}
    s = sections(spark, [(d, 0, "paragraph", [], x) for d, x in texts.items()] + [("two", 0, "paragraph", [], "One"), ("two", 1, "paragraph", [], "two")])
    got = {}
    for r in chunk.packed(s, chunk.Policy(target=100, most=150, overlap=0.0)).orderBy("source_id", "nth").collect():
        got.setdefault(r.source_id, []).append(r)
    assert set(got) == {"cjk", "words", "clauses", "signs", "two"}  # a text of white space has no chunk
    for d, rows in got.items():
        assert [r.nth for r in rows] == list(range(len(rows))) and not any(r.oversized for r in rows)
        if d != "two":
            assert "".join("".join(r.text for r in rows).split()) == "".join(texts[d].split())
    assert [r.text for r in got["two"]] == ["One\ntwo"]
    assert all(r.text.startswith("some clause") for r in got["clauses"]) and all(r.text.endswith("word") for r in got["words"])  # cut at separators only


def test_summary(spark):
    s = sections(spark, [("d", 0, "heading", [], "Title"), ("d", 1, "paragraph", [], "Some words, more words. Some"), ("d", 2, "code_block", [], "skip"), ("e", 0, "table", [], "| a |")])
    got = {r.source_id: r for r in summarize.summaries(s).collect()}
    assert got["d"].title == "Title" and got["d"].topics == ["Some", "words", "more"] and got["e"].title == "e"


def test_questions(spark):
    c = spark.createDataFrame([("c1", "tokens expire after 3600 seconds"), ("c2", "supplier admission"), ("c3", "nothing")], "chunk_id string, text string")
    q = spark.createDataFrame([(1, "How long until access tokens expire?")], "question_id int, question string")
    assert [(r.chunk_id, r.score) for r in retrieve.specific(q, c).collect()] == [("c1", 2)]
    assert q.select(retrieve.terms(F.col("question"))).first()[0] == ["until", "access", "tokens", "expire"]


def test_scores_equal_a_plain_search(spark, monkeypatch):
    r = random.Random(3)
    syll = ["ab", "c", "dé", "E", "?", ".", "日本", "x-", "\u00a0", "\u2003", "\x1c", " ", " ", "\n", "long", "longer", "İ"]
    text = lambda n: "".join(r.choice(syll) for _ in range(n))
    asked = [(i // 2, text(60)) for i in range(24)] + [(None, text(40)), (50, None), (51, ""), (52, "????? a...."), (53, "every longest")]
    made = [(f"c{i}", text(r.randint(1, 120))) for i in range(300)] + [("none", None), ("empty", ""), ("w", "é" * 3000 + "longer")]
    q = spark.createDataFrame(asked, "question_id long, question string")
    c = spark.createDataFrame(made, "chunk_id string, text string").repartition(5)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    plain = q.select("question_id", F.explode(retrieve.terms(F.col("question"))).alias("t")).crossJoin(c).where(F.contains(F.lower("text"), F.col("t"))).groupBy("question_id", "chunk_id").agg(F.count("*").cast("int").alias("score"))
    want, best = rows(plain), rows(retrieve.ranked(plain, "chunk_id", 5))
    for places in (1 << 20, 7):
        monkeypatch.setattr(retrieve, "PLACES", places)
        assert rows(retrieve.specific(q, c)) == want
        assert rows(retrieve.ranked(retrieve.specific(q, c, k=5), "chunk_id", 5)) == best
    # what goes to the ranking is bounded by questions and tasks, not by entries
    assert retrieve.specific(q, c, k=2).count() <= 2 * 5 * 16 < len(want)
    monkeypatch.setattr(retrieve, "MAX_BROADCAST", 0)
    assert rows(retrieve.specific(q, c)) == want
    assert retrieve.specific(q.limit(0), c, k=5).count() == 0


def test_tag_hierarchy(spark):
    tree = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(12)], "node string, parent string")
    m = spark.createDataFrame([(1, "n0"), (1, "n12"), (2, "n0"), (2, "m")], "item int, node string")
    assert sorted(map(tuple, tags.prune_descendants(m, tree).select("item", "node").collect())) == [(1, "n12"), (2, "m"), (2, "n0")]


def test_boxes_equal_a_greedy_reading(spark):
    r = random.Random(9)
    rows = [(f"p{p}", float(r.randint(0, 200)), float(r.randint(0, 300)), float(r.choice([8, 10, 14])), f"w{i}") for p in range(12) for i in range(r.randint(1, 25))]
    df = spark.createDataFrame(rows, "source_id string, top double, left double, height double, text string")
    want = {}
    for p in {x[0] for x in rows}:
        lines = []
        for _, top, left, height, text in sorted((x for x in rows if x[0] == p), key=lambda x: (x[1], x[2], x[3], x[4])):
            for n, line in enumerate(lines):
                h = line[0]
                if abs(h[0] + h[2] / 2 - top - height / 2) <= max(h[2], height) * 0.5:
                    line.append((top, left, height, text))
                    break
            else:
                lines.append([(top, left, height, text)])
        want |= {(p, b[3], n) for n, line in enumerate(lines) for b in line} if isinstance(want, set) else {(p, b[3], n): 1 for n, line in enumerate(lines) for b in line}
    got = {(r.source_id, r.text, r.line): 1 for r in layout.box_lines(df).collect()}
    assert got == want
    assert layout.box_blocks(df).count() >= 12


def greedy_lines(boxes):
    """(text, line) by the plain rule over all leading boxes, with NaN and null as in SQL."""
    nan = lambda x: x != x
    key = lambda x: tuple((v is not None, not isinstance(v, str) and v is not None and nan(v), "" if isinstance(v, str) else 0.0 if v is None or nan(v) else v, v if isinstance(v, str) else "") for v in x)
    heads, out = [], {}
    for top, left, height, text in sorted(boxes, key=key):
        line = len(heads)
        if top is not None and height is not None:
            for n, h in enumerate(heads):
                if h is not None:
                    reach = (float("nan") if nan(h[1]) or nan(height) else max(h[1], height)) * 0.5
                    if nan(reach) or abs(h[0] - (top + height / 2)) <= reach:
                        line = n
                        break
        if line == len(heads):
            heads.append(None if top is None or height is None else (top + height / 2, height))
        out[text] = line
    return out


def test_boxes_of_odd_sizes(spark):
    r = random.Random(4)
    odd = [None, float("nan"), float("inf"), float("-inf"), -3.0, -40.0, 0.0, 1e18, 900.0]
    rows = []
    for p in range(40):
        some = odd if p % 2 else [-3.0, -40.0, 0.0, 900.0]
        for i in range(r.randint(1, 40)):
            top, height = (r.choice(some) if r.random() < 0.1 else x for x in (float(r.randint(0, 900)), r.choice([8.0, 10.5, 31.0])))
            rows.append((f"p{p}", top, float(i), height, f"w{i}"))
    df = spark.createDataFrame(rows, "source_id string, top double, left double, height double, text string")
    got = {(x.source_id, x.text): x.line for x in layout.box_lines(df).collect()}
    assert got == {(p, t): n for p in {x[0] for x in rows} for t, n in greedy_lines([x[1:] for x in rows if x[0] == p]).items()}


def test_boxes_of_one_large_picture(spark):
    """Time grows with the boxes, not with their square."""
    r = random.Random(5)
    rows = [("p", float(r.randint(0, 3000)), float(i), float(r.choice([8, 10, 14])), f"w{i}") for i in range(40_000)]
    df = spark.createDataFrame(rows, "source_id string, top double, left double, height double, text string")
    began = time.time()
    got = {x.text: x.line for x in layout.box_lines(df).collect()}
    assert layout.box_blocks(df).count() >= 1 and time.time() - began < 60
    assert got == greedy_lines([x[1:] for x in rows])


def test_columns(spark):
    w = [("d", 1, float(x), float(x + 20), float(t), float(t + 8), 600.0, f"{c}{t}") for t in range(0, 400, 10) for c, x in (("L", 50), ("R", 400))]
    df = spark.createDataFrame(w, "source_id string, page int, x0 double, x1 double, top double, bottom double, width double, text string")
    text = layout.page_text(df).first().text
    assert layout.two_column_pages(df).first().two_columns and text.index("L390") < text.index("R0")


def test_ancestors_at_any_depth(spark):
    from millrace.operators import tags

    chain = spark.createDataFrame([(f"n{k}", f"n{k + 1}") for k in range(40)] + [("n40", None)], "node string, parent string")
    matched = spark.createDataFrame([("i", "n0"), ("i", "n35"), ("j", "n0")], "item string, node string")
    assert sorted(map(tuple, tags.prune_descendants(matched, chain).collect())) == [("i", "n35"), ("j", "n0")]
