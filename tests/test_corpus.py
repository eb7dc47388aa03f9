import json
import os
import time

from millrace import cli, sinks
from millrace.operators import retrieve
from millrace.plans import corpus
from millrace.sources import formats
from millrace.streaming import ingest

REPORT = "# Supplier Report\n\nSupplier admission requires a payment-term review and requirements.\n\n## Terms\n\nNet sixty days.\n"
OAUTH = "# OAuth Guide\n\nRequest a token first.\n\n## Expiry\n\nAccess tokens expire after 3600 seconds, until renewed.\n"


def put(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / name.replace("_", ".").replace("0", "-")).write_text(text)
    return str(tmp_path)


def test_both_tiers(spark, tmp_path):
    got = corpus.run(spark, put(tmp_path, supplier_md=REPORT, oauth_md=OAUTH, blank_md="  \n", archive_xyz="?"))
    names = {r.filename: r for r in got.documents.collect()}
    assert names["blank.md"].verdict == "unusable" and names["oauth.md"].verdict == "ok"
    entries, chunks = got.catalog.collect(), got.chunks.collect()
    assert {e.source_id for e in entries} == {c.source_id for c in chunks} == {names[n].source_id for n in ("supplier.md", "oauth.md")}
    assert {r.reason for r in got.review_queue.collect()} == {"unusable", "failed"}
    q = spark.createDataFrame([(1, "What are the supplier admission and payment-term requirements?"), (2, "How long until access tokens expire?")], "question_id int, question string")
    top = {r.question_id: r for r in retrieve.ranked(retrieve.broad(q, spark.createDataFrame(entries, got.catalog.schema)), "source_id", 1).collect()}
    assert top[1].source_id == names["supplier.md"].source_id
    best = retrieve.ranked(retrieve.specific(q.where("question_id = 2"), spark.createDataFrame(chunks, got.chunks.schema)), "chunk_id", 1).first()
    hit = next(c for c in chunks if c.chunk_id == best.chunk_id)
    assert "3600" in hit.text and hit.source_id == names["oauth.md"].source_id and hit.heading_path == ["Expiry"]
    r = got.report.first()
    assert (r.found, r.selected, r.deliverable, r.blocked, r.failed) == (4, 3, 2, 1, 1)


def test_nested_contract(spark, tmp_path):
    parsed = corpus.parse(formats.scan(spark, put(tmp_path, a_txt="one\n\ntwo", b_docx="PK")))
    assert {r.filename: (r.char_count, r.properties) for r in parsed.documents.collect()} == {"a.txt": (8, None)}
    data = json.loads(sinks.as_json(sinks.nested(parsed.documents, parsed.sections)).first().value)
    assert [(s["block_id"], s["content"]) for s in data["sections"]] == [(0, "one"), (1, "two")]
    assert '"char_count":8' in sinks.envelope(parsed.documents).first().value
    s = sinks.summary(parsed.documents, parsed.failures).first()
    assert (s.total, s.succeeded, s.failed) == (2, 1, 1) and s.failures[0].source.endswith("b.docx")


def test_stream_of_files(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    put(src, a_txt="first text")
    ingest.ingest(spark, str(src), out, str(tmp_path / "cp")).awaitTermination(900)
    put(src, b_txt="second text")
    ingest.ingest(spark, str(src), out, str(tmp_path / "cp")).awaitTermination(900)
    assert ingest.current(spark, out, "catalog").count() == 2
    assert not ingest.refresh(spark, str(src), out)

    put(src, a_txt="changed text", b_txt=" ", c_txt="not taken yet", d_xyz="?")
    for n in ("a.txt", "b.txt"):
        os.utime(src / n, (time.time() + 60,) * 2)
    assert ingest.refresh(spark, str(src), out) and not ingest.refresh(spark, str(src), out)
    assert [r.raw_text for r in ingest.current(spark, out, "chunks").collect()] == ["changed text"]  # b has become empty
    assert ingest.current(spark, out, "catalog").count() == 1
    assert [r.reason for r in ingest.current(spark, out, "review_queue").collect()] == ["unusable"]

    ingest.ingest(spark, str(src), out, str(tmp_path / "cp")).awaitTermination(900)
    assert {r.raw_text for r in ingest.current(spark, out, "chunks").collect()} == {"changed text", "not taken yet"}
    assert sorted(r.reason for r in ingest.current(spark, out, "review_queue").collect()) == ["failed", "unusable"]


def test_command_line(spark, tmp_path, capsys):
    assert cli.main([]) == 1 and cli.main(["parse"]) == 1 and cli.main(["parse", "--list-formats"]) == 0
    assert "docx" in capsys.readouterr().out.split()
    assert cli.main(["parse", "-d", put(tmp_path, a_txt="some text here", b_txt=" ", c_xyz="?"), "--fail-fast"]) == 2
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert {d["verdict"] for d in lines} == {"ok", "unusable"}
    assert cli.main(["parse", "-f", str(tmp_path / "gone.md")]) == 1
