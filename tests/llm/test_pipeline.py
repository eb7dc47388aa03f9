import random

import pyarrow as pa
import sentencepiece

import corpus_pipeline as cp
from millrace.llm import common
from millrace.llm.sentencepiece_codec import default_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def text(r, n):
    return " ".join("".join(r.choice("abdefhiklmnoprstu") for _ in range(r.randint(3, 9))) for _ in range(n))


def build(write):
    r = random.Random(2)
    clean = [(i, text(r, 60) + "\n" + text(r, 30)) for i in range(150)]
    toxic = [(1000 + i, text(r, 20) + " " + " ".join(r.choice(["vilgrak", "zorkface"]) for _ in range(4))) for i in range(90)]
    base = text(r, 120).split()
    near = [(2000 + i, " ".join(base[:k] + ["mark", "other", "words", f"n{i}"] + base[k:])) for i, k in enumerate((10, 60, 100))]
    copies = [(3000 + i, clean[0][1]) for i in range(4)]
    shared = text(r, 60)
    passages = [(4000 + i, text(r, 40) + "\n" + shared) for i in range(3)]
    item = text(r, 40)
    leaks = [(5000, text(r, 10) + " " + item), (5001, text(r, 1200) + " " + " ".join(item.split()[:13]))]
    odd = [(6000, None), (6001, ""), (6002, "日本語 text")]
    docs = clean + toxic + near + copies + passages + leaks + odd
    labels = [(i, 1, 0) for i, _ in clean] + [(i, 0, 1) for i, _ in toxic]
    return docs, write(documents=docs, labels=labels, benchmark=[(1, item)])


def test_each_decision_takes_effect(spark, write):
    docs, sf = build(write)
    frame, seen = common.table(spark, sf, "documents"), []
    for name, stage in cp.STAGES:
        frame = common.stored(stage(spark, frame, sf), "test")
        seen.append({r["doc_id"]: r for r in frame.collect()})
        if name != cp.STAGES[-1][0]:
            assert frame.columns == COLUMNS
    ids = [set(s) for s in seen]
    everything = {i for i, _ in docs}
    assert everything - ids[0] == set(range(1000, 1090))
    assert ids[0] - ids[1] == {3000, 3001, 3002, 3003}
    assert "\n" in seen[1][4000].text and all("\n" not in seen[1][i].text for i in (4001, 4002)) and seen[1][4001].n_chars == len(seen[1][4001].text)
    assert ids[1] - ids[2] == {2001, 2002}
    assert ids[2] - ids[3] == {5000} and ids[3] == ids[4]
    library = sentencepiece.SentencePieceProcessor(model_proto=default_model())
    for i, r in seen[4].items():
        assert list(r.token_ids) == library.encode(seen[3][i].text or "") and r.n_tokens == len(r.token_ids)
    assert set(range(150)) <= ids[4] and {6000, 6001, 6002} <= ids[4]
    assert {r.doc_id for r in cp.run(spark, sf).collect()} == ids[4]


def test_workers_drop_what_the_last_operator_held():
    """A codec that stayed in the workers took the memory that the next run's toxicity stage needs."""
    batch = pa.record_batch({"text": ["a", "b"]})
    made = [common.per_process("codec", lambda: object()) for _ in range(2)]
    assert made[0] is made[1] and list(common.texts(iter([batch]), "text", keep=True)) == [(["a", "b"],)]
    assert common.per_process("codec", lambda: object()) is made[0]
    assert list(common.texts(iter([batch]), "text")) == [(["a", "b"],)]
    assert common.per_process("codec", lambda: object()) is not made[0]
    common.let_go()


def test_empty_corpus(spark, write):
    assert cp.run(spark, write(documents=[], labels=[], benchmark=[])).count() == 0


def test_lines_are_rebuilt_once(spark, write):
    sf = build(write)[1]
    got = cp.line_stage(spark, common.table(spark, sf, "documents"), sf)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rebuild(") == 1 and "ArrowEvalPython" in plan


def test_examples_need_no_worker_of_another_kind(spark, write, monkeypatch):
    sf, plans = build(write)[1], []
    keep = common.stored
    monkeypatch.setattr(common, "stored", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df, name))
    cp.toxicity_stage(spark, common.table(spark, sf, "documents"), sf)
    assert plans and not any("RDD" in p for p in plans)
