import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import chat

TRICKY = st.lists(st.sampled_from(["\\", "###", "### ", "</turn>", "</turn", ":", ": ", "\n", "assistant", "é", "<", "#"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TRICKY, TRICKY), max_size=5))
def test_escapes_are_reversible(turns):
    formatted = "".join(f"### {chat.escape_role(r)}: {chat.escape(t)}</turn>\n" for r, t in turns)
    assert chat.parse(formatted) == turns


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -9, r or "", x or "") for c, t, r, x in rows if c == conv))
        every = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_query_reads_back_every_turn(spark, write):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "a </turn>\n### user: x"), (1, 3, "user", "more"), (1, 4, "assistant", None), (2, 0, "user", "alone"), (2, 0, "user", "alone"), (3, None, None, "x" * 200_000), (3, 1, "assistant", ""), (4, 0, "assistant", "\\\\")]
    rows += [(None, 0, "assistant", "no id"), (5, 1, "assistant", "second"), (5, 0, "assistant", "first")]
    got = chat.op3_chat(spark, write(conversations=rows)).collect()
    want = brute(rows + chat.EXTRA)
    assert {r[0]: tuple(r)[1:5] for r in got} == want


def test_each_reply_is_one_example(spark):
    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "r1"), (1, 2, "user", "q2"), (1, 3, "assistant", "r2"), (1, 4, "user", "bye")], "conv_id long, turn long, role string, text string")
    got = chat.chat_examples(rows).orderBy("n_example").collect()
    assert [g.formatted[g.loss_start : g.loss_end] if g.loss_start is not None else None for g in got] == ["r1", "r2", None]
    assert [len(chat.parse(g.formatted)) for g in got] == [2, 4, 5]


def test_empty_table(spark, write):
    assert [r.conv_id for r in chat.op3_chat(spark, write(conversations=[])).collect()] == [-7]
