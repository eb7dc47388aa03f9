"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all preceding turns are its context, and only that reply is
trainable. A conversation that doesn't end with a reply (or has none) also yields a last example
without a trained span, so every turn stands in the output.

Template, a turn:  ### <role>: <text></turn>\n
In texts a backslash precedes each backslash, `</turn>` and `###`, in roles also each colon, so a
control string in a text is never read as one and unescaping gives the text back.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table, texts

START, COLON, END = "### ", ": ", "</turn>\n"
TRAINED = "assistant"
_CONTROL = re.compile(r"\\|###|</turn>")
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\<]|<(?!/turn>))*)</turn>\n", re.S)
EXAMPLE = "conv_id long, n_example int, formatted string, loss_start int, loss_end int, last boolean"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns that a formatted example holds."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def _ordered(conversations: DataFrame) -> DataFrame:
    """Turns in order within partitions that hold whole conversations, one row at a time in memory."""
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, n_example, formatted, loss_start, loss_end, last); the longest context is all that is held."""
    conv, prefix, n, waiting = None, [], 0, None
    began = False

    def close():
        # a reply at the very end is the last example; otherwise the whole conversation follows untrained
        if waiting is not None:
            yield (*waiting, True)
        elif began:
            yield (conv, n, "".join(prefix), None, None, True)

    for convs, roles, rows in texts(batches, "conv_id", "role", "text"):
        for c, role, text in zip(convs, roles, rows, strict=True):
            if not began or c != conv:
                yield from close()
                conv, prefix, n, waiting, began = c, [], 0, None, True
            elif waiting is not None:
                yield (*waiting, False)
                waiting = None
            head, body = f"{START}{escape_role(role)}{COLON}", escape(text)
            prefix.append(head + body + END)
            if role == TRAINED:
                whole = "".join(prefix)
                prefix = [whole]
                stop = len(whole) - len(END)
                waiting = (c, n, whole, stop - len(body), stop)
                n += 1
    yield from close()


def chat_examples(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) -> one row per training example.

    Columns: conv_id, n_example (from 0), formatted, loss_start and loss_end (code points; null in an
    example without a trained span), last (the conversation's longest example). A null text or role
    counts as empty, a null turn comes first, a null conv_id is a conversation like others; repeated
    turns all stay, in the order of role and text. Other columns are ignored.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.bool_()]
        names = ["conv_id", "n_example", "formatted", "loss_start", "loss_end", "last"]
        out, held = [], 0
        for row in _examples(batches):
            out.append(row)
            held += len(row[2])
            if held > 4_000_000 or len(out) == 4096:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out, held = [], 0
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return _ordered(conversations).mapInArrow(rows, EXAMPLE)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, what its formatted examples hold: the digests of the contract.

    Examples of a conversation must stand together and in order, as chat_examples() leaves them.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, loss, chars, total = [], hashlib.sha256(), 0, 0
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for columns in texts(batches, "conv_id", "formatted", "loss_start", "loss_end", "last"):
            for conv, formatted, start, stop, last in zip(*columns, strict=True):
                total += len(formatted)
                if start is not None:
                    reply = unescape(formatted[start:stop])
                    chars += len(reply)
                    loss.update(reply.encode())
                if last:
                    turns = parse(formatted)
                    every = hashlib.sha256()
                    for role, text in turns:
                        every.update(f"{role}\n{text}\n".encode())
                    out.append((conv, len(turns), every.hexdigest(), chars, loss.hexdigest(), total))
                    loss, chars, total = hashlib.sha256(), 0, 0
            if len(out) >= 1024:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out = []
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return examples.mapInArrow(rows, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: The contract's extra conversation: control strings inside texts.
EXTRA = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string")
    return read_back(chat_examples(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)))


OP3_SQL = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')),
sized AS (
  SELECT *, 4 + length(replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ':', '\:')) + 2
           + length(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')) + 8 AS n
  FROM turns),
summed AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY i) AS upto, max(i) OVER (PARTITION BY conv_id) AS last FROM sized)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR i = last) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id
"""
