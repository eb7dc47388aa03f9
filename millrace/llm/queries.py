"""The registered query of each operator, and its SQL where SQL can express it."""

from millrace.llm.chat import OP3_SQL, op3_chat
from millrace.llm.decontaminate import OP9_SQL, op9_decontaminate
from millrace.llm.fingerprint import op10_fingerprint
from millrace.llm.html_extract import op8_html
from millrace.llm.licenses import OP4_SQL, op4_licenses
from millrace.llm.line_dedup import OP1_SQL, op1_line_dedup
from millrace.llm.near_duplicates import OP2_SQL, op2_near_duplicates
from millrace.llm.sentencepiece_codec import op5_sentencepiece, sentencepiece_parity
from millrace.llm.sharding import op6_shards
from millrace.llm.toxicity import op7_toxicity

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_chat": op3_chat,
    "op4_licenses": op4_licenses,
    "op5_sentencepiece": op5_sentencepiece,
    "sentencepiece_parity": sentencepiece_parity,
    "op6_shards": op6_shards,
    "op7_toxicity": op7_toxicity,
    "op8_html": op8_html,
    "op9_decontaminate": op9_decontaminate,
    "op10_fingerprint": op10_fingerprint,
}

#: The others have no SQL form; tests/llm holds them against brute force, round trips or held-out labels.
SQL = {
    "op1_line_dedup": OP1_SQL,
    "op2_near_duplicates": OP2_SQL,
    "op3_chat": OP3_SQL,
    "op4_licenses": OP4_SQL,
    "op9_decontaminate": OP9_SQL,
}
