import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import sentencepiece_codec as sp

CODEC = sp.Codec(sp.default_model())
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=sp.default_model())
PARTS = st.sampled_from([" ", "  ", "\n", "\t", "▁", "a", "the", "ing", "é", "日本", "😀", " ", "<s>", "</s>", "<0x41>", "<unk>", "\x00", "​", "Z", "9", "ﬁ", "́"])


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(PARTS, max_size=30).map("".join), st.text(max_size=60)))
def test_parity_with_the_library(text):
    ids = CODEC.encode([text])[0]
    assert ids == LIBRARY.encode(text)
    assert CODEC.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 31_999), max_size=20))
def test_decoding_any_ids(ids):
    assert CODEC.decode(ids) == LIBRARY.decode(ids)


def test_long_runs_of_spaces():
    for n in range(1, 70):
        text = "x" + " " * n + "y" + " " * n
        assert CODEC.encode([text])[0] == LIBRARY.encode(text), n


def test_query_round_trips(spark, write):
    docs = [(1, "Ein Text. Öl"), (1, "Ein Text. Öl"), (2, None), (3, ""), (None, "  spaced   out "), (4, "word " * 60_000), (5, "日本語 😀")]
    got = sp.op5_sentencepiece(spark, write(documents=docs)).collect()
    assert len(got) == 7 and all(r.round_trip for r in got) and {r.doc_id: r.n_tokens for r in got}[3] == 0
    assert sp.op5_sentencepiece(spark, write(documents=[])).count() == 0


def test_operators_and_parity_report(spark, write):
    docs = sp.table(spark, write(documents=[(1, "one two"), (2, None), (3, "drei ß")]), "documents").withColumn("n", F.lit(1))
    encoded = sp.encode_texts(docs)
    assert encoded.columns == [*docs.columns, "token_ids"]
    got = {r.doc_id: r for r in sp.decode_ids(encoded).collect()}
    assert got[1].decoded == "one two" and got[2].decoded == "" and got[3].token_ids == LIBRARY.encode("drei ß")
    assert tuple(sp.parity(docs).first()) == (3, 0, 0)


def unigram_model():
    """A tiny unigram model file, field by field."""

    def field(number, data, kind=2):
        head = bytes([number << 3 | kind]) if number < 16 else bytes([(number << 3 | kind) & 127 | 128, number >> 4])
        return head + (bytes([len(data)]) + data if kind == 2 else data)

    import struct

    def piece(text, score, kind=None):
        body = field(1, text.encode()) + field(2, struct.pack("<f", score), 5) + (field(3, bytes([kind]), 0) if kind else b"")
        return field(1, body)

    pieces = [piece("<unk>", 0, 2), piece("<s>", 0, 3), piece("</s>", 0, 3), piece("▁ab", -1.0), piece("▁a", -2.0), piece("▁", -3.0), piece("a", -2.5), piece("b", -2.6), piece("c", -4.0), piece("abc", -3.1), piece("ca", -5.0)]
    return b"".join(pieces) + field(2, field(3, b"\x01", 0)) + field(3, field(3, b"\x01", 0) + field(4, b"\x01", 0) + field(5, b"\x01", 0))


def test_new_words_go_to_the_library_together(monkeypatch):
    """Each text costs the library far more than a word does; ids are those of words encoded apart."""

    class Counting:
        texts = 0

        def encode_batch_fast(self, rows, **more):
            self.texts += len(rows)
            return CODEC.tokenizer.encode_batch_fast(rows, **more)

    own, counting = sp.Codec(sp.default_model()), Counting()
    monkeypatch.setattr(own, "tokenizer", counting)
    words = [f"{a}{i}{b}" for i in range(700) for a, b in (("x", ""), ("日", "本😀"), ("ß", "ing"), ("", "\x00"), ("\n", "\t"))]
    text = " ".join(words) + "  ▁two " + " ".join(words)
    assert own.encode([text, " ".join(words[:50])]) == [LIBRARY.encode(text), LIBRARY.encode(" ".join(words[:50]))]
    assert counting.texts < len(words) / 10


def test_unigram_model():
    data = unigram_model()
    own, other = sp.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in ("ab abc", "cab", "a  b", "xyz ab", " a", "", "cccc x", "x y z"):
        ids = own.encode([text])[0]
        assert ids == other.encode(text), text
        assert own.decode(ids) == other.decode(ids), text


def test_every_document_is_held_against_the_library(spark, write):
    from millrace.llm.queries import QUERIES

    docs = [(1, "Two words"), (2, None), (3, ""), (4, "long text with é and 中文 " * 300), (None, "▁▁ runs   of markers ▁")]
    assert tuple(QUERIES["sentencepiece_parity"](spark, write(documents=docs)).first()) == (5, 0, 0)
