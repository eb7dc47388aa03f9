"""SentencePiece encoding and decoding on the tokenizers library.

The model file is read field by field (protobuf wire format, no generated classes). From it come the
normaliser (its precompiled character map, white space rules), the metaspace marker, the pieces with
their scores as a unigram model or, for BPE models, as merges in order of score, and byte fallback.

Where no piece holds the marker behind another character, no piece crosses the gap between words, so
words are encoded apart: the words of some texts are encoded once, in multithreaded batches, and those
that the next texts hold too are looked up. Other models get whole texts. What a task remembers is
bounded in bytes and gone when it ends.
"""

import hashlib
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, normalizers

from millrace.llm.common import free_name, give_back, per_process, pieces, small_batches, table, texts

MARK = "▁"
#: Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: What is remembered from one piece of work to the next: so many words of so many characters at most, some 20 MB.
REMEMBERED, LONGEST = 60_000, 32
#: Characters that the library gets at once; a longer word comes alone.
AT_ONCE = 1 << 18
#: Words that the library gets as one text.
JOINED = 64


def fields(data: bytes) -> Iterator[tuple[int, Any]]:
    """(number, value) of each field of a protobuf message."""
    at, n = 0, len(data)

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < n:
        key = varint()
        kind = key & 7
        if kind == 0:
            value: Any = varint()
        elif kind == 1:
            value, at = data[at : at + 8], at + 8
        elif kind == 2:
            size = varint()
            value, at = data[at : at + size], at + size
        elif kind == 5:
            value, at = data[at : at + 4], at + 4
        else:
            raise ValueError(f"wire type {kind}")
        yield key >> 3, value


class Model:
    """What a SentencePiece model file says."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.type, self.byte_fallback, self.unk_surface = UNIGRAM, False, " ⁇ "
        self.charsmap, self.dummy_prefix, self.trim, self.escape = b"", True, True, True
        self.suffix_mark = False
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                spec = dict(fields(value))
                self.type = spec.get(3, UNIGRAM)
                self.byte_fallback = bool(spec.get(35, 0))
                self.suffix_mark = bool(spec.get(24, 0))
                self.unk_surface = spec[44].decode() if 44 in spec else self.unk_surface
            elif number == 3:
                spec = dict(fields(value))
                self.charsmap = spec.get(2, b"")
                self.dummy_prefix, self.trim, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        if self.type not in (UNIGRAM, BPE) or self.suffix_mark or not self.escape:
            raise ValueError("only unigram and BPE models with a leading marker are supported")
        if USER_DEFINED in self.kinds:
            raise ValueError("user-defined pieces are not supported")
        self.unk = self.kinds.index(UNKNOWN)
        #: Whether words can be encoded apart: no piece has the marker behind another character.
        self.apart = not any(MARK in p.lstrip(MARK) for p, k in zip(self.pieces, self.kinds) if k == NORMAL)

    def normalizer(self) -> normalizers.Normalizer | None:
        """The model's normaliser without the marker: character map and white space rules."""
        steps = []
        if self.charsmap:
            steps.append(normalizers.Precompiled(self.charsmap))
        if self.trim:
            steps += [normalizers.Replace(Regex(" +"), " "), normalizers.Strip()]
        return normalizers.Sequence(steps) if steps else None

    def tokenizer(self) -> Tokenizer:
        """Encodes marked text (spaces are markers already) into ids."""
        usable = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, UNKNOWN, BYTE)}
        if self.type == UNIGRAM:
            # pieces that texts must not match get a score beyond reach; ids stay as they are
            vocab = [(p if k in (NORMAL, UNKNOWN, BYTE) else f"\x00{i}", s if k == NORMAL else -1e9) for i, (p, s, k) in enumerate(zip(self.pieces, self.scores, self.kinds))]
            return Tokenizer(models.Unigram(vocab, unk_id=self.unk, byte_fallback=self.byte_fallback))
        normal = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        merges = []
        for piece, i in normal.items():
            parts = [(piece[:c], piece[c:]) for c in range(1, len(piece)) if piece[:c] in normal and piece[c:] in normal]
            merges += [(-self.scores[i], normal[a], normal[b], a, b) for a, b in parts]
        merges.sort(key=lambda m: m[:3])
        return Tokenizer(models.BPE(usable, [m[3:] for m in merges], unk_token=self.pieces[self.unk], fuse_unk=True, byte_fallback=self.byte_fallback))


class Codec:
    """Encodes and decodes texts as the model's own library does."""

    def __init__(self, data: bytes):
        self.model = m = Model(data)
        self.tokenizer = m.tokenizer()
        self.normal = m.normalizer()
        self.seen: dict[str, bytes] = {}  # ids of four bytes, as packed() joins them
        byte = {i: int(p[3:5], 16) for i, (p, k) in enumerate(zip(m.pieces, m.kinds)) if k == BYTE}
        surface = []
        for i, (p, k) in enumerate(zip(m.pieces, m.kinds)):
            surface.append(bytes([byte[i]]) if k == BYTE else b"" if k == CONTROL else m.unk_surface.encode() if k == UNKNOWN else p.replace(MARK, " ").encode())
        self.surface, self.bytes = pa.array(surface, pa.binary()), frozenset(byte)
        self.byte_of = np.isin(np.arange(len(surface)), list(byte))
        self.silent = np.array([k == CONTROL for k in m.kinds])
        self.starts = np.array([p.startswith(MARK) for p in m.pieces])
        self.normal_ids = {p: i for i, (p, k) in enumerate(zip(m.pieces, m.kinds)) if k == NORMAL}
        # merges are ranked by score; where several pieces share one, the leftmost goes first, which ranks can't say
        same: dict[float, list[str]] = {}
        for p, i in self.normal_ids.items():
            if len(p) > 1:
                same.setdefault(m.scores[i], []).append(p)
        tied = [p for ps in same.values() if len(ps) > 1 for p in ps] if m.type == BPE else []
        self.ties_everywhere = any(p.strip(MARK) for p in tied)
        #: Whether words can go to the library end to end: each begins with the marker, no piece crosses it, no id spans two.
        self.joins = m.type == BPE and m.apart and m.byte_fallback and MARK in self.normal_ids and not self.ties_everywhere

    @classmethod
    def shared(cls, data: bytes) -> "Codec":
        """One codec for all tasks of a worker."""
        return per_process(f"codec {hashlib.sha256(data).hexdigest()}", lambda: cls(data))

    def normalize(self, text: str) -> str:
        return self.normal.normalize_str(text) if self.normal else text

    def _words(self, text: str) -> list[str]:
        """Keys of `seen` whose ids, one after the other, are the text's: a word stands for itself after one marker."""
        parts = text.split(" ") if text else []
        if self.model.apart and self.model.dummy_prefix and "" not in parts and MARK not in text:
            return parts
        marked = (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK) if text else ""
        if not self.model.apart:
            return [" " + marked] if marked else []
        out, lead, parts = [], "", marked.split(MARK)
        if parts[0]:
            out.append(" " + parts[0])
        for p in parts[1:]:
            lead += MARK
            if p:
                out.append(p if lead == MARK else " " + lead + p)
                lead = ""
        return [*out, " " + lead] if lead else out

    def _merge(self, marked: str) -> tuple[int, ...]:
        """BPE by score, then from the left: for words with pieces of equal score, which are rare."""
        left, right = list(range(-1, len(marked) - 1)), list(range(1, len(marked) + 1))
        text: list[str | None] = list(marked)
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(text) and (i := self.normal_ids.get(text[a] + text[b])) is not None:
                heapq.heappush(heap, (-self.model.scores[i], a, b, text[a] + text[b]))

        for a in range(len(marked) - 1):
            offer(a, a + 1)
        while heap:
            _, a, b, piece = heapq.heappop(heap)
            if text[a] is None or text[b] is None or text[a] + text[b] != piece or right[a] != b:
                continue
            text[a], text[b], right[a] = piece, None, right[b]
            if right[b] < len(text):
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        out: list[int] = []
        for piece in text:
            if piece is None:
                continue
            if (i := self.normal_ids.get(piece)) is not None:
                out.append(i)
            elif self.model.byte_fallback:
                out += [self.model.pieces.index(f"<0x{x:02X}>") for x in piece.encode()]
            else:
                out.append(self.model.unk)
        return tuple(out)

    def _learn(self, keys: list[str], into: dict[str, bytes]) -> None:
        if self.joins:
            self._learn_joined([k for k in keys if k[0] != " "], into)
            keys = [k for k in keys if k[0] == " "]
        for some in pieces(keys, AT_ONCE, 1 << 14):
            marked = [k[1:] if k[0] == " " else MARK + k for k in some]
            tied = [self.model.type == BPE and (self.ties_everywhere or MARK * 2 in w) for w in marked]
            easy = [w for w, t in zip(marked, tied, strict=True) if not t]
            got = iter(self.tokenizer.encode_batch_fast(easy, add_special_tokens=False))
            for key, w, t in zip(some, marked, tied, strict=True):
                into[key] = np.array(self._merge(w) if t else next(got).ids, np.int32).tobytes()

    def _learn_joined(self, keys: list[str], into: dict[str, bytes]) -> None:
        """Words without markers: what the library costs for each text is shared by many of them."""
        for some in pieces(keys, AT_ONCE, 1 << 14):
            rows = [MARK + MARK.join(some[at : at + JOINED]) for at in range(0, len(some), JOINED)]
            got = np.fromiter(chain.from_iterable(x.ids for x in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)), np.int32)
            cuts, data = [*(4 * np.flatnonzero(self.starts[got])).tolist(), 4 * len(got)], got.tobytes()
            into.update(zip(some, (data[a:b] for a, b in zip(cuts[:-1], cuts[1:])), strict=True))

    def forget(self) -> None:
        self.seen = {}

    def encode(self, rows: list[str]) -> list[list[int]]:
        """Ids of each text, whole; texts may be empty."""
        return [np.frombuffer(x, np.int32).tolist() for x in self.packed(rows)]

    def packed(self, rows: list[str]) -> list[bytes]:
        """Ids of each text, whole, in four bytes each."""
        return list(chain.from_iterable(map(self._encode, pieces(rows))))

    def _encode(self, rows: list[str]) -> list[bytes]:
        split = [self._words(self.normalize(t)) for t in rows]
        words = set().union(*split)
        here = {w: self.seen[w] for w in words & self.seen.keys()}
        self._learn([w for w in words if w not in here], here)
        out = [b"".join(map(here.__getitem__, ws)) for ws in split]
        self.seen = dict(islice(((w, ids) for w, ids in here.items() if len(w) <= LONGEST), REMEMBERED))
        unk = self.model.unk
        if not self.model.byte_fallback:  # a run of unknown characters is one piece, across words too
            for k, ids in enumerate(np.frombuffer(x, np.int32) for x in out):
                if unk in ids:
                    out[k] = ids[(ids != unk) | (np.append(-1, ids[:-1]) != unk)].astype(np.int32).tobytes()
        return out

    def decode_batch(self, ids: pa.Array, sizes: pa.Array) -> list[str]:
        """The texts of many id lists, given end to end with their offsets."""
        joined = pc.binary_join(pa.ListArray.from_arrays(sizes, self.surface.take(ids)), b"").to_pylist()
        at, flat, out = sizes.to_numpy(), ids.to_numpy(), []
        strip = self.model.dummy_prefix
        for n, data in enumerate(joined):
            own = flat[at[n] : at[n + 1]]
            try:
                text = data.decode()
            except UnicodeDecodeError:
                text = self._decode_bytes(own)
            if strip and len(own) and self.silent[own[0]]:  # control pieces say nothing: the text begins after them
                own = own[np.argmin(self.silent[own]) :]
            out.append(text[1:] if strip and len(own) and self.starts[own[0]] else text)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text that ids stand for; a byte that is part of no character becomes U+FFFD."""
        return self.decode_batch(pa.array(ids, pa.int32()), pa.array([0, len(ids)], pa.int32()))[0]

    def _decode_bytes(self, ids: np.ndarray) -> str:
        parts, run = [], b""
        for i in ids.tolist():
            piece = self.surface[i].as_py()
            if i in self.bytes:
                run += piece
                continue
            parts += [_bytes(run), piece.decode()]
            run = b""
        return "".join([*parts, _bytes(run)])


def flat(encoded: list[list[int]]) -> tuple[pa.Array, pa.Array]:
    """Lists of ids end to end, and where each begins."""
    sizes = np.zeros(len(encoded) + 1, np.int32)
    np.cumsum([len(x) for x in encoded], out=sizes[1:])
    return pa.array(np.fromiter(chain.from_iterable(encoded), np.int32, int(sizes[-1]))), pa.array(sizes)


def unpacked(encoded: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """Packed ids end to end, and where each text's begin."""
    sizes = np.zeros(len(encoded) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in encoded], out=sizes[1:])
    return pa.array(np.frombuffer(b"".join(encoded), np.int32)), pa.array(sizes)


def _bytes(run: bytes) -> str:
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


@lru_cache(maxsize=2)
def default_model() -> bytes:
    """The public 32k model of the installed tokenizer files."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def encode_texts(docs: DataFrame, model: bytes | None = None, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they were, with `token_ids` (array of int). Null and empty texts have none.

    Texts of any length are encoded whole; repeated rows get the same ids. If docs has a column
    `token_ids`, the new one has underscores behind its name (free_name()).
    model: the bytes of a model file (some hundred KB), read once on the driver and broadcast.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = Codec.shared(sent.value)
        for part in batches:
            ids, sizes = unpacked([x for at in range(0, len(part), 512) for x in codec.packed([t or "" for t in part.slice(at, 512).to_pylist()])])
            yield pa.ListArray.from_arrays(sizes, ids)
        codec.forget()
        give_back()

    return docs.withColumn(free_name(docs, "token_ids"), F.arrow_udf(run, "array<int>")(F.col(text_col)))


def decode_ids(tokens: DataFrame, model: bytes | None = None, ids_col: str = "token_ids") -> DataFrame:
    """The rows of tokens with `decoded` (or that with underscores, free_name()); null ids decode to an empty text."""
    small_batches(tokens.sparkSession)
    sent = tokens.sparkSession.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = Codec.shared(sent.value)
        for part in batches:
            ids, sizes = flat([x or [] for x in part.to_pylist()])
            yield pa.array(codec.decode_batch(ids, sizes), pa.string())

    return tokens.withColumn(free_name(tokens, "decoded"), F.arrow_udf(run, "string")(F.col(ids_col)))


def parity(docs: DataFrame, model: bytes | None = None, text_col: str = "text") -> DataFrame:
    """One row: n_texts, n_ids (texts encoded otherwise than by the sentencepiece library), n_decoded (decoded otherwise)."""
    sent = docs.sparkSession.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        own, other = Codec.shared(sent.value), sentencepiece.SentencePieceProcessor(model_proto=sent.value)
        for (rows,) in texts(batches, "text", keep=True):
            mine, theirs = own.encode([t or "" for t in rows]), other.encode([t or "" for t in rows])
            back = [(own.decode(a), other.decode(a)) for a in mine]
            yield pa.record_batch({"n": [len(rows)], "ids": [sum(a != b for a, b in zip(mine, theirs))], "dec": [sum(a != b for a, b in back)]})
        own.forget()

    got = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "n long, ids long, dec long")
    return got.agg(F.sum("n").alias("n_texts"), F.sum("ids").alias("n_ids"), F.sum("dec").alias("n_decoded"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, decoded again, and compared with what the normaliser makes of it."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast(default_model())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.shared(sent.value)
        for docs, found in texts(batches, "doc_id", "text", keep=True):
            whole = [t or "" for t in found]
            ids, sizes = unpacked(codec.packed(whole))
            decoded, at = codec.decode_batch(ids, sizes), sizes.to_numpy()
            own = ids.to_numpy().astype("<u4")
            fallback = np.concatenate([[0], np.cumsum(codec.byte_of[own])])
            yield pa.record_batch(
                {
                    "doc_id": pa.array(docs, pa.int64()),
                    "n_tokens": pa.array(np.diff(at).astype(np.int64)),
                    "ids_sha256": pa.array([hashlib.sha256(own[a:b].tobytes()).hexdigest() for a, b in zip(at[:-1], at[1:])], pa.string()),
                    "n_byte_tokens": pa.array((fallback[at[1:]] - fallback[at[:-1]]).astype(np.int64)),
                    "decoded_sha256": pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
                    "round_trip": pa.array([d == codec.normalize(t) for d, t in zip(decoded, whole, strict=True)], pa.bool_()),
                }
            )
        codec.forget()

    return table(spark, sf_dir, "documents").select("doc_id", "text").mapInArrow(rows, "doc_id long, n_tokens long, ids_sha256 string, n_byte_tokens long, decoded_sha256 string, round_trip boolean")


def sentencepiece_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last step of the method: every document, null and empty ones too, held against the library."""
    return parity(table(spark, sf_dir, "documents"))
