"""Byte-level BPE with sentencepiece: a model serialised straight from a rank file.

The vocabulary (token bytes -> rank) becomes a sentencepiece BPE model: every
token's bytes are mapped to 256 printable characters, the piece's score is
minus its rank, the normaliser is the identity.  Merging the pair with the
best score, leftmost first, is then merging the pair with the lowest rank.
Texts are cut by the pre-token pattern, each pre-token is mapped and encoded
on its own, and decoding maps the pieces back to bytes.
"""

from __future__ import annotations

import base64
import struct

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices, without

CACHE_ENTRIES = 150_000
CACHED_CHARS = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """``token-in-base64 rank`` lines; the file is a fixed public vocabulary."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def byte_chars() -> list[str]:
    """A printable character for each byte: itself where printable Latin-1, else the next from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out) + bytes([n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: piece i is the token of rank i, one unknown piece follows the last rank.

    Field numbers are those of the public ModelProto: pieces 1 (piece 1, score 2, type 3), trainer_spec 2
    (model_type 3, vocab_size 4, unk/bos/eos/pad id 40-43), normalizer_spec 3 (name 1, dummy prefix 3, extra
    white space 4, escaping 5).
    """
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0..n-1 without a gap")
    chars = byte_chars()
    out = []
    for rank, token in enumerate(tokens):
        piece = "".join(map(chars.__getitem__, token)).encode()
        out.append(_block(1, _block(1, piece) + _varint(2 << 3 | 5) + struct.pack("<f", -rank) + _number(3, 1)))
    out.append(_block(1, _block(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2)))
    n = len(tokens)
    out.append(_block(2, _number(3, 2) + _number(4, n + 1) + _number(40, n) + b"".join(_number(f, -1) for f in (41, 42, 43))))
    out.append(_block(3, _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)))
    return b"".join(out)


class ByteBPE:
    """Encoder and decoder over one vocabulary; the cache of pre-tokens is bounded."""

    def __init__(self, model: bytes, pattern: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        chars = byte_chars()
        self.to_chars = chars
        back = {c: b for b, c in enumerate(chars)}
        n = self.sp.get_piece_size() - 1
        self.bytes_of = [bytes(back[c] for c in self.sp.id_to_piece(i)) for i in range(n)]
        self.cache: dict[str, list[int]] = {}

    def mapped(self, pre_token: str) -> str:
        return "".join(map(self.to_chars.__getitem__, pre_token.encode()))

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        cut = [self.split(t) for t in texts]
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        known = self.cache
        fresh = list({p for pre in cut for p in pre if p not in known})
        ids = dict(zip(fresh, self.sp.encode([self.mapped(p) for p in fresh], num_threads=1))) if fresh else {}
        known.update((p, v) for p, v in ids.items() if len(p) <= CACHED_CHARS)
        out = []
        for pre in cut:
            one: list[int] = []
            for p in pre:
                one += known.get(p) or ids[p]
            out.append(one)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def encode_documents(docs: DataFrame, vocab_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """The input's columns and ``ids``, the token ids of the whole text.

    Null and empty texts give an empty list; repeated rows stay; a column
    called ``ids`` is replaced.  One pass without a shuffle; a task holds one
    slice of rows and the bounded cache.
    """
    docs = without(docs, "ids")
    model = docs.sparkSession.sparkContext.broadcast(model_bytes(read_ranks(vocab_path)))  # one fixed vocabulary
    at = docs.columns.index(text_col)

    def run(batches):
        bpe = ByteBPE(model.value, pattern)
        for b in slices(batches):
            ids = bpe.encode_batch([t or "" for t in b.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.list_(pa.int32()))], [*b.schema.names, "ids"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def code_documents(docs: DataFrame, vocab_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``ids`` and ``decoded`` as ``encode_documents`` and ``decode_documents`` give them, in one pass.

    One Python worker a core instead of two, and the ids cross to it once.
    """
    docs = without(docs, "ids", "decoded")
    model = docs.sparkSession.sparkContext.broadcast(model_bytes(read_ranks(vocab_path)))
    at = docs.columns.index(text_col)

    def run(batches):
        bpe = ByteBPE(model.value, pattern)
        for b in slices(batches):
            ids = bpe.encode_batch([t or "" for t in b.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(ids, pa.list_(pa.int32())), pa.array([bpe.decode(x) for x in ids], pa.binary())], [*b.schema.names, "ids", "decoded"])

    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def decode_documents(docs: DataFrame, vocab_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """The input's columns and ``decoded``, the bytes that the ids stand for (null ids: none)."""
    docs = without(docs, "decoded")
    model = docs.sparkSession.sparkContext.broadcast(model_bytes(read_ranks(vocab_path)))
    at = docs.columns.index(ids_col)

    def run(batches):
        bpe = ByteBPE(model.value, pattern)
        for b in slices(batches):
            done = [bpe.decode(x or []) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(done, pa.binary())], [*b.schema.names, "decoded"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("decoded", T.BinaryType())]))
