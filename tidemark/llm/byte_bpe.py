"""Byte-level BPE encoding and decoding (operator 8).

The vocabulary file of ranks is turned into a sentencepiece BPE model by writing the model's protobuf
message directly: each token's bytes are mapped to one code point each, the score is the negative rank,
and normalisation is the identity. Texts are split into pre-tokens by a pattern, every pre-token is encoded
on its own, and ids are decoded by the inverse mapping.

Null and empty texts give no ids and empty bytes; repeated rows give repeated rows; an empty table gives an
empty table; other columns of the input are ignored, whatever they are called. Very long texts are
encoded whole. Letters that Unicode assigned only lately may be split otherwise than by other engines, whose
tables are of another version.
"""

from __future__ import annotations

import base64
import struct
from array import array

import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, ship

ship(__name__)

#: Code point of byte 0; byte b is code point FIRST + b.
FIRST = 0x100
#: Pre-tokens remembered by a task.
REMEMBERED = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | bytes | float) -> bytes:
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def mapped(token: bytes) -> str:
    """One code point for each byte."""
    return token.decode("latin-1").translate(_UP)


_UP = {b: FIRST + b for b in range(256)}


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """The serialised sentencepiece model: pieces in rank order, then the piece for unknown text.

    Fixed values (field numbers of the public model format): pieces 1 (piece 1, score 2, type 3), trainer 2
    (model type 3, vocabulary size 4, unknown id 40), normaliser 3 (name 1, dummy prefix 3, extra spaces 4, escape 5).
    """
    order = sorted(ranks, key=ranks.get)
    parts = [_field(1, _field(1, mapped(t).encode()) + _field(2, float(-ranks[t])) + _field(3, 1)) for t in order]
    parts.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    parts.append(_field(2, _field(3, 2) + _field(4, len(order) + 1) + _field(40, len(order))))
    parts.append(_field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))
    return b"".join(parts)


class Codec:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        order = sorted(ranks, key=ranks.get)
        self.ids = [ranks[t] for t in order]  # sentencepiece id -> rank
        self.tokens = {ranks[t]: t for t in order}
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model_proto(ranks))
        # the white space of Unicode, which some engines extend by control characters
        space = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
        pattern = regex.sub(r"(\[\^?[^\]]*)\\s", lambda m: m[1] + space, pattern)
        pattern = pattern.replace(r"\s", f"[{space}]").replace(r"\S", f"[^{space}]")
        self.split = regex.compile(pattern).findall
        self.packed: dict[str, bytes] = _Remembered(self.pre_token)

    def pre_token(self, text: str) -> bytes:
        """Ids of one pre-token as little-endian 32-bit integers."""
        data = text.encode()
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else [self.ids[i] for i in self.processor.encode(mapped(data))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.packed.__getitem__, self.split(text or "")))

    def decode(self, ids: bytes) -> bytes:
        numbers = array("I", ids)
        if struct.pack("=I", 1) != struct.pack("<I", 1):
            numbers.byteswap()
        return b"".join(map(self.tokens.__getitem__, numbers))


class _Remembered(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self.make(key)
        if len(self) < REMEMBERED and len(key) < 64:
            self[key] = value
        return value


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian unsigned 32-bit integers, without special tokens."""
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        codec = Codec(read_ranks(path), pattern)

        def fn(cols):
            ids = [codec.encode(t) for t in cols[1]]
            return [cols[0], [len(x) // 4 for x in ids], ids]

        return fn

    return map_rows(df.select(F.col(id_col).alias("doc_id"), F.col(text_col)), make, f"doc_id {kind}, n_tokens bigint, ids binary")


def decode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds ``decoded`` (the text's bytes) to (doc_id, n_tokens, ids)."""
    kind = df.schema["doc_id"].dataType.simpleString()

    def make():
        codec = Codec(read_ranks(path), pattern)
        return lambda cols: [*cols, [codec.decode(x or b"") for x in cols[2]]]

    return map_rows(df.select("doc_id", "n_tokens", "ids"), make, f"doc_id {kind}, n_tokens bigint, ids binary, decoded binary")


def digests(df: DataFrame) -> DataFrame:
    """The digests of ids and decoded bytes, without the long columns."""
    return df.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): the ids of every text and whether decoding them gives its bytes again."""
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        codec = Codec(read_ranks(path), pattern)

        def fn(cols):
            ids = [codec.encode(t) for t in cols[1]]
            return [cols[0], [len(x) // 4 for x in ids], ids, [codec.decode(x) == (t or "").encode() for x, t in zip(ids, cols[1])]]

        return fn

    schema = f"doc_id {kind}, n_tokens bigint, ids binary, round_trip boolean"
    return map_rows(df.select(F.col(id_col).alias("doc_id"), F.col(text_col)), make, schema)
