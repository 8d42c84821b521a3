"""Byte-level BPE through a sentencepiece model written directly from the vocabulary.

The vocabulary's tokens are byte strings with ranks. Each byte is mapped to one
letter, each token so becomes a piece, and its score is its negative rank; then
sentencepiece's BPE, which merges the pair of best score first, merges the pair
of lowest rank first. The model file is put together here, field by field, with
identity normalisation and no dummy prefix. Texts are split into pre-tokens by
the pattern first, each is encoded alone, and ids are decoded by the inverse of
the mapping.

Edge cases: a null or empty text has no tokens; repeated rows get equal rows; an
empty table gives an empty result; texts are encoded whole, however long; a
token that merges cannot reach is still chosen where it is a whole pre-token.
Extra columns are left alone.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from quillspark.llm.chunks import MOST_PIECES, PieceEncoder, PieceMemory
from quillspark.llm.common import map_batches, table

#: The letter of byte b is the code point FIRST_LETTER + b: letters all, none of them white space or combining.
FIRST_LETTER = 0x100
_LETTERS = {b: FIRST_LETTER + b for b in range(256)}
#: sentencepiece's numbers for its model fields (fixed values of its public schema).
_BPE, _NORMAL, _UNKNOWN = 2, 1, 2
#: Pieces that a worker remembers where encoding is all it does.
MOST_ALONE = 1 << 18


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def letters(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_LETTERS)


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece model whose ids are the ranks; the unknown piece comes last."""
    by_rank = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must count up from 0")
    out = bytearray()
    for rank, token in enumerate(by_rank):
        piece = _field(1, letters(token).encode()) + _field(2, float(-rank)) + _field(3, _NORMAL)
        out += _field(1, piece)
    out += _field(1, _field(1, b"<unk>") + _field(2, float(-len(by_rank))) + _field(3, _UNKNOWN))
    out += _field(2, _field(3, _BPE) + _field(4, len(by_rank) + 1) + _field(40, len(by_rank)))
    out += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(out)


class PieceBpe:
    """Encodes and decodes texts; kept by a worker between batches."""

    def __init__(self, path: str, pattern: str, most: int):
        ranks = load_ranks(path)
        self.tokens = [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.split = regex.compile(pattern).findall
        whole = self.processor.encode([letters(t) for t in self.tokens], num_threads=1)
        #: Tokens that merging does not reach.
        self.unreached = {self.tokens[i]: i for i, ids in enumerate(whole) if ids != [i]}
        self.pieces = PieceEncoder(self.encode_listed, most)
        self.decoded = PieceMemory(self.decode_listed, most)

    def encode(self, text: str) -> list[int]:
        raw = [t.encode() for t in self.split(text)]
        ids = [self.processor.encode(letters(r)) for r in raw]  # one by one: a list would start threads
        if self.unreached:
            ids = [[self.unreached[r]] if r in self.unreached else i for r, i in zip(raw, ids)]
        return [i for some in ids for i in some]

    def encode_listed(self, text: str) -> bytes:
        """The ids as decimals with single spaces between."""
        return " ".join(map(str, self.encode(text))).encode()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def decode_listed(self, listed: bytes) -> bytes:
        return self.decode(list(map(int, listed.split())))

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of tokens, SHA-256 of the listed ids and of the bytes decoded from them."""
        pieces = self.pieces(text or "")
        listed = b" ".join(pieces)
        decoded = b"".join(map(self.decoded.__getitem__, pieces))
        n = listed.count(b" ") + 1 if listed else 0
        return n, hashlib.sha256(listed).hexdigest(), hashlib.sha256(decoded).hexdigest()


@lru_cache(maxsize=2)
def piece_bpe(path: str, pattern: str, most: int = MOST_PIECES) -> PieceBpe:
    """A worker's coder, which remembers so many pieces of a generation."""
    return PieceBpe(path, pattern, most)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, the ids of every whole text, and whether they decode to it."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        coder = piece_bpe(path, pattern)
        held, n = [], 0
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            pieces = coder.pieces(text or "")
            ids = np.array(b" ".join(pieces).split(), np.int32)
            exact = b"".join(map(coder.decoded.__getitem__, pieces)) == (text or "").encode()
            held.append((doc_id, len(ids), ids, exact))
            n += len(ids)
            if n > 1 << 20:
                yield encoded_batch(held)
                held, n = [], 0
        yield encoded_batch(held)

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids array<int>, exact boolean")


def encoded_batch(rows: list[tuple]) -> pa.RecordBatch:
    doc_ids, counts, ids, exact = zip(*rows) if rows else [()] * 4
    flat = np.concatenate([np.zeros(0, np.int32), *ids])
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    columns = [pa.array(doc_ids, pa.int64()), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(exact, pa.bool_())]
    return pa.record_batch(columns, ["doc_id", "n_tokens", "ids", "exact"])


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes of every row of ids."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = piece_bpe(path, pattern)
        raw = [coder.decode(ids or []) for ids in batch.column("ids").to_pylist()]
        return pa.record_batch([batch.column("doc_id"), pa.array(raw, pa.binary())], ["doc_id", "raw"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, raw binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = piece_bpe(path, pattern, MOST_ALONE)
        rows = [coder.digests(t) for t in batch.column("text").to_pylist()]
        n, ids, decoded = zip(*rows) if rows else ((), (), ())
        columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
        return pa.record_batch(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.select("doc_id", "text"), run, schema)


def op6_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
