"""Token ids packed at a fixed width, in segments that can be read at any place.

A segment holds the ids of whole documents, one after the other, each id in the
least number of bits that the vocabulary needs. Ids go in blocks of BLOCK_IDS;
64 ids of width w fill w words of 64 bits exactly, so every block begins at a
byte of its own. The segment's header lists where documents begin (in ids) and
where blocks begin (in bytes), and any range of ids is unpacked with whole-array
operations on the blocks it touches.

Layout, little-endian: MAGIC, width u32, ids u64, documents u32, blocks u32;
document starts u64 x (documents + 1); block offsets u64 x (blocks + 1); words.

On storage a file is a Parquet file of such segments with their document ids, in
ascending order of doc_id: one file a range of ids, so that files, segments and
documents in them follow one another. Any store that Spark writes to will do.

Edge cases: a null or empty text has the end id alone; null ids come last;
documents with one id are ordered by a hash of their texts, repeated rows as they
are read; an empty table gives an empty result; a document larger
than a segment gets a segment of its own; extra columns are left alone.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.chunks import PieceMemory
from quillspark.llm.common import arrow_batches, bounded, give_back, local_table, settle, table, with_row_key

MAGIC, BLOCK_IDS, SEGMENT_IDS = b"QIDS", 4096, 1 << 20
#: Words of a generation that an encoder remembers: what a table of 2**19 places holds before it grows.
MOST_WORDS = 340_000
#: Bytes of input that a shard takes; small inputs have more shards than that, for all cores to work.
SHARD_BYTES = 128 << 20
_HEAD = struct.Struct("<4sIQII")
_WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}


def width_of(vocabulary: int) -> int:
    """Bits that hold every id of a vocabulary of that many."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> np.ndarray:
    """Words of 64 bits holding the ids; the last group of 64 is filled up with zeros."""
    groups = -(-len(ids) // 64)
    if width in _WHOLE:  # whole bytes: the ids themselves, one behind the other
        whole = np.zeros(64 * groups, _WHOLE[width])
        whole[: len(ids)] = ids
        return whole.view("<u8")
    padded = np.zeros((groups, 64), np.uint64)
    padded.ravel()[: len(ids)] = ids
    words = np.zeros((groups, width), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        words[:, word] |= padded[:, j] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= padded[:, j] >> np.uint64(64 - shift)
    return words.ravel()


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """All ids of whole groups of 64."""
    if width in _WHOLE:
        return words.astype("<u8", copy=False).view(_WHOLE[width]).astype(np.uint32)
    words = words.reshape(-1, width)
    ids = np.empty((len(words), 64), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        part = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            part = part | words[:, word + 1] << np.uint64(64 - shift)
        ids[:, j] = part & mask
    return ids.ravel()


def write_segment(documents: list[np.ndarray], width: int) -> bytes:
    ids = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(d) for d in documents])]).astype("<u8")
    words = pack(ids, width).astype("<u8")
    blocks = -(-len(ids) // BLOCK_IDS)
    offsets = np.minimum(np.arange(blocks + 1) * (BLOCK_IDS // 64 * width * 8), words.nbytes).astype("<u8")
    head = _HEAD.pack(MAGIC, width, len(ids), len(documents), blocks)
    return b"".join([head, starts.tobytes(), offsets.tobytes(), words.tobytes()])


class Segment:
    """A segment to read: ids by document or by range."""

    def __init__(self, data: bytes):
        magic, self.width, self.n_ids, self.n_docs, blocks = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a segment of packed ids")
        self.data = data
        self.starts = np.frombuffer(data, "<u8", self.n_docs + 1, _HEAD.size).astype(np.int64)
        at = _HEAD.size + self.starts.nbytes
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64)
        self.payload = at + self.offsets.nbytes

    def range(self, begin: int, end: int) -> np.ndarray:
        """Ids begin to end, unpacking the blocks they lie in alone."""
        if begin >= end:
            return np.zeros(0, np.uint32)
        first, last = begin // BLOCK_IDS, (end - 1) // BLOCK_IDS
        low, high = int(self.offsets[first]), int(self.offsets[last + 1])
        words = np.frombuffer(self.data, "<u8", (high - low) // 8, self.payload + low)
        return unpack(words, self.width)[begin - first * BLOCK_IDS : end - first * BLOCK_IDS]

    def document(self, k: int) -> np.ndarray:
        return self.range(int(self.starts[k]), int(self.starts[k + 1]))


#: White space other than single spaces and line breaks inside a text, for Arrow's patterns.
_ODD = (
    r"[\t\x0B\x0C\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]|[ \n]{2}|\A[ \n]|[ \n]\z"
)
#: Letters up to here are letters to every version of Unicode in use.
_LAST_LETTER, _TAILS = "\u024f", ".,;:!?"


class LibraryEncoder:
    """Ids of texts by the tokenizers library, those of recurring pieces remembered.

    Texts are cut between words with Arrow, and equal words of a batch are looked
    up once. A word that is not remembered is encoded by the library; one of
    letters alone is a single pre-token, which goes to the library's model.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Strings that the library looks for before it splits a text; a text with one goes to it whole, as one with odd spaces does.
        self.odd = "|".join([_ODD, *(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())])
        self.model, cut = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.letters: dict[int, str] = {}
        if self.tokenizer.normalizer is None and cut is not None:  # else pre-tokens are not what they seem
            for c in filter(str.isalpha, map(chr, range(ord(_LAST_LETTER) + 1))):
                self.letters[ord(c)] = cut.pre_tokenize_str(c)[0][0]
            self.space = cut.pre_tokenize_str(" a")[0][0][:-1]
        self.plain_ascii = all(self.letters.get(c) == chr(c) for c in range(128) if chr(c).isalpha())
        self.tails = {tail: [t.id for t in self.model.tokenize(tail)] for tail in _TAILS} if self.letters else {}
        self.plain = PieceMemory(lambda word: self.encode(word, ""), MOST_WORDS)
        self.spaced = PieceMemory(lambda word: self.encode(word, " "), MOST_WORDS)

    def encode(self, word: str, before: str) -> bytes:
        """The ids of a word behind a space or nothing."""
        tail = self.tails.get(word[-1:])
        core = word if tail is None else word[:-1]
        if self.letters and core.isalpha():
            if self.plain_ascii and core.isascii():
                token = core
            else:
                token = core.translate(self.letters) if max(core) <= _LAST_LETTER else None
            if token is not None:
                ids = [t.id for t in self.model.tokenize(self.space + token if before else token)]
                return array("I", ids + tail if tail else ids).tobytes()
        return array("I", self.tokenizer.encode(before + word, add_special_tokens=False).ids).tobytes()

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a column; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        for k in np.flatnonzero(odd).tolist():
            out[k] = np.array(self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, np.uint32)
        regular = np.flatnonzero(~odd)
        if len(regular):
            words = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(~odd)), "\n", " \n "), " ")
            for k, ids in zip(regular.tolist(), self._joined(words)):
                out[k] = ids
        return out

    def _joined(self, words: pa.Array) -> list[np.ndarray]:
        coded = words.flatten().dictionary_encode()
        code, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        begins = words.offsets.to_numpy().astype(np.int64)
        begins = begins - begins[0]
        breaks = code == (names.index("\n") if "\n" in names else -1)
        first = breaks.copy()  # words without a space before them
        first[begins[:-1]] = True
        first[1:] |= breaks[:-1]
        kind = 2 * code + first
        kinds = np.flatnonzero(np.bincount(kind, minlength=2 * len(names)))
        made = [(self.plain if k & 1 else self.spaced)[names[k >> 1]] for k in kinds.tolist()]
        pool = np.frombuffer(b"".join(made), np.uint32)
        sizes = np.zeros(2 * len(names), np.int64)
        sizes[kinds] = np.fromiter(map(len, made), np.int64, len(made)) // 4
        starts = np.cumsum(sizes) - sizes
        n = sizes[kind]
        ends = np.cumsum(n)
        ids = pool[np.arange(ends[-1] if len(ends) else 0, dtype=np.int32) + np.repeat((starts[kind] - (ends - n)).astype(np.int32), n)]
        cuts = np.concatenate([[0], ends])[begins]
        return [ids[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]

    def __call__(self, text: str | None) -> np.ndarray:
        return self.batch(pa.array([text], pa.string()))[0]


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


@lru_cache(maxsize=2)
def vocabulary_size(path: str) -> int:
    return library_encoder(path).tokenizer.get_vocab_size()


FILE_SCHEMA = "shard int, first long, doc_ids array<long>, n_ids long, data binary"
_ARROW = pa.schema(
    [("shard", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("data", pa.binary())]
)


def packed_segments(
    docs: DataFrame, encoder: Callable[[], Callable[[pa.Array], list[np.ndarray]]], width: int, end_id: int, shards: int
) -> DataFrame:
    """Segments in ascending order of doc_id; ``first`` counts the ids before a segment in its shard.

    Texts move once, to the range of ids they belong to, and are tokenised there.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("row")]  # the row, lest equal rows meet in one shard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, before = encoder(), TaskContext.get().partitionId(), 0
        names: list = []
        held: list[np.ndarray] = []
        n = 0

        def segment() -> pa.RecordBatch:
            arrays = [[shard], [before], [names], [n], [write_segment(held, width)]]
            return pa.record_batch([pa.array(a, f.type) for a, f in zip(arrays, _ARROW)], schema=_ARROW)

        for batch in (part for whole in batches for part in bounded(whole)):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                ids = np.append(ids, np.uint32(end_id))
                if held and n + len(ids) > SEGMENT_IDS:
                    yield segment()
                    give_back()
                    before, names, held, n = before + n, [], [], 0
                names.append(doc_id)
                held.append(ids)
                n += len(ids)
        if held:
            yield segment()

    keyed = with_row_key(docs.select("doc_id", "text"), "row")
    ranged = keyed.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    return ranged.select("doc_id", "text").mapInArrow(run, FILE_SCHEMA)


def read_packed(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read from the files' segments."""
    spark = segments.sparkSession
    totals = sorted((r.shard, r.n) for r in segments.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())  # a row a file
    bases = accumulate([n for _, n in totals], initial=0)
    base = local_table(spark, ("b_shard", "base"), [(shard, b) for (shard, _), b in zip(totals, bases)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                segment = Segment(batch.column("data")[k].as_py())
                ids = segment.range(0, segment.n_ids).astype("<u4")
                cuts = segment.starts
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
                columns = [
                    pa.array(batch.column("doc_ids")[k].as_py(), pa.int64()),
                    pa.array(cuts[:-1] + batch.column("start")[k].as_py()),
                    pa.array(np.diff(cuts)),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.record_batch(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = segments.join(F.broadcast(base), F.col("shard") == F.col("b_shard"))
    placed = placed.select("doc_ids", (F.col("first") + F.col("base")).alias("start"), "data")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_library_ids(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Tokenise with the library, write the files to the shared folder, and give them to read."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    shards = max(-(-size // SHARD_BYTES), 4 * docs.sparkSession.sparkContext.defaultParallelism)
    width = width_of(vocabulary_size(path))
    with arrow_batches(docs.sparkSession, size=4 << 20):
        return settle(packed_segments(docs, lambda: library_encoder(path).batch, width, end_id, shards))


def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return read_packed(write_library_ids(table(spark, sf_dir, "documents"), path, 2))
