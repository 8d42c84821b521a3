"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text.
The trainer picks the most frequent stretches of its samples, and in whole
documents of either class these are the same common syllables; it then tells the
classes apart badly (area under the curve 0.60 to 0.69, see README). So its
samples are windows of TRAIN_WORDS words drawn, in a seeded order, from the
places of words: on the toxic side of those words that stand in far more
different places in toxic than in ordinary documents, on the ordinary side of
all words. Behind what was trained, both dictionaries hold the same stretch of
ordinary words, so that these compress alike under either.

A document's windows of WINDOW_WORDS words, put between two stretches that both
dictionaries know, are compressed under each; a window's gain is the length under
the ordinary dictionary less that under the toxic one. The gains are summed up in
a few features, and a logistic curve fitted on the labelled rows turns these into
the score, which so is 0.5 where the labelled rows are told apart best.

The sample has ``max_labelled`` rows at most, chosen by a hash of their ids, and
never one of the held-out fold; their whole texts are reduced to pairs of words,
and later to features, in the executors. Every document is scored over its whole
text.

Edge cases: a null or empty text has no windows and gets the score of no gain;
repeated rows get equal scores; where a labelled id stands on several texts, the
least text is learnt from; without labels of both kinds every score is 0; a null
id is not held out; labels that are null take no part; an empty table gives an
empty result; extra columns are left alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.chunks import PieceMemory
from quillspark.llm.common import discard, map_batches, settle, table

FOLDS, LONGEST_WORD = 5, 64
#: Words of a window that is scored and of a sample to train on, how often each place is dealt to a sample.
WINDOW_WORDS, TRAIN_WORDS, PASSES = 2, 8, 8
#: The trainer's segments and the strings by which it scores them; a dictionary's size against its telling words.
SEGMENT_BYTES, SCORED_BYTES, SIZE_FACTOR, LEAST_SIZE = 16, 6, 5, 1024
#: Both dictionaries end with so many bytes of ordinary words; a window stands between stretches of these lengths.
SHARED_BYTES, BEFORE_BYTES, AFTER_BYTES = 24_000, 200, 24
#: A telling word stands in so many different places at least (more of them, the more toxic texts there are to
#: a place), and so many times as often as in ordinary text; ordinary places are sampled.
LEAST_PLACES, TEXTS_A_PLACE, LEAST_RATIO, MOST_WORDS, ORDINARY_PLACES = 3, 80, 20, 4_000, 40_000
#: Gains below this are chance matches.
LEAST_GAIN = 3
_LEVEL, _MIN_MATCH, _EASE = 3, 4, 30
#: Documents are told apart by how many windows gain at least so much.
STEPS = (3, 4, 5, 6, 8)


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case; longer ones than LONGEST_WORD bytes in pieces."""
    words = (text or "").encode().lower().split()
    if max(map(len, words), default=0) <= LONGEST_WORD:
        return words
    return [w[i : i + LONGEST_WORD] for w in words for i in range(0, len(w), LONGEST_WORD)]


def windows_of(words: list[bytes], n: int = WINDOW_WORDS) -> list[bytes]:
    """A text's windows of n words, one behind the other; the last one may be shorter."""
    whole = len(words) - len(words) % n
    made = list(map(b" ".join, zip(*(words[i:whole:n] for i in range(n)))))
    return made + [b" ".join(words[whole:])] * (whole < len(words))


def samples(words: list[bytes], seed: int) -> list[bytes]:
    """PASSES times the words in another order, cut to samples of TRAIN_WORDS."""
    rng, made = np.random.default_rng(seed), []
    for _ in range(PASSES):
        order = rng.permutation(len(words)).tolist()
        for k in range(0, len(order), TRAIN_WORDS):
            made.append(b" " + b" ".join([words[i] for i in order[k : k + TRAIN_WORDS]]) + b" ")
    return made


def trained(words: list[bytes], size: int, seed: int = 9) -> bytes:
    """A dictionary of zstandard's trainer; of too little text to train on, the text itself."""
    made = samples(words, seed)
    try:
        return zstandard.train_dictionary(size, made, k=SEGMENT_BYTES, d=SCORED_BYTES).as_bytes()
    except zstandard.ZstdError:
        return b"".join(made)[-size:]


@dataclass
class CompressionDistance:
    """The two dictionaries' bytes and the logistic curve over features."""

    toxic: bytes
    ordinary: bytes
    before: bytes
    after: bytes
    curve: np.ndarray = field(default_factory=lambda: np.zeros(len(STEPS) + 4))

    @staticmethod
    def train(telling: list[tuple[bytes, int]], ordinary: list[bytes]) -> "CompressionDistance":
        """Dictionaries from telling words with their places, and from a sample of ordinary places' words."""
        size = max(LEAST_SIZE, SIZE_FACTOR * sum(len(w) + 1 for w, _ in telling))
        shared = b" ".join(ordinary)[:SHARED_BYTES]
        toxic = [w for w, places in telling for _ in range(places)]
        both = [trained(words, size) + b" " + shared if words else b"" for words in (toxic, ordinary)]
        return CompressionDistance(*both, shared[-BEFORE_BYTES:], shared[:AFTER_BYTES])

    def _compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        parameters = zstandard.ZstdCompressionParameters.from_level(
            _LEVEL, min_match=_MIN_MATCH, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(compression_params=parameters, dict_data=made)

    def gains(self) -> PieceMemory:
        """Gain by window, remembered within bounds."""
        if min(len(self.toxic), len(self.ordinary)) < 8:
            return PieceMemory(lambda window: 0)
        toxic, ordinary = self._compressor(self.toxic).compress, self._compressor(self.ordinary).compress
        before, after = self.before + b" ", b" " + self.after

        def gain(window: bytes) -> int:
            framed = before + window + after
            return len(ordinary(framed)) - len(toxic(framed))

        return PieceMemory(gain)

    @staticmethod
    def features(gains: PieceMemory, words: list[bytes]) -> list[float]:
        windows = windows_of(words)
        g = np.fromiter(map(gains.__getitem__, windows), np.int64, len(windows))
        strong = g[g >= LEAST_GAIN]
        per_word = float((strong - 1).sum()) / (len(g) + _EASE)
        above = [float(np.log1p((strong >= step).sum())) for step in STEPS]
        return [1.0, per_word**0.5, float(np.log1p(len(g))) / 8, min(8.0, float(strong.max(initial=0))) / 8, *above]

    def scores(self, gains: PieceMemory, texts: list[list[bytes]]) -> np.ndarray:
        x = np.array([self.features(gains, t) for t in texts]).reshape(-1, len(self.curve))
        return 1 / (1 + np.exp(-np.clip(x @ self.curve, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 60) -> np.ndarray:
    """Weights of a logistic curve, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step / max(1.0, np.abs(step).max() / 4)
    return w


def labelled_rows(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """doc_id, toxic and text of at most max_labelled labelled rows outside the held-out fold."""
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    chosen = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(fold != 0)
        .select(F.col("doc_id").alias("l_id"), F.col("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("l_id"), "l_id", "toxic")
        .limit(max_labelled)
    )
    # The ids sent to every task number max_labelled at most.
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
    return labelled.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def word_places(labelled: DataFrame) -> DataFrame:
    """toxic, word, before: the different places of words in the texts of either class; copies of a text add none."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text)
            pairs = sorted(set(zip(words, [b"", *words])))
            columns = [pa.array([toxic] * len(pairs), pa.int32()), *(pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1))]
            yield pa.record_batch(columns, ["toxic", "word", "before"])

    return map_batches(labelled.select("toxic", "text"), run, "toxic int, word binary, before binary").distinct()


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 8_000) -> CompressionDistance | None:
    """Fit on at most max_labelled labelled rows outside the held-out fold; None without both labels."""
    labelled = settle(labelled_rows(docs, labels, max_labelled))
    texts = {r.toxic: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    if len(texts) < 2:
        return None
    places = settle(word_places(labelled))
    is_toxic = F.col("toxic") == 1
    n = places.agg(F.count_if(is_toxic).alias("toxic"), F.count_if(~is_toxic).alias("ordinary")).head()
    by_word = places.groupBy("word").agg(F.count_if(is_toxic).alias("toxic"), F.count_if(~is_toxic).alias("ordinary"))
    ratio = F.col("toxic") * (n.ordinary or 1) / ((F.col("ordinary") + 0.5) * (n.toxic or 1))
    least = max(LEAST_PLACES, texts.get(1, 0) / TEXTS_A_PLACE)
    telling = by_word.where((F.col("toxic") >= least) & (F.length("word") > 2) & (ratio >= LEAST_RATIO))
    telling = telling.orderBy(ratio.desc(), "word").limit(MOST_WORDS).collect()
    ordinary = places.where(~is_toxic).orderBy(F.xxhash64("word", "before"), "word", "before").limit(ORDINARY_PLACES).select("word").collect()
    model = CompressionDistance.train([(bytes(r.word), r.toxic) for r in telling], [bytes(r.word) for r in ordinary])
    measured = with_features(labelled, model).orderBy("doc_id", "toxic").collect()  # a short row a labelled document
    model.curve = logistic(np.array([r.features for r in measured]), np.array([r.toxic for r in measured], float))
    discard(labelled, places)
    return model


def with_features(labelled: DataFrame, model: CompressionDistance) -> DataFrame:
    """doc_id, toxic and the features of each labelled row."""
    sent = labelled.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        gains = sent.value.gains()
        made = [CompressionDistance.features(gains, words_of(t)) for t in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("doc_id"), batch.column("toxic"), pa.array(made, pa.list_(pa.float64()))], ["doc_id", "toxic", "features"])

    return map_batches(labelled.select("doc_id", "toxic", "text"), run, "doc_id long, toxic int, features array<double>")


def score_toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = 8_000) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, max_labelled))
    held: dict = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = sent.value
        texts = [words_of(t) for t in batch.column("text").to_pylist()]
        if model is None:
            scores = np.zeros(len(texts))
        else:
            if "gains" not in held:
                held["gains"] = model.gains()
            scores = model.scores(held["gains"], texts)
        ids = batch.column("doc_id").to_pylist()
        out = [i is not None and zlib.crc32(str(i).encode()) % FOLDS == 0 for i in ids]
        columns = [batch.column("doc_id"), pa.array(out), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
        return pa.record_batch(columns, ["doc_id", "held_out", "score", "predicted"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, held_out boolean, score double, predicted int")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
