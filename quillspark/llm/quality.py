"""Quality rules, judged by an isolation forest on the rules' statistics.

Each document gets a few counts (words, symbols, repeated lines, repeated word
windows) and ratios of them. Random trees split the ratios of the labelled rows
at random; a document that few splits suffice to isolate is anomalous. The
threshold on that anomaly is the one that tells the labels apart best, with a
false rejection weighing more than a false keep.

Every labelled row that passes the base rules counts, in the choice of ratios, in
every tree and in the threshold: trees grow a level at a time, each level by one
pass over the labelled rows' ratios that gives the number and range of the rows
in every node; the threshold is the best of STEPS even steps, by counts of all
rows in each. The driver gets a row a node or step, and only the forest's arrays
are sent to tasks. Statistics and verdicts cover every document.

Edge cases: a null text has no words and fails the base rules, as an empty one
does; repeated rows get equal verdicts; an empty table gives an empty result;
without labels of both kinds only the base rules decide; rows of labels that
are null take no part. Extra columns are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import bounded, discard, map_batches, settle, table

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: A false rejection counts as so many false keeps.
REJECTION_COST = 10

#: Standard deviations of good rows by which the mean of rejected rows must lead for a ratio to be used.
LEAST_LEAD = 1.0

#: Splits on a path are bounded as for so many rows; steps of the anomaly; labelled rows that a task looks at, about.
MOST_SPLIT, STEPS, ROWS_A_TASK = 256, 1 << 16, 20_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("symbols", "dup_lines", "repeats", "capitals", "marks")
#: Ratios are taken over so many letters, lines or words more, lest chance makes short texts look odd.
EASE_LETTERS, EASE_LINES, EASE_WORDS = 100, 8, 20
MEASURED = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean"

#: Of nodes: how many rows each has, and the least and greatest values of its rows.
Extents = tuple[np.ndarray, np.ndarray, np.ndarray]

_SPACES = np.array([9, 10, 11, 12, 13, 32])
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_MARKS = np.frombuffer(b"!?~^", np.uint8)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of five that occur at least twice in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == n:
        return 0
    times, covered = Counter(windows), bytearray(len(words))
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered[i : i + WINDOW] = b"\1" * WINDOW
    return covered.count(1)


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The COUNTS and RATIOS of one whole text."""
    raw = (text or "").encode()
    words = raw.split()  # splits bytes at ASCII white space alone
    seen: set[bytes] = set()
    lines = dup_lines = 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            if line in seen:
                dup_lines += 1
            else:
                seen.add(line)
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = len(raw) - int(by_byte[0x80:0xC0].sum()) - int(by_byte[_SPACES].sum())
    symbols, repeats = int(by_byte[_SYMBOLS].sum()), repeated_words(words)
    n, capitals = len(words), int(by_byte[65:91].sum())
    letters = capitals + int(by_byte[97:123].sum())
    return [n, chars, symbols, dup_lines, repeats], [
        symbols / (chars + EASE_LETTERS), dup_lines / (lines + EASE_LINES), repeats / (n + EASE_WORDS),
        capitals / (letters + EASE_LETTERS), int(by_byte[_MARKS].sum()) / (n + EASE_WORDS),
    ]


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


def _mean_path(n: np.ndarray | float) -> np.ndarray | float:
    """Mean depth of an unsuccessful search among n points."""
    n = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n, 1.0)


@dataclass
class IsolationForest:
    """Trees as arrays: node i splits feature[i] at value[i]; a leaf has feature -1 and its path length in value."""

    feature: np.ndarray
    value: np.ndarray
    child: np.ndarray
    sample: int
    used: np.ndarray
    threshold: float = np.inf

    @staticmethod
    def fit(extents: Callable[["IsolationForest", np.ndarray], Extents], n: int, used: np.ndarray, trees: int = 128, seed: int = 7) -> "IsolationForest":
        """Trees of all n rows over the columns used, a level at a time.

        ``extents`` takes the forest so far and the slots of the nodes (tree, node) to look at, -1 elsewhere, and tells
        how many rows are in each and their least and greatest values.
        """
        rng = np.random.default_rng(seed)
        depth = max(1, int(np.ceil(np.log2(max(2, min(MOST_SPLIT, n))))) + 2)
        size = 2 ** (depth + 1) - 1
        forest = IsolationForest(np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size), int), n, used)
        tree, node = np.arange(trees), np.zeros(trees, int)
        for level in range(depth + 1):
            slots = np.full((trees, size), -1)
            slots[tree, node] = np.arange(len(tree))
            rows, low, high = extents(forest, slots)
            spread = (high > low) & (rows > 1)[:, None] & (level < depth)
            forest.value[tree, node] = level + np.where(rows > 1, _mean_path(rows), 0)
            f = np.argsort(np.where(spread, rng.random(spread.shape), 2), axis=1)[:, 0]
            every = np.arange(len(tree))
            cut = low[every, f] + rng.random(len(tree)) * (high[every, f] - low[every, f])
            open_ = spread.any(1)
            tree, node, f, cut = tree[open_], node[open_], f[open_], cut[open_]
            if not len(tree):
                break
            forest.feature[tree, node], forest.value[tree, node], forest.child[tree, node] = f, cut, 2 * node + 1
            tree, node = np.repeat(tree, 2), np.stack([2 * node + 1, 2 * node + 2], 1).ravel()
        return forest

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The node of each tree that each row ends in."""
        x = x[:, self.used]
        trees = np.arange(len(self.feature))[:, None]
        node = np.zeros((len(self.feature), len(x)), int)
        while True:
            f = self.feature[trees, node]
            if (f < 0).all():
                return node
            right = x[np.arange(len(x))[None, :], f] > self.value[trees, node]
            node = np.where(f < 0, node, self.child[trees, node] + right)

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, higher: fewer splits isolate the row."""
        trees = np.arange(len(self.feature))[:, None]
        return 2 ** (-self.value[trees, self.leaves(x)].mean(0) / float(_mean_path(self.sample)))

    def extents(self, x: np.ndarray, slots: np.ndarray) -> Extents:
        """Of the nodes with slots: how many of the rows x are in each, and their least and greatest values."""
        n = int(slots.max()) + 1
        count, low, high = np.zeros(n, np.int64), np.full((n, len(self.used)), np.inf), np.full((n, len(self.used)), -np.inf)
        at = slots[np.arange(len(slots))[:, None], self.leaves(x)].ravel()
        rows = np.tile(np.arange(len(x)), len(slots))[at >= 0]
        at = at[at >= 0]
        if len(at):
            order = np.argsort(at, kind="stable")
            at, values = at[order], x[:, self.used][rows[order]]
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            count[at[first]] = np.diff(np.append(first, len(at)))
            low[at[first]], high[at[first]] = np.minimum.reduceat(values, first), np.maximum.reduceat(values, first)
        return count, low, high

    def calibrate(self, good: np.ndarray, bad: np.ndarray) -> None:
        """Reject from the step of anomaly on that costs least, good and bad rows being counted by step; never, without both labels."""
        if not good.any() or not bad.any():
            self.threshold = np.inf
            return
        cost = np.append(REJECTION_COST * good[::-1].cumsum()[::-1], 0) + np.insert(bad.cumsum(), 0, 0)
        k = int(np.argmin(cost))
        if k == STEPS:
            self.threshold = np.inf
            return
        same = np.flatnonzero(cost[k:] != cost[k])
        last = k + int(same[0]) - 1 if len(same) else STEPS  # steps without rows: cut half way
        self.threshold = (k + last) // 2 / STEPS


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and the ratios of every document."""

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = [statistics(t) for t in batch.column("text").to_pylist()]
        counts = np.array([c for c, _ in both], np.int64).reshape(-1, len(COUNTS))
        ratios = pa.array([r for _, r in both], pa.list_(pa.float64()))
        columns = [batch.column("doc_id"), *(pa.array(c) for c in counts.T), pa.array(base_failed(counts)), ratios]
        return pa.record_batch(columns, ["doc_id", *COUNTS, "base_failed", "ratios"])

    return map_batches(docs.select("doc_id", "text"), measure, f"{MEASURED}, ratios array<double>")


def _ratios(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("ratios").to_pylist(), float).reshape(-1, len(RATIOS))


def _labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """good and ratios of every labelled row that passes the base rules, dealt out evenly and settled."""
    wanted = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").alias("l_id"), "quality").distinct()
    least = stats.where("NOT base_failed").groupBy("doc_id").agg(F.min("ratios").alias("ratios"))  # the least, where an id repeats
    rows = least.join(wanted, F.col("doc_id") == F.col("l_id"))
    tasks = max(stats.sparkSession.sparkContext.defaultParallelism, labels.count() // ROWS_A_TASK)
    return settle(rows.select((F.col("quality") == 1).alias("good"), "ratios", "doc_id").repartition(tasks, "doc_id").drop("doc_id"))


def informative(rows: DataFrame) -> np.ndarray:
    """Ratios whose mean over rejected rows is well above that over good rows; all, without both."""
    each = [f(F.get("ratios", F.lit(i))) for f in (F.avg, F.stddev_pop) for i in range(len(RATIOS))]
    by_kind = {good: np.array(rest) for good, *rest in rows.groupBy("good").agg(*each).collect()}
    every = np.arange(len(RATIOS))
    if len(by_kind) < 2:
        return every
    mean, spread = by_kind[True][: len(RATIOS)], by_kind[True][len(RATIOS) :]
    chosen = np.flatnonzero(by_kind[False][: len(RATIOS)] - mean > LEAST_LEAD * (spread + 1e-9))
    return chosen if len(chosen) else every


def _extents(rows: DataFrame, forest: IsolationForest, slots: np.ndarray) -> Extents:
    """The forest's extents over all rows; each task hands on a row a node at most."""
    n, width = int(slots.max()) + 1, len(forest.used)
    sent = rows.sparkSession.sparkContext.broadcast((forest, slots))
    bounds = [f"{side}{i}" for side in ("low", "high") for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, slots = sent.value
        count, low, high = np.zeros(n, np.int64), np.full((n, width), np.inf), np.full((n, width), -np.inf)
        for batch in batches:
            for part in bounded(batch):
                c, a, b = forest.extents(_ratios(part), slots)
                count, low, high = count + c, np.minimum(low, a), np.maximum(high, b)
        at = np.flatnonzero(count)
        columns = [at, count[at], *low[at].T, *high[at].T]
        yield pa.record_batch([pa.array(c) for c in columns], ["slot", "n", *bounds])

    schema = "slot long, n long, " + ", ".join(f"{b} double" for b in bounds)
    by_slot = rows.select("ratios").mapInArrow(run, schema).groupBy("slot")
    got = by_slot.agg(F.sum("n"), *(F.min(b) if b.startswith("low") else F.max(b) for b in bounds)).toArrow()
    sent.destroy()
    slot, count, *ends = (c.to_numpy() for c in got.columns)
    whole, low, high = np.zeros(n, np.int64), np.zeros((n, width)), np.zeros((n, width))  # no spread where no row is
    whole[slot], low[slot], high[slot] = count, np.stack(ends[:width], 1), np.stack(ends[width:], 1)
    return whole, low, high


def _by_step(rows: DataFrame, forest: IsolationForest) -> tuple[np.ndarray, np.ndarray]:
    """How many good and how many rejected rows have their anomaly in each of STEPS steps."""
    sent = rows.sparkSession.sparkContext.broadcast(forest)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        steps = np.minimum((sent.value.score(_ratios(batch)) * STEPS).astype(np.int64), STEPS - 1)
        return pa.record_batch([pa.array(steps), batch.column("good")], ["step", "good"])

    got = map_batches(rows, run, "step long, good boolean").groupBy("step", "good").agg(F.count("*").alias("n")).collect()
    sent.destroy()
    good, bad = np.zeros(STEPS, np.int64), np.zeros(STEPS, np.int64)
    for r in got:
        (good if r.good else bad)[r.step] = r.n
    return good, bad


def fit_measured(stats: DataFrame, labels: DataFrame, seed: int = 7) -> IsolationForest | None:
    """The forest of every labelled row of ``measured`` documents that passes the base rules; None without any."""
    rows = _labelled(stats, labels)
    n = rows.count()
    forest = None
    if n:
        forest = IsolationForest.fit(lambda grown, slots: _extents(rows, grown, slots), n, informative(rows), seed=seed)
        forest.calibrate(*_by_step(rows, forest))
    discard(rows)
    return forest


def fit_forest(docs: DataFrame, labels: DataFrame, seed: int = 7) -> IsolationForest | None:
    """The forest of every labelled document that passes the base rules; None without any."""
    stats = settle(measured(docs))
    forest = fit_measured(stats, labels, seed)
    discard(stats)
    return forest


def judge(forest: IsolationForest | None, failed: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """kept and anomaly, from the base rules' verdict and the ratios."""
    anomaly = forest.score(ratios) if forest and len(ratios) else np.zeros(len(ratios))
    return ~failed & (anomaly < (forest.threshold if forest else np.inf)), anomaly


def quality_report(docs: DataFrame, labels: DataFrame, seed: int = 7) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the anomaly of every document."""
    stats = settle(measured(docs))
    forest = docs.sparkSession.sparkContext.broadcast(fit_measured(stats, labels, seed))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, anomaly = judge(forest.value, np.array(batch.column("base_failed").to_pylist(), bool), _ratios(batch))
        columns = [*batch.columns[:-1], pa.array(kept), pa.array(anomaly)]
        return pa.record_batch(columns, ["doc_id", *COUNTS, "base_failed", "kept", "anomaly"])

    return map_batches(stats, run, f"{MEASURED}, kept boolean, anomaly double")


def keep_good(docs: DataFrame, labels: DataFrame, seed: int = 7) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    forest = docs.sparkSession.sparkContext.broadcast(fit_forest(docs, labels, seed))
    at = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = [statistics(t) for t in batch.column(at).to_pylist()]
        counts = np.array([c for c, _ in both], np.int64).reshape(-1, len(COUNTS))
        ratios = np.array([r for _, r in both]).reshape(-1, len(RATIOS))
        return batch.filter(pa.array(judge(forest.value, base_failed(counts), ratios)[0]))

    return map_batches(docs, run, docs.schema)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
