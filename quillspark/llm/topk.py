"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector is a sparse row of integer weights, one term a component. Candidates
are cut into blocks; a block keeps, for each term, its postings (rows and
weights). For a block of queries every term's postings are scattered, times the
queries' weights, into a dense array of scores, so each pair of query and
candidate is scored over all its terms. A partition selection keeps the k best
of each block, and the blocks' lists are merged.

Every block of queries meets every block of candidates exactly once. Blocks are
rows of packed arrays, and a task takes a group of either kind, GROUP_BLOCKS at
most: so a block travels once for each group of the other kind and not for each
block, and no pair of single rows is ever written out.

Edge cases: vectors that are null, or hold null or non-finite components, take
no part; components a shorter vector lacks count as zero; a null id is never a
query and loses ties; rows with an id in common are distinct candidates, and a
query passes over its own row alone; fewer candidates than k are all returned;
an empty table gives an empty result; extra columns are left alone. Weights and
scores are 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import settle, table, with_row_key

QUERY_BLOCK, CANDIDATE_BLOCK, GROUP_BLOCKS = 512, 4096, 16
_NO_ID = np.iinfo(np.int64).max


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (row, id, weights) of a partition packed to blocks: n, width, rows, ids, weights as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, size) for b in batches for at in range(0, b.num_rows, size)):
            weights = batch.column("weights").to_pylist()
            width = max((len(w) for w in weights), default=0)
            dense = np.zeros((len(weights), width), "<i8")
            for i, w in enumerate(weights):
                dense[i, : len(w)] = w
            ids = batch.column("id").fill_null(_NO_ID).to_numpy().astype("<i8")
            keys = batch.column("row").to_numpy().astype("<i8")
            columns = [[len(weights)], [width], [keys.tobytes()], [ids.tobytes()], [dense.tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["n", "width", "rows", "ids", "weights"])

    return settle(rows.mapInArrow(run, "n int, width int, rows binary, ids binary, weights binary"))


_BLOCK = ["n", "width", "rows", "ids", "weights"]


def _opened(n: int, width: int, rows: bytes, ids: bytes, weights: bytes):
    return np.frombuffer(rows, "<i8"), np.frombuffer(ids, "<i8"), np.frombuffer(weights, "<i8").reshape(n, width)


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of all rows, accumulated term by term over the candidates' postings."""
    total = np.zeros((len(queries), len(candidates)), np.int64)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        asking = np.flatnonzero(queries[:, term])
        posting = np.flatnonzero(candidates[:, term])
        if not len(asking) or not len(posting):
            continue
        added = np.multiply.outer(queries[asking, term], candidates[posting, term])
        if len(asking) == len(queries) and len(posting) == len(candidates):
            total += added
        else:
            total[np.ix_(asking, posting)] += added
    return total


def best(total: np.ndarray, ids: np.ndarray, skip: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row the columns of the k highest scores, ties to the smaller id; where skip is true, none."""
    low = np.iinfo(np.int64).min
    total = np.where(skip, low, total)
    n = total.shape[1]
    edge = np.partition(total, n - k, axis=1)[:, n - k] if n > k else np.full(len(total), low)
    chosen = []
    for i, row in enumerate(total):
        at = np.flatnonzero((row >= edge[i]) & ~skip[i])
        chosen.append(at[np.lexsort((ids[at], -row[at]))[:k]])
    return chosen


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id and score of the k best for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    keyed = with_row_key(vectors.select("vec_id", "embedding"), "row")
    whole = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    weights = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = keyed.where(F.col("embedding").isNotNull()).where(whole).select("row", F.col("vec_id").alias("id"), weights.alias("weights"))
    candidates = _blocks(rows, CANDIDATE_BLOCK)
    queries = _blocks(rows.where(F.col("id") % every == 0), QUERY_BLOCK)
    # Groups of blocks: as few as their bound allows, but a task for each core where there are blocks enough.
    n_candidates, n_queries = candidates.count(), queries.count()
    c_groups = max(1, -(-n_candidates // GROUP_BLOCKS), min(n_candidates, spark.sparkContext.defaultParallelism))
    q_groups = max(1, -(-n_queries // GROUP_BLOCKS))

    def dealt(blocks: DataFrame, own: str, groups: int, other: str, others: int) -> DataFrame:
        group = F.pmod(F.xxhash64("rows", "ids"), F.lit(groups)).cast("int")
        return blocks.withColumn(own, group).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks = [_opened(**block) for block in left.select(_BLOCK).to_pylist()]
        found = []
        for block in right.select(_BLOCK).to_pylist():
            q_rows, q_ids, q = _opened(**block)
            for c_rows, c_ids, c in blocks:
                total = scores(q, c)
                chosen = best(total, c_ids, q_rows[:, None] == c_rows[None, :], k)
                owner = np.repeat(np.arange(len(q)), [len(f) for f in chosen])
                at = np.concatenate(chosen) if chosen else np.zeros(0, int)
                found.append(np.stack([q_rows[owner], q_ids[owner], c_ids[at], c_rows[at], total[owner, at]]))
        made = np.concatenate([np.zeros((5, 0), np.int64), *found], axis=1)
        order = np.lexsort((made[3], made[2], -made[4], made[0]))  # merge: by query, then score, id and row
        made = made[:, order]
        first = np.flatnonzero(np.diff(made[0], prepend=-1))
        place = np.arange(made.shape[1]) - np.repeat(first, np.diff(first, append=made.shape[1]))
        return pa.table([pa.array(c, pa.int64()) for c in made[:, place < k]], ["q_row", "query_id", "id", "row", "score"])

    left, right = dealt(candidates, "c", c_groups, "q", q_groups), dealt(queries, "q", q_groups, "c", c_groups)
    schema = "q_row long, query_id long, id long, row long, score long"
    partial = left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(run, schema)
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "id", "row")
    merged = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    vec_id = F.when(F.col("id") != int(_NO_ID), F.col("id"))
    return merged.select("query_id", "rank", vec_id.alias("vec_id"), "score")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score, c.rid AS crid
  FROM kept q JOIN kept c ON q.vec_id % 50 = 0 AND q.rid <> c.rid
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST, crid) AS rank FROM scored
) WHERE rank <= 5
"""
