"""Links between texts of similar shingle sets: what SimHash leaves open at a given similarity.

Two texts are linked when their sets of shingles have a Jaccard similarity of
SIMILARITY (4/5) or more. At an affordable radius SimHash finds few such pairs,
so the rest is searched exactly, by what texts share of their sets:

1. In the order of hashes the first n - ceil(4n/5) + n/5 of n shingles hold at
   least n/5 that a similar set has among its own first ones. A text whose prefix
   holds too few shingles that other prefixes hold as well has no similar text.
2. Of the whole sets of the texts left, ceil(4n/5) shingles must be in others'
   sets. That is counted twice, as texts drop out; texts that share no more than
   passages with others are gone then.
3. Of a text's shared shingles, rare ones first, all but ceil(4n/5) - 1 are its
   keys: similar texts have one in common. Keys whose texts SimHash has joined
   already are passed over.
4. Texts tied by keys make clusters; a text goes to its cluster's task once, with
   its set, and is compared there with the others. Clusters of more than
   MOST_SETS texts are dealt out in blocks, each pair of which meets in one task.

No pair is lost, and nothing but a spanning forest of the links leaves a task.
Texts have sets as ``shingle_set`` makes them, equal sets are folded before; null
and empty texts have the empty set.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import discard, join_counted, map_batches, release, settle
from quillspark.llm.components import smallest_reachable

#: The least similarity, as a fraction.
SIMILARITY = (4, 5)
#: Rows whose hashes a Python worker holds at once; texts of one block of a cluster; rows a shard should hold.
SLICE, MOST_SETS, SHARD_ROWS = 128, 1024, 1024
ROUNDS, _CHUNK = 2, 1 << 16


def shingle_set(text: str | None, width: int, seed: int) -> np.ndarray:
    """The distinct hashes of a whole text's shingles as signed longs, in order."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.int64)
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, seed) for s in shingles], np.uint64).view(np.int64))


def majority(hashes: np.ndarray) -> int:
    """The SimHash of hashes: a bit is set if over half of them have it; as a signed long."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        bits = np.unpackbits(hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def least_overlap(n: int | Column) -> int | Column:
    """Of n shingles, so many a similar set has too: ceil(4n/5)."""
    part, whole = SIMILARITY
    if isinstance(n, Column):
        return F.floor((n * part + whole - 1) / whole)
    return -(-part * n // whole)


def assured(n: int | Column) -> int | Column:
    """So many shared shingles the prefix of n holds."""
    return F.greatest(F.lit(1), F.floor(n / 5)) if isinstance(n, Column) else max(1, n // 5)


def prefix_length(n: int) -> int:
    return min(n, n - least_overlap(n) + assured(n)) if n else 0


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _sliced(one: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    """The function over a few rows at a time, as hashes take more memory than texts."""
    return lambda batch: (one(batch.slice(at, SLICE)) for at in range(0, batch.num_rows, SLICE))


def set_prefixes(keyed: DataFrame, width: int, seed: int) -> DataFrame:
    """row, doc_id, digest of the set, its size n, prefix and fingerprint of every document."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, width, seed) for t in batch.column("text").to_pylist()]
        prints = pa.array([majority(s) for s in sets], pa.int64())
        digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
        prefixes = _lists([s[: prefix_length(len(s))] for s in sets])
        columns = [batch.column("row"), batch.column("doc_id"), digests, pa.array([len(s) for s in sets], pa.int32()), prefixes, prints]
        return pa.record_batch(columns, ["row", "doc_id", "digest", "n", "prefix", "fp"])

    kinds = dict(keyed.dtypes)
    schema = f"row long, doc_id {kinds['doc_id']}, digest binary, n int, prefix array<long>, fp long"
    return map_batches(keyed.select("row", "doc_id", "text"), _sliced(one), schema)


def whole_sets(keyed: DataFrame, width: int, seed: int) -> DataFrame:
    """row and the whole set of every document."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, width, seed) for t in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("row"), _lists(sets)], ["row", "whole"])

    return map_batches(keyed.select("row", "text"), _sliced(one), "row long, whole array<long>")


def similar_pairs(pairs: DataFrame, keyed: DataFrame, width: int, seed: int) -> DataFrame:
    """The pairs (a, b) of rows whose whole sets are similar, settled."""
    part, whole = SIMILARITY
    named = pairs.select(F.col("a").alias("row")).union(pairs.select(F.col("b").alias("row"))).distinct()
    sets = settle(whole_sets(keyed.join(named, "row", "left_semi"), width, seed))
    one, two = (sets.select(F.col("row").alias(c), F.col("whole").alias(f"whole_{c}")) for c in "ab")
    common = F.size(F.array_intersect("whole_a", "whole_b"))
    either = F.size("whole_a") + F.size("whole_b") - common
    found = settle(pairs.join(one, "a").join(two, "b").where(common * whole >= either * part).select("a", "b"))
    discard(sets)
    return found


def _shared(rows: DataFrame, needed: Column) -> DataFrame:
    """row, n, shingle and held (how many rows hold it) of rows (row, n, shingle) with enough shingles that others hold too, settled."""
    counts = settle(rows.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").withColumn("held", F.col("n")))
    left = rows.select("row", F.col("n").alias("size"), "shingle")
    shared = settle(join_counted(left, counts, ["shingle"], ["row"]).withColumnRenamed("size", "n"))
    enough = shared.groupBy("row", "n").agg(F.count("*").alias("times")).where(F.col("times") >= needed).select("row")
    kept = settle(shared.join(enough, "row", "left_semi"))
    discard(counts, shared)
    release(rows.sparkSession)
    return kept


def keys_of(shared: DataFrame) -> DataFrame:
    """row and shingle: the keys of every text, of which similar texts have one in common; ``shared`` is of whole sets."""
    listed = shared.groupBy("row", "n").agg(F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("all"))
    several = F.size("all") - least_overlap(F.col("n")) + 1
    keys = listed.select("row", F.explode(F.slice("all", F.lit(1), several.cast("int"))).alias("key"))
    return keys.select("row", F.col("key.shingle").alias("shingle"))


def compared(rows: np.ndarray, sets: list[np.ndarray], find: Callable[[int], int], join: Callable[[int, int], bool]) -> Iterator[tuple[int, int]]:
    """Links between texts whose sets are similar and that are not joined yet; each set's common shingles are counted with all at once."""
    part, whole = SIMILARITY
    sizes = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(ids, kind="stable")
    times = np.bincount(ids)
    ends = np.cumsum(times)
    postings = owner[order]
    starts = np.cumsum(sizes) - sizes
    for i in range(len(sets) - 1):
        mine = ids[starts[i] : starts[i] + sizes[i]]
        mine = mine[times[mine] > 1]
        if not len(mine):
            continue
        n = times[mine]
        stop = np.cumsum(n)
        at = np.arange(stop[-1]) + np.repeat(ends[mine] - n - (stop - n), n)
        common = np.bincount(postings[at], minlength=len(sets))[i + 1 :]
        near = np.flatnonzero(common * whole >= (sizes[i] + sizes[i + 1 :] - common) * part) + i + 1
        for j in near.tolist():
            a, b = int(rows[i]), int(rows[j])
            if find(a) != find(b) and join(a, b):
                yield (a, b)


def _compare_shard(frame: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) of a shard's blocks; rows of one root are joined from the start."""
    parent: dict[int, int] = {}

    def find(i: int) -> int:
        while parent.setdefault(i, i) != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(a: int, b: int) -> bool:
        parent[find(a)] = find(b)
        return True

    for row, root in zip(frame["row"].tolist(), frame["root"].tolist()):
        if find(row) != find(root):
            join(row, root)
    links: list[tuple[int, int]] = []
    for _, part in frame.groupby(["cluster", "one", "two"], sort=False):
        part = part.sort_values("row")
        rows = part["row"].to_numpy()
        if len({find(r) for r in rows.tolist()}) > 1:
            links += compared(rows, part["whole"].tolist(), find, join)
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def similar_links(sets: DataFrame, keyed: DataFrame, near: DataFrame, roots: DataFrame, width: int, seed: int, most: int = MOST_SETS) -> DataFrame:
    """(a, b): links, ``near`` among them, that join all rows with similar sets; settled.

    ``sets`` has row, n and prefix, no two sets equal; ``roots`` (node, root) are
    the components of the links ``near``; keyed has row and text.
    """
    prefixes = _shared(sets.select("row", "n", F.explode("prefix").alias("shingle")), assured(least_overlap(F.col("n"))))
    texts = settle(whole_sets(keyed.join(prefixes.select("row").distinct(), "row", "left_semi"), width, seed))
    discard(prefixes)
    shared = texts.select("row", F.size("whole").alias("n"), F.explode("whole").alias("shingle"))
    made: list[DataFrame] = []
    for _ in range(ROUNDS):
        made.append(_shared(shared, least_overlap(F.col("n"))))
        shared = made[-1].drop("held")
    keys = keys_of(made[-1]).join(roots, F.col("row") == F.col("node"), "left").select("row", "shingle", F.coalesce("root", "row").alias("root"))
    keys = settle(keys)
    discard(*made)
    # Keys whose texts have all met in one component are done with.
    counts = keys.groupBy("shingle").agg(F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("last"), F.min("row").alias("first"))
    counts = settle(counts.select("shingle", "n", "first", (F.col("least") < F.col("last")).alias("open")))
    ties = join_counted(keys, counts, ["shingle"], ["row"], F.col("open")).select(F.col("first").alias("a"), F.col("row").alias("b")).distinct()
    clusters = settle(smallest_reachable(settle(ties)))
    sizes = settle(clusters.groupBy("root").agg(F.count("*").alias("n"), F.ceil(F.count("*") / most).cast("int").alias("blocks")))
    members = join_counted(clusters, sizes, ["root"], ["node"]).select(F.col("node").alias("row"), F.col("root").alias("cluster"), "blocks")
    members = members.join(roots, F.col("row") == F.col("node"), "left").select("row", "cluster", "blocks", F.coalesce("root", "row").alias("root"))
    block, other = F.pmod(F.xxhash64("row"), "blocks").cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = members.withColumn("block", block).withColumn("other", other)
    dealt = settle(dealt.select("row", "root", "cluster", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")))
    discard(keys, counts, clusters, sizes)
    shards = max(1, -(-dealt.count() // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("cluster", "one", "two"), F.lit(shards))
    links = dealt.withColumn("shard", shard).join(texts, "row").groupBy("shard").applyInPandas(_compare_shard, "a long, b long")
    links = settle(near.union(links))
    discard(dealt, texts)
    release(sets.sparkSession)
    return links
