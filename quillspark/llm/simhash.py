"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint takes, bit by bit, the majority of the XXH64 hashes of its
shingles of three words. Two fingerprints are linked at ``radius`` or fewer
differing bits. To find all such pairs, every bit position gets a vector of
radius + 1 bits; for each of the 2**(radius+1) - 1 non-zero vectors v there is a
table, whose mask holds the positions with an odd product with v. The vectors of
any ``radius`` positions leave some v with an even product with all of them, and
in that v's table the pair collides. No pair within the radius is missed.

Equal fingerprints are folded into one row before anything else, so groups of
copies cost as little as single documents. A bucket with more than ``most``
different fingerprints is dealt out anew by the masks of the same construction
over the bits that its own mask leaves out; that again misses no pair, and after
it a bucket holds 2**16 fingerprints at most, whatever the corpus. Within a
bucket a search by flipping bits or a plain comparison finds the links, and only
a spanning forest of them leaves it.

Edge cases: null and empty texts and those without a word have the fingerprint
zero and are linked like others; fewer than three words make one shingle;
repeated rows fall together; null ids are passed over when the smallest id is
taken, so a component of null ids alone has a null component_id; an empty table
gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import shingle_sets
from quillspark.llm.common import discard, map_batches, settle, table, with_row_key
from quillspark.llm.components import smallest_reachable
from quillspark.llm.shingle_sets import majority

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Buckets with more fingerprints than this are dealt out anew.
MOST = 4096


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a whole text."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))))
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(s, SEED) for s in shingles], "<u8")) % 2**64


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and fp, the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
        return pa.record_batch([*(batch.column(k) for k in keep), pa.array(made)], [*keep, "fp"])

    kinds = dict(docs.dtypes)
    return map_batches(docs.select(*keep, "text"), run, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", fp long")


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over the given bit positions such that any ``radius`` of them are all outside some mask."""
    width = radius + 1
    vectors = [1 + i % (2**width - 1) for i in range(len(positions))]
    masks = []
    for v in range(1, 2**width):
        masks.append(sum(1 << p for p, m in zip(positions, vectors) if (m & v).bit_count() % 2))
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(prints: np.ndarray, free: int, radius: int) -> list[tuple[int, int]]:
    """Links that join what is within the radius among distinct prints, which differ in the bits of ``free`` only."""
    parent = np.arange(len(prints))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []

    def join(a: np.ndarray, b: np.ndarray) -> None:
        for i, j in zip(a.tolist(), b.tolist()):
            ri, rj = find(i), find(j)
            if ri != rj:
                parent[max(ri, rj)] = min(ri, rj)
                links.append((int(prints[i]), int(prints[j])))

    positions = [p for p in range(64) if free >> p & 1]
    flips = [sum(1 << p for p in c) for k in range(1, radius + 1) for c in combinations(positions, k)]
    unsigned = np.sort(prints.view(np.uint64))
    prints = unsigned.view(np.int64)
    n = len(prints)
    if n <= 4 * len(flips):
        for i in range(n - 1):
            near = np.flatnonzero(np.bitwise_count(unsigned[i + 1 :] ^ unsigned[i]) <= radius) + i + 1
            if len(near):
                join(np.full(len(near), i), near)
    else:
        for flip in flips:
            wanted = unsigned ^ np.uint64(flip)
            at = np.minimum(np.searchsorted(unsigned, wanted), n - 1)
            hit = np.flatnonzero((unsigned[at] == wanted) & (at > np.arange(n)))
            join(hit, at[hit])
    return links


def _bucketed(rows: DataFrame, masks: list[tuple[int, int]], table_no: Column | None = None) -> DataFrame:
    """One row a mask: table number, key, fp. masks: (table number, mask)."""
    entries = F.array(*(F.struct(F.lit(t).alias("tab"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in masks))
    return rows.select("fp", F.explode(entries).alias("e")).select("fp", "e.tab", "e.key")


def links_within(prints: DataFrame, radius: int = RADIUS, most: int = MOST) -> DataFrame:
    """(a, b): a spanning forest of the links among the distinct prints of column fp."""
    everywhere = list(range(64))
    first = covering_masks(everywhere, radius)
    buckets = _bucketed(prints, list(enumerate(first)))
    sizes = buckets.groupBy("tab", "key").agg(F.count("*").alias("n")).where("n > 1")
    large = sizes.where(F.col("n") > most).select("tab", "key")
    small = sizes.where(F.col("n") <= most).select("tab", "key")
    free = {}
    second: dict[int, list[tuple[int, int]]] = {}
    for t, mask in enumerate(first):
        rest = [p for p in everywhere if not mask >> p & 1]
        free[t] = sum(1 << p for p in rest)
        second[t] = [(len(first) * (k + 1) + t, mask | sub) for k, sub in enumerate(covering_masks(rest, radius))]
        free |= {number: ~m & (2**64 - 1) for number, m in second[t]}

    def within(key, frame):
        import pandas as pd

        found = forest(frame["fp"].to_numpy(np.int64), free[int(key[0])], radius)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    direct = buckets.join(small, ["tab", "key"], "left_semi")
    links = direct.groupBy("tab", "key").applyInPandas(within, "a long, b long")
    if large.isEmpty():
        return links
    hot = settle(buckets.join(large, ["tab", "key"], "left_semi"))
    for t in sorted(r.tab for r in large.select("tab").distinct().collect()):
        again = _bucketed(hot.where(F.col("tab") == t).select("fp"), second[t])
        links = links.union(again.groupBy("tab", "key").applyInPandas(within, "a long, b long"))
    return links


def _rooted(prints: DataFrame, first: Column, radius: int, most: int) -> DataFrame:
    """n_fp and first: for each print the smallest ``first`` among the prints it reaches."""
    nodes = settle(prints.groupBy("fp").agg(F.min(first).alias("own")))
    roots = smallest_reachable(links_within(nodes.select("fp"), radius, most))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "own", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("own").alias("first"))
    return rooted.join(named, "root").select(F.col("fp").alias("n_fp"), "first")


def components(docs: DataFrame, radius: int = RADIUS, most: int = MOST) -> DataFrame:
    """doc_id, fp and component_id (the smallest id reachable) of every document."""
    prints = settle(fingerprints(docs))
    rooted = _rooted(prints, F.col("doc_id"), radius, most)
    return prints.join(rooted, F.col("fp") == F.col("n_fp")).select("doc_id", "fp", F.col("first").alias("component_id"))


def keep_one_each(docs: DataFrame, radius: int = RADIUS, most: int = MOST, similar_width: int | None = None) -> DataFrame:
    """Of every component the document of smallest id (null ids last), with all its columns.

    With ``similar_width`` texts are linked by the Jaccard similarity of their sets of
    shingles of so many words, 4/5 or more, instead of by the radius alone.
    """
    keyed = with_row_key(docs.select(F.struct("*").alias("doc"), "doc_id", "text"), "row")
    texts = keyed.select("row", "doc_id", "text")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    if similar_width:
        kept = _similar_firsts(texts, order, radius, most, similar_width)
    else:
        prints = settle(fingerprints(texts, ("row", "doc_id")))
        kept = _rooted(prints, order, radius, most).select("first").distinct()
    return keyed.join(kept.select(F.col("first.row").alias("row")), "row", "left_semi").select("doc.*")


def _similar_firsts(texts: DataFrame, order: Column, radius: int, most: int, width: int) -> DataFrame:
    """first: the least row by ``order`` of every component of similar texts.

    Equal sets are folded. What the fingerprints' tables find within the radius is
    checked by whole sets and joined; the other links are searched by prefixes.
    """
    made = settle(shingle_sets.set_prefixes(texts, width, SEED))
    own = settle(made.groupBy("digest").agg(F.min(order).alias("own")).select("own", F.col("own.row").alias("row")))
    sets = settle(made.join(own.select("row"), "row", "left_semi").drop("digest", "doc_id"))
    discard(made)
    prints = settle(sets.groupBy("fp").agg(F.min("row").alias("row")))
    far = links_within(prints.select("fp"), radius, most)
    ends = [prints.select(F.col("fp").alias(c), F.col("row").alias(f"row_{c}")) for c in "ab"]
    between = far.join(ends[0], "a").join(ends[1], "b").select(F.col("row_a").alias("a"), F.col("row_b").alias("b"))
    equal = sets.join(prints.withColumnRenamed("row", "a"), "fp").where("row <> a").select("a", F.col("row").alias("b"))
    near = shingle_sets.similar_pairs(settle(between.union(equal)), texts, width, SEED)
    roots = settle(smallest_reachable(near))
    links = shingle_sets.similar_links(sets, texts, near, roots, width, SEED)
    roots = smallest_reachable(links)
    rooted = own.join(roots, own.row == roots.node, "left").select("own", F.coalesce("root", "row").alias("root"))
    return settle(rooted.groupBy("root").agg(F.min("own").alias("first")))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint in hexadecimal digits, component_id."""
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return components(docs, radius).select("doc_id", digits.alias("fingerprint"), "component_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
