"""Suffix-array removal of byte strings that occur elsewhere.

A byte goes if a string of LENGTH bytes that covers it also starts at another
place. To sort every suffix of a corpus in one piece is out of the question, so
the strings are dealt out by content first, without missing any:

1. Each string of LENGTH bytes has an anchor, the least hash among its substrings
   of ANCHOR bytes. Equal strings have equal anchors. Strings next to each other
   mostly share theirs; such a stretch is a fragment: the place, the anchor's
   hash and a hash of all its bytes.
2. An anchor that occurs once rules its strings out. Where the same fragment
   occurs twice or more, all its strings repeat.
3. What is left are different fragments with an anchor in common: the edges of
   copied passages. They are gathered to shards by anchor. Within a shard, some
   anchors at a time get a suffix array by Larsson-Sadakane refinement and its
   common prefixes by Kasai's method; runs of suffixes with LENGTH bytes in common
   are strings that repeat.
4. An anchor with very many fragments is split over several shards. Each hands
   on its distinct strings as one sorted run of 128-bit keys, cut in ranges, with
   the places that it could not decide; for each range the runs are merged and
   the places looked up by binary search.

Strings are compared byte by byte within a shard. Two hashes decide elsewhere:
equal fragments have 128 bits in common (anchor and content), equal strings of a
split anchor another 128. Among n fragments a false match has a chance of about
n squared in 2**129: 1 in 10**13 for 100 TB, a fragment every 50 bytes.

Each string of the corpus lies in one fragment only, so two equal ones are two
places. Texts move to their fragments' and to their removals' rows by row key.

Edge cases: a null text is empty; texts below LENGTH bytes keep everything;
repeated rows count as further places; the ids of rows may be null or equal; an
empty table gives an empty result; extra columns are left alone; long texts are
cut in blocks that overlap.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import discard, give_back, join_counted, map_batches, release, settle, table, with_row_key

LENGTH, ANCHOR = 200, 56
SPAN = LENGTH - ANCHOR + 1
_PLACE_BITS = 20
_BLOCK = (1 << _PLACE_BITS) - LENGTH
#: Fragments with one anchor in one shard, and bytes of fragments a shard should hold.
MOST_FRAGMENTS, SHARD_BYTES = 2048, 2 << 20
#: Bytes of fragments that are sorted at once, and those of one more anchor at most.
SORTED_BYTES = 1 << 18

_rng = np.random.default_rng(20)
_LETTERS = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of them at least."""
    if not _powers or len(_powers[0]) < n:
        size, tables = max(1 << 14, 1 << n.bit_length()), []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            made, factor = np.ones(1, np.uint64), base
            while len(made) < size:
                made = np.concatenate([made, made * np.uint64(factor)])
                factor = factor * factor % (1 << 64)
            tables.append(made)
        _powers[:] = tables
    return _powers[0][:n], _powers[1][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def fragments_of(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """begin, end (of the bytes), anchor hash and content hash of each fragment of a block."""
    n = len(data)
    power, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LETTERS[0][data] * power[:n], out=sums[1:])
    hashes = _mixed((sums[ANCHOR:] - sums[:-ANCHOR]) * inverse[: n - ANCHOR + 1])
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < SPAN:
        least = np.minimum(least[: len(least) - (SPAN - width)], least[SPAN - width :])
    cut = np.flatnonzero(least[1:] != least[:-1]) + 1
    begin = np.concatenate([[0], cut])
    last = np.concatenate([cut - 1, [len(least) - 1]])
    end, at = last + LENGTH, (least[begin] & low).astype(np.int64)
    content = _mixed((sums[end] - sums[begin]) * inverse[begin])
    content = _mixed(content ^ ((end - begin).astype(np.uint64) << np.uint64(40)) ^ (at - begin).astype(np.uint64))
    return begin, end, hashes[at].view(np.int64), content.view(np.int64)


def fragments(keyed: DataFrame) -> DataFrame:
    """row, begin, size, anchor and content of every fragment; keyed has row and text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts: list[list[np.ndarray]] = [[], [], [], [], []]
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
            data = np.frombuffer((text or "").encode(), np.uint8)
            for at in range(0, len(data) - LENGTH + 1, _BLOCK):
                begin, end, anchor, content = fragments_of(data[at : at + _BLOCK + LENGTH - 1])
                for part, made in zip(parts, (np.full(len(begin), row), begin + at, end - begin, anchor, content)):
                    part.append(made)
        kinds = [np.int64, np.int64, np.int32, np.int64, np.int64]
        arrays = [pa.array(np.concatenate(p).astype(k) if p else np.zeros(0, k)) for p, k in zip(parts, kinds)]
        return pa.record_batch(arrays, ["row", "begin", "size", "anchor", "content"])

    return map_batches(keyed, run, "row long, begin long, size int, anchor long, content long")


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffixes in order, by Larsson-Sadakane refinement.

    Suffixes are sorted by 7 bytes; then only groups still undecided are sorted
    again, by the ranks of what follows, which doubles the sorted length.
    """
    n = len(data)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = data.astype(np.uint64) + np.uint64(1)
    first = np.zeros(n, np.uint64)
    for i in range(7):  # 9 bits a symbol, so that the end sorts before any byte
        first = (first << np.uint64(9)) | padded[i : n + i]
    order = np.argsort(first, kind="stable")
    values = first[order]
    heads = np.concatenate([[True], values[1:] != values[:-1]])
    done = 7
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    while done < n:
        tails = np.concatenate([heads[1:], [True]])
        open_ = np.flatnonzero(~(heads & tails))  # places in groups of two or more
        if not len(open_):
            break
        members = order[open_]
        group, behind = rank[members], rank[np.minimum(members + done, n)]
        again = np.lexsort((behind, group))
        order[open_] = members[again]
        g, b = group[again], behind[again]
        heads[open_] = np.concatenate([[True], (g[1:] != g[:-1]) | (b[1:] != b[:-1])])
        rank[order[open_]] = np.maximum.accumulate(np.where(heads[open_], open_, 0))
        done *= 2
    return order


def common_prefixes(data: bytes, order: np.ndarray, wanted: np.ndarray, limit: int = LENGTH) -> np.ndarray:
    """Kasai's method: bytes that each suffix has in common with the one before it in order, ``limit`` at most.

    Only the wanted places in order are looked at, the others count as 0. What a
    suffix has in common less one is what the next one has at least; where the
    walk jumps over unwanted suffixes it begins at 0 again.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    at = np.flatnonzero(wanted[1:]) + 1
    before[order[at]] = order[at - 1]
    places = np.flatnonzero(before >= 0)
    common, length, last = np.zeros(n, np.int64), 0, -2
    made = []
    for i, j in zip(places.tolist(), before[places].tolist()):
        length = length - 1 if length and i == last + 1 else 0
        last, most = i, min(limit, n - max(i, j))
        if data[i + length : i + most] == data[j + length : j + most]:
            length = most
        else:
            while data[i + length] == data[j + length]:
                length += 1
        made.append(length)
    common[places] = made
    return common[order]


def repeated_strings(parts: list[bytes]) -> list[np.ndarray]:
    """For each part, at which of its places a string of LENGTH bytes begins that occurs again among the parts."""
    sizes = np.array([len(p) for p in parts])
    joined = b"".join(parts)
    data = np.frombuffer(joined, np.uint8)
    ends = np.cumsum(sizes)
    order = suffix_array(data)
    whole = np.repeat(ends, sizes)[order] - order >= LENGTH
    # Only neighbours whose strings have equal keys can be equal; these are compared byte by byte.
    keys = np.zeros(len(data), np.uint64)
    if len(data) >= LENGTH:
        keys[: len(data) - LENGTH + 1] = _string_keys(data, 0)
    keys = keys[order]
    inside = order <= len(data) - LENGTH
    wanted = np.concatenate([[False], inside[1:] & inside[:-1] & (keys[1:] == keys[:-1])])
    same = common_prefixes(joined, order, wanted) >= LENGTH
    run = np.cumsum(~same) - 1
    members = np.bincount(run[whole], minlength=run[-1] + 1)
    again = np.zeros(len(data), bool)
    again[order] = whole & (members[run] > 1)
    starts = ends - sizes
    return [np.flatnonzero(again[s : e - LENGTH + 1]) for s, e in zip(starts, ends)]


def repeated_by_anchor(parts: list[bytes], anchors: np.ndarray, most: int = SORTED_BYTES) -> list[np.ndarray]:
    """``repeated_strings``, some anchors at a time: equal strings have equal anchors, so others need not be sorted along."""
    order = np.argsort(anchors, kind="stable")
    sizes, sorted_ = np.array([len(parts[i]) for i in order]), anchors[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))  # of each anchor
    before = (np.cumsum(sizes) - sizes)[first] // most
    starts = first[np.concatenate([[True], before[1:] != before[:-1]])].tolist()
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(parts)
    for a, b in zip(starts, [*starts[1:], len(parts)]):
        members = order[a:b].tolist()
        for i, places in zip(members, repeated_strings([parts[i] for i in members])):
            found[i] = places
    return found


def _ranges(places: np.ndarray) -> list[tuple[int, int]]:
    """Bytes covered by strings that begin at the places, as maximal ranges."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > LENGTH)
    begins, lasts = np.concatenate([[places[0]], places[cut + 1]]), np.concatenate([places[cut], [places[-1]]])
    return list(zip(begins.tolist(), (lasts + LENGTH).tolist()))


def _string_keys(data: np.ndarray, k: int) -> np.ndarray:
    """Key k (0 or 1) of every string of LENGTH bytes."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[k][data] * power[: len(data)], out=sums[1:])
    return _mixed((sums[LENGTH:] - sums[:-LENGTH]) * inverse[: len(data) - LENGTH + 1])


_PLACE = np.dtype([("row", "<i8"), ("begin", "<i8"), ("key", "<i4")])
_KEY = np.dtype([("one", "<u8"), ("two", "<u8")])
_SEARCHED = ["row", "begin", "end", "anchor", "lane", "keys", "places"]


def _run_of(frame: pd.DataFrame, found: list[np.ndarray], lanes: int) -> list[tuple[int, bytes, bytes]]:
    """Of fragments with one anchor: by range of keys the sorted distinct keys of their strings, and the places left open."""
    keys, places = [], []
    for row, begin, n, part, known in zip(frame["row"], frame["begin"], frame["n"], frame["bytes"], found):
        data = np.frombuffer(part, np.uint8)
        made = np.empty(len(data) - LENGTH + 1, _KEY)
        made["one"], made["two"] = _string_keys(data, 0), _string_keys(data, 1)
        open_ = np.ones(len(made), bool) if n == 1 else np.zeros(len(made), bool)
        open_[known] = False
        where = np.zeros(len(made), _PLACE)
        where["row"], where["begin"], where["key"] = row, begin + np.arange(len(made)), np.where(open_, 0, -1)
        keys.append(made)
        places.append(where)
    joined, where = np.concatenate(keys), np.concatenate(places)
    order = np.lexsort((joined["two"], joined["one"]))
    joined = joined[order]
    first = np.concatenate([[True], joined[1:] != joined[:-1]])
    number = np.cumsum(first) - 1
    where = where[order]
    where["key"] = np.where(where["key"] < 0, -1, number)
    where, distinct = where[where["key"] >= 0], joined[first]
    lane = np.minimum(distinct["one"] // np.uint64(-(-(1 << 64) // lanes)), np.uint64(lanes - 1)).astype(np.int64) if lanes > 1 else np.zeros(len(distinct), np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], lane[1:] != lane[:-1]])).tolist() + [len(lane)]
    runs = []
    for a, b in zip(cuts, cuts[1:]):
        low, high = np.searchsorted(where["key"], [a, b])
        inside = where[low:high].copy()
        inside["key"] -= a
        runs.append((int(lane[a]), distinct[a:b].tobytes(), inside.tobytes()))
    return runs


def _search_shard(frame: pd.DataFrame) -> pd.DataFrame:
    """Ranges that repeat within a shard, of fragments that occur once; runs of the strings of split anchors."""
    found = repeated_by_anchor(frame["bytes"].tolist(), frame["anchor"].to_numpy())
    rows: list[tuple] = []
    for row, begin, n, places in zip(frame["row"], frame["begin"], frame["n"], found):
        if n == 1:
            rows += [(row, begin + a, begin + b, None, None, None, None) for a, b in _ranges(places)]
    split = np.flatnonzero(frame["lanes"].to_numpy() > 1)
    for anchor, part in frame.iloc[split].groupby("anchor"):
        known = [found[i] for i in part.index]
        for lane, keys, places in _run_of(part, known, int(part["lanes"].iloc[0])):
            rows.append((None, None, None, anchor, lane, keys, places))
    give_back()
    return pd.DataFrame(rows, columns=_SEARCHED).astype({c: "Int64" for c in _SEARCHED[:5]})


def _merge_runs(frame: pd.DataFrame) -> pd.DataFrame:
    """Of the strings with one anchor in one range of keys: the open places of those in the runs of two shards or more."""
    runs = [np.frombuffer(k, _KEY) for k in frame["keys"]]
    keys = np.concatenate(runs)
    keys = keys[np.lexsort((keys["two"], keys["one"]))]
    twice = keys[1:][keys[1:] == keys[:-1]]
    twice = twice[np.concatenate([[True], twice[1:] != twice[:-1]])] if len(twice) else twice
    rows = [np.zeros(0, np.int64)]
    begins = [np.zeros(0, np.int64)]
    for run, packed in zip(runs, frame["places"]):
        places = np.frombuffer(packed, _PLACE)
        if not len(twice) or not len(places):
            continue
        wanted = run[places["key"]]
        at = np.searchsorted(twice["one"], wanted["one"])
        again = np.zeros(len(places), bool)
        while True:  # a second turn only where first halves of keys collide
            inside = at < len(twice)
            near = twice[np.minimum(at, len(twice) - 1)]
            again |= inside & (near == wanted)
            more = inside & ~again & (near["one"] == wanted["one"])
            if not more.any():
                break
            at = at + more
        rows.append(places["row"][again])
        begins.append(places["begin"][again])
    begin = np.concatenate(begins)
    return pd.DataFrame({"row": np.concatenate(rows), "begin": begin, "end": begin + LENGTH})


def repeated_ranges(keyed: DataFrame, most: int = MOST_FRAGMENTS) -> DataFrame:
    """row and its ranges (begin, end) of bytes to remove, settled; keyed has row and text. Ranges may overlap."""
    spark = keyed.sparkSession
    every = settle(fragments(keyed))
    twice = settle(every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"))
    shared = settle(join_counted(every, twice, ["anchor"], ["row", "begin"]))
    discard(every, twice)
    release(spark)
    kinds = settle(
        shared.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct("row", "begin", "size")).alias("one"))
    )
    copied = settle(kinds.where("n > 1").select("anchor", "content", "n"))
    full = join_counted(shared, copied, ["anchor", "content"], ["row", "begin"])
    full = settle(full.select("row", "begin", (F.col("begin") + F.col("size")).alias("end")))
    discard(shared, copied)

    lanes = F.ceil(F.col("n") / most).cast("int")
    variants = settle(kinds.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").withColumn("lanes", lanes))
    once = kinds.select("one.*", "anchor", "content", F.col("n").alias("times"))
    edges = settle(join_counted(once, variants, ["anchor"], ["content"]).withColumnRenamed("times", "n"))
    discard(kinds, variants)
    total = edges.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b")).head().b
    shards = max(1, -(-total // SHARD_BYTES))
    wanted = edges.groupBy("row").agg(F.collect_list(F.struct("begin", "size", "anchor", "content", "n", "lanes")).alias("cuts"))
    texts = keyed.join(wanted, "row").select("row", F.encode("text", "UTF-8").alias("raw"), F.explode("cuts").alias("cut"))
    pieces = texts.select("row", "cut.*", F.expr("substring(raw, CAST(cut.begin + 1 AS INT), cut.size)").alias("bytes"))
    shard = F.pmod(F.xxhash64("anchor", F.pmod("content", "lanes")), F.lit(shards))
    pieces = pieces.withColumn("shard", shard).select("shard", "row", "begin", "anchor", "n", "lanes", "bytes")

    schema = "row long, begin long, end long, anchor long, lane long, keys binary, places binary"
    searched = settle(pieces.groupBy("shard").applyInPandas(_search_shard, schema))
    discard(edges)
    release(spark)
    inside = searched.where("anchor IS NULL").select("row", "begin", "end")
    across = searched.where("anchor IS NOT NULL").groupBy("anchor", "lane").applyInPandas(_merge_runs, "row long, begin long, end long")
    found = full.union(inside).union(across)
    by_row = settle(found.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("ranges")))
    discard(full, searched)
    return by_row


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_ranges(raw: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left, the bytes removed and the maximal runs they form."""
    kept, spans, removed, at = [], 0, 0, 0
    for begin, end in sorted(ranges):
        if begin > at or not spans:
            kept.append(raw[at:begin])
            spans += 1
            removed += end - begin
            at = end
        elif end > at:
            removed += end - at
            at = end
    kept.append(raw[at:])
    return b"".join(kept), removed, spans


def dedup_report(docs: DataFrame, most: int = MOST_FRAGMENTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of what is left, of every document."""
    keyed = with_row_key(docs.select("doc_id", "text"), "row")
    by_row = repeated_ranges(keyed.select("row", "text"), most)
    release(docs.sparkSession)
    joined = keyed.join(by_row, "row", "left").select("doc_id", "text", "ranges")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            raw = (text or "").encode()
            kept, removed, spans = remove_ranges(raw, [(r["begin"], r["end"]) for r in ranges or ()])
            rows.append((len(raw), removed, spans, hashlib.sha256(kept).hexdigest()))
        made = list(zip(*rows)) if rows else [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(made, kinds))]
        return pa.record_batch(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return map_batches(joined, run, RESULT)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(table(spark, sf_dir, "documents"))
