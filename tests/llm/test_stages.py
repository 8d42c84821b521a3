"""The operators in the forms that the pipeline runs, and whole queries against brute force."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillspark.llm import common, line_templates, mixing, packed_ids, piece_bpe, quality, registry, secrets, simhash, suffixes

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, source string, size int, row string"
FULL = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def forms(docs, labels):
    tik = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return {
        "keep_good": lambda: quality.keep_good(docs, labels),
        "mix_documents": lambda: mixing.mix_documents(docs),
        "keep_one_each": lambda: simhash.keep_one_each(docs),
        "keep_one_similar": lambda: simhash.keep_one_each(docs, similar_width=5),
        "encode_documents": lambda: piece_bpe.encode_documents(docs, tik, public_tokenizers.PATTERN),
    }


def test_odd_rows_keep_their_values(stored, odd_docs):
    labels = stored([(1, 1, 0), (9, 0, 1), (None, None, None), (4, 1, 0)], LABELS)
    docs = stored(odd_docs, DOCS)
    got = {name: run().collect() for name, run in forms(docs, labels).items()}
    assert all(tuple(r) in {tuple(d) for d in odd_docs} for name in got if name != "encode_documents" for r in got[name])
    assert {r.doc_id for r in got["keep_good"]} <= {4}  # all others have fewer than ten words
    assert {r.doc_id for r in got["mix_documents"]} >= {1, 2, 7, 8}  # without words, or small: once at least
    assert Counter(r.doc_id for r in got["keep_one_each"]) == Counter({1: 1, 3: 1, 4: 1, None: 1, 8: 1, 9: 1})
    assert Counter(r.doc_id for r in got["keep_one_similar"]) == Counter({1: 1, 3: 1, 4: 1, None: 1, 8: 1, 9: 1})
    assert all(r.exact for r in got["encode_documents"]) and {r.doc_id: r.n_tokens for r in got["encode_documents"]}[1] == 0
    assert Counter(r.doc_id for r in got["encode_documents"]) == Counter(d[0] for d in odd_docs)
    spans = {r.doc_id: r.spans for r in secrets.scan_secrets(docs).collect()}
    assert spans[1] == spans[2] == "" and spans[9].startswith("assign:15:")


def test_empty_tables(stored):
    none = stored([], LABELS)
    for name, run in forms(stored([], DOCS), none).items():
        assert run().collect() == [], name


def test_stages_on_odd_rows(spark, stored, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "no id", "en", None, 5), (3, "one two", "en", "a", 7), (3, "one two", "en", "a", 7)]
    rows += [(i, " ".join(f"w{(i * j) % 97}" for j in range(1, 40)), "en", "ab"[i % 2], 0) for i in range(10, 30)]
    spark.createDataFrame(rows, FULL).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(10, 30)], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, str(tmp_path))
        assert name == "encode" or made.columns == docs.columns
        assert made.count() > 0
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def write_tables(spark, path, texts, labels=()):
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], FULL).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(list(labels), LABELS).write.parquet(str(path / "labels.parquet"))


def test_op4_query_equals_brute_force(spark, tmp_path):
    random.seed(31)
    base = [f"w{random.randint(0, 50)}" for _ in range(400)]
    texts = [None, "", " \n", "a", "A", "a b"]
    for _ in range(80):
        edited = list(base)
        for _ in range(random.randint(0, 6)):
            edited[random.randrange(400)] = "x"
        texts.append(" ".join(edited))
    write_tables(spark, tmp_path, texts)
    prints = [simhash.fingerprint(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    want = sorted((i, f"{p:016x}", find(i)) for i, p in enumerate(prints))
    assert len({w[2] for w in want}) > 3
    got = registry.queries()["op4_simhash"](spark, str(tmp_path)).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == want


def test_op6_query_equals_tiktoken(spark, tmp_path):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=piece_bpe.load_ranks(path), special_tokens={})
    texts = [None, "", "a  b\n\nc", "Déjà vu 漢字 🙂", "<|endoftext|> x's", "word " * 300, "\t x"]
    write_tables(spark, tmp_path, texts)
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    want = []
    for i, t in enumerate(texts):
        ids = plain.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    got = registry.queries()["op6_piece_bpe"](spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == want


def slow_path(forest, tree, x):
    """The path length of one row in one tree, node by node."""
    node = 0
    while forest.feature[tree, node] >= 0:
        node = forest.child[tree, node] + int(x[forest.used[forest.feature[tree, node]]] > forest.value[tree, node])
    return forest.value[tree, node]


def test_op2_query_equals_brute_force(spark, tmp_path):
    random.seed(33)
    word = lambda: "".join(random.choices("abcdefg", k=5))
    texts = [None, "", "one two", " ".join(["x"] * 9), " ".join(["same few words come again"] * 3)]
    repeat = [word() for _ in range(100)]
    texts.append(" ".join(repeat + repeat[:10]))  # 20 of 110 words in windows found twice: 18 percent
    texts.append(" ".join(repeat[:60] + repeat[:8]))  # 16 of 68: above 20 percent
    texts += [" ".join(word() + ("%%" if i % 7 == 0 else "") for _ in range(50)) for i in range(150)]
    write_tables(spark, tmp_path, texts, [(i, int((i - 7) % 7 != 0), 0) for i in range(7, 157)])
    got = {r.doc_id: r for r in registry.queries()["op2_quality"](spark, str(tmp_path)).collect()}
    forest = quality.fit_forest(common.table(spark, str(tmp_path), "documents"), common.table(spark, str(tmp_path), "labels"))
    norm = float(quality._mean_path(forest.sample))
    for i, t in enumerate(texts):
        counts, ratios = quality.statistics(t)
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        paths = [slow_path(forest, k, ratios) for k in range(len(forest.feature))]
        anomaly = 2 ** (-(sum(paths) / len(paths)) / norm)
        assert (got[i].n_words, got[i].n_repeat_words, got[i].base_failed) == (counts[0], counts[4], failed), i
        assert got[i].anomaly == pytest.approx(anomaly), i
        assert got[i].kept == (not failed and anomaly < forest.threshold), i
    assert got[3].base_failed and not got[5].base_failed and got[6].base_failed
    assert sum(not got[i].kept for i in range(7, 157)) >= 15


def test_every_labelled_row_is_in_every_tree_and_in_the_threshold(stored):
    random.seed(34)
    word = lambda: "".join(random.choices("abcdefg", k=5))
    texts = [" ".join(word() + "%" * random.choice([0, 0, 0, 1, 3 * (i % 9 == 0)]) for _ in range(20)) for i in range(700)]
    labels = [(i, int(i % 9 != 0), 0) for i in range(600)]
    docs = stored([(i, t, "s", 1, "") for i, t in enumerate(texts)], "doc_id long, text string, source string, size int, row string")
    forest = quality.fit_forest(docs, stored(labels, LABELS))
    x = np.array([quality.statistics(t)[1] for t in texts[:600]])
    for tree in range(0, len(forest.feature), 16):
        ends = Counter()
        for ratios in x:
            node = level = 0
            while forest.feature[tree, node] >= 0:
                node = forest.child[tree, node] + int(ratios[forest.used[forest.feature[tree, node]]] > forest.value[tree, node])
                level += 1
            ends[node, level] += 1
        for (node, level), n in ends.items():  # all 600 rows, not some of them, make the length of a path
            assert forest.value[tree, node] == pytest.approx(level + (float(quality._mean_path(n)) if n > 1 else 0))
    scores, good = forest.score(x), np.array([q == 1 for _, q, _ in labels])
    cost = lambda t: quality.REJECTION_COST * int((good & (scores >= t)).sum()) + int((~good & (scores < t)).sum())
    assert cost(forest.threshold) == min(cost(k / quality.STEPS) for k in range(quality.STEPS + 1))


def test_operators_leave_the_session_alone(spark, stored):
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = [spark.conf.get(k, None) for k in keys]
    docs = stored([(i, f"text number {i} with password=abcdefgh{i}", "s", 1, "") for i in range(50)], DOCS)
    one, two = secrets.scan_secrets(docs), packed_ids.write_library_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), 2)
    first = (sorted(map(tuple, one.collect())), sorted(map(tuple, packed_ids.read_packed(two).collect())))
    second = (sorted(map(tuple, packed_ids.read_packed(two).collect())), sorted(map(tuple, one.collect())))
    assert first == second[::-1] and [spark.conf.get(k, None) for k in keys] == before


def test_row_keys_do_not_hang_on_splits(spark, stored):
    docs = stored([(i, f"text {i}", "s", 1, "") for i in range(3000)], DOCS, files=5)
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    keys = []
    for bound in (before, "4096"):
        spark.conf.set(size, bound)
        keys.append(sorted((r.doc_id, r.k) for r in common.with_row_key(docs.select("doc_id", "text"), "k").collect()))
    spark.conf.set(size, before)
    assert keys[0] == keys[1] and len({k for _, k in keys[0]}) == 3000
    exploded = docs.select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("x"))
    assert common.with_row_key(exploded, "k").select("k").distinct().count() == 6000


def test_joins_with_hot_keys(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    counted = common.settle(rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("big", F.col("n") > 1))
    assert common.join_counted(rows, counted, ["k"], ["v"]).count() == 20_000
    kept = common.join_counted(rows, counted, ["k"], ["v"], F.col("big"))
    assert kept.select("k").distinct().collect() == [(7,)] and kept.count() == 13_333
    assert common.join_counted(rows, counted, ["k"], ["v"], ~F.col("big")).count() == 6_667


def test_a_shard_is_searched_in_little_memory():
    rng = np.random.default_rng(8)
    parts, anchors = [], []
    for anchor in range(2500):
        core = rng.integers(0, 256, 230, np.uint8).tobytes()
        parts += [core[:220] + b"left", b"right" + core, rng.integers(0, 256, 210, np.uint8).tobytes()]
        anchors += [anchor * 7919 % 2500] * 3
    dealt = rng.permutation(len(parts)).tolist()
    parts, anchors = [parts[i] for i in dealt], np.array(anchors)[dealt]
    rows = np.arange(len(parts))
    frame = pd.DataFrame({"row": rows, "begin": 0, "anchor": anchors, "n": 1, "lanes": 1, "bytes": parts})
    tracemalloc.start()
    got = suffixes._search_shard(frame)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6  # all sorted at once took 157 MB
    want = [(i, a, b) for i, places in zip(rows.tolist(), suffixes.repeated_strings(parts)) for a, b in suffixes._ranges(places)]
    assert len(want) == 5000
    assert list(zip(got["row"], got["begin"], got["end"])) == want


def test_lines_join_their_leaves_alike_at_every_size(stored, monkeypatch):
    rows = [(i, f"the same old line {i % 2}\nanother text of number{i} and word {'abc'[i % 3]}", "s", 1, "") for i in range(30)]
    keyed = stored(rows, DOCS).select(F.col("doc_id").alias("row"), "doc_id", "text")
    occurrences = common.settle(line_templates.line_occurrences(keyed))
    plans, settle = [], line_templates.settle
    monkeypatch.setattr(line_templates, "settle", lambda df: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or settle(df))
    live = line_templates.live_occurrences(occurrences, line_templates._needed(3, None))
    assert live.count() == 60
    assert "SortMergeJoin [leaf" in plans[-1]  # a broadcast one, at small sizes, moves no lines
