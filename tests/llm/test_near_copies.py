import random
from itertools import combinations

import corpus_pipeline
from quillspark.llm import components, shingle_sets
from quillspark.llm.common import settle, with_row_key

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def similarity(a, b):
    a, b = (set(shingle_sets.shingle_set(x, 5, 42).tolist()) for x in (a, b))
    return len(a & b) / (len(a | b) or 1)


def brute_kept(rows):
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if similarity(rows[i][1], rows[j][1]) >= 0.8 or not (rows[i][1] or rows[j][1]):
            parent[find(i)] = find(j)
    return sorted(min(r[0] for k, r in enumerate(rows) if find(k) == root) for root in {find(k) for k in range(len(rows))})


def test_edited_copies_go(spark, stored):
    random.seed(21)
    make = lambda n: [random.choice("abcdefghij") + str(random.randint(0, 300)) for _ in range(n)]
    texts = ["", None, "one two", "One  two", "one two three"]
    for _ in range(12):
        base = make(random.randint(40, 160))
        for _ in range(random.randint(1, 5)):
            edited = list(base)
            for _ in range(random.randint(0, 5)):
                edited[random.randrange(len(edited))] = "edit" + str(random.randint(0, 10**6))
            texts.append(" ".join(edited))
            if random.random() < 0.5:
                base = edited
    rows = [(i, t, "xx", "s", 0) for i, t in enumerate(texts)]
    random.shuffle(rows)
    got = corpus_pipeline.drop_near_copies(spark, stored(rows, DOCS), "").collect()
    assert sorted(r.doc_id for r in got) == brute_kept(rows)


def test_large_families_are_compared_in_blocks(stored):
    """A family around a base that is not there: some pairs are similar, most are not."""
    random.seed(23)
    base = [random.choice("abcdefghij") + str(random.randint(0, 300)) for _ in range(120)]
    texts = []
    for k in range(60):
        edited = list(base)
        for _ in range(random.choice((1, 2, 3))):
            edited[random.randrange(len(edited))] = f"edit{k}"
        texts.append(" ".join(edited))
    rows = [(i, t, "xx", "s", 0) for i, t in enumerate(texts)]
    docs = stored(rows, DOCS)
    want = brute_kept(rows)
    assert 1 < len(want) < 60
    keyed = with_row_key(docs.select("doc_id", "text"), "row")
    sets = settle(shingle_sets.set_prefixes(keyed, 5, 42))
    none = keyed.sparkSession.createDataFrame([], "a long, b long"), keyed.sparkSession.createDataFrame([], "node long, root long")
    for most in (2048, 7):
        links = shingle_sets.similar_links(sets, keyed, *none, 5, 42, most)
        roots = {r.node: r.root for r in components.smallest_reachable(links).collect()}
        ids = {r.row: r.doc_id for r in keyed.collect()}
        groups = {}
        for row, doc_id in ids.items():
            root = roots.get(row, row)
            groups[root] = min(doc_id, groups.get(root, doc_id))
        assert sorted(groups.values()) == want


def test_prefixes_of_similar_sets_share_what_is_assured():
    for n in range(1, 300):
        for m in range(n, 300):
            overlap = max(shingle_sets.least_overlap(n), shingle_sets.least_overlap(m))
            if overlap > n or 5 * overlap < 4 * (n + m - overlap):
                continue
            # The first common shingles lie as late in either order as can be.
            both = min(shingle_sets.prefix_length(n) - (n - overlap), shingle_sets.prefix_length(m) - (m - overlap))
            assert both >= min(shingle_sets.assured(n), shingle_sets.assured(m)) >= shingle_sets.assured(shingle_sets.least_overlap(m))
