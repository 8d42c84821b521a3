"""Line dedup by a fixed-depth tree of line templates, with DataFrame functions alone.

A line goes down a tree: first by its number of tokens, then by its DEPTH
leading tokens, which name a leaf. Tokens that hold a digit or an @ (numbers,
dates, addresses, counters) are variable fields everywhere. Within a leaf,
further fields are found by position: a token is constant where enough of the
leaf's lines have it in that place (as many as a template needs to recur, and
one in SPLIT of them), else it is a field. A line of which at most MOST_VARIED
percent of the tokens behind the leading ones become fields so follows the
template that is left; another line, whose leaf is a chance meeting, stays a
template of its own.

Counts decide, not the order of rows. A template is recurring when ``min_docs``
documents with different texts hold it; each of its lines is dropped but the
first, in the document of smallest id, which keeps its text whole. Documents are
counted by their text, so that mere copies of one do not make its lines recur.
Lines below ``min_tokens`` tokens are left alone. Where ``long_tokens`` is given,
two such documents are enough for a template of that many tokens, which chance
does not repeat.

Most lines end in a leaf that too few texts reach; only the others are looked at
token by token. A leaf or template with many lines is dealt over several tasks.

Edge cases: a null text stays null and has no lines; an empty one has one line
without tokens; line breaks are \\n alone; a null id comes after all others;
rows that repeat id and text share one fate; a template kept in one line is gone
from the rest of its document too; an empty table gives an empty result. Other
columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import WORD, discard, join_counted, release, settle, table, with_row_key

DEPTH, MIN_TOKENS, MIN_DOCS = 3, 3, 3
#: Templates of so many tokens recur in two documents already; op5's SQL knows no such rule.
LONG_TOKENS, LONG_DOCS = 20, 2
SPLIT, MOST_VARIED = 20, 30
MARK = "<*>"
#: A token with a digit or @ in it; it is looked for at the start of a token only, so that time stays linear.
FIELD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: The leading tokens of a line.
LEADING = rf"^[\x20\x09-\x0D]*((?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){{1,{DEPTH}}})"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_occurrences(keyed: DataFrame, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """row, leaf, line (masked) and its hash, its tokens n and the place of every line; keyed has row, doc_id and text."""
    lines = keyed.select("row", "doc_id", F.xxhash64("text").alias("body"), F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    fields = F.when(F.col("line").rlike("[0-9@]"), F.regexp_replace("line", FIELD, F.lit(MARK))).otherwise(F.col("line"))
    masked = lines.withColumn("line", fields).withColumn("n", F.regexp_count("line", F.lit(WORD)))
    leaf = F.xxhash64("n", F.regexp_extract("line", LEADING, 1))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body", "at")
    return masked.where(F.col("n") >= min_tokens).select(
        "row", leaf.alias("leaf"), F.xxhash64("line").alias("own"), F.col("n").alias("tokens"), place.alias("place"), "line"
    )


def _needed(min_docs: int, long_tokens: int | None) -> Column:
    """Texts that a template of so many tokens needs to recur."""
    if long_tokens is None:
        return F.lit(min_docs)
    return F.when(F.col("tokens") >= long_tokens, LONG_DOCS).otherwise(min_docs)


def live_occurrences(occurrences: DataFrame, needed: Column) -> DataFrame:
    """The lines in leaves that enough texts reach, with ``texts``, the leaf's different pairs of line and text."""
    pairs = occurrences.groupBy("leaf", "own", F.col("place.body").alias("body")).agg(F.count("*").alias("n"), F.min("tokens").alias("tokens"))
    leaves = pairs.groupBy("leaf").agg(F.sum("n").alias("n"), F.count("*").alias("texts"), F.min("tokens").alias("tokens"))
    leaves = settle(leaves.select("leaf", "n", "texts", (F.col("texts") >= needed).alias("live")))
    live = settle(join_counted(occurrences, leaves, ["leaf"], ["row", "place"], F.col("live"), alike=True).drop("live"))
    discard(leaves)
    return live


def leaf_constants(by_line: DataFrame, needed: Column) -> DataFrame:
    """leaf and constants: for each place behind the leading tokens the tokens, SPLIT at most, that are constant there."""
    tokens = F.regexp_extract_all("line", F.lit(WORD), F.lit(0))
    behind = by_line.select("leaf", "tokens", "texts", "n_docs", F.posexplode(F.slice(tokens, DEPTH + 1, F.greatest(F.col("tokens") - DEPTH, F.lit(0)))).alias("at", "token"))
    held = behind.groupBy("leaf", "at", "token").agg(F.sum("n_docs").alias("held"), F.min("texts").alias("texts"), F.min("tokens").alias("tokens"))
    constant = F.col("held") >= F.greatest(needed, F.ceil(F.col("texts") / SPLIT))
    by_place = held.groupBy("leaf", "at").agg(F.collect_set(F.when(constant, F.col("token"))).alias("tokens"))
    by_leaf = by_place.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("at", "tokens"))).alias("places"))
    return by_leaf.select("leaf", F.col("places.tokens").alias("constants"))


def line_templates(live: DataFrame, needed: Column) -> DataFrame:
    """leaf, own, template and n (its lines) of every different line, settled."""
    by_text = live.groupBy("leaf", "own", "place.body").agg(F.count("*").alias("n"), F.first("tokens").alias("tokens"), F.first("texts").alias("texts"), F.first("line").alias("line"))
    by_line = by_text.groupBy("leaf", "own").agg(
        F.count("*").alias("n_docs"), F.sum("n").alias("n"), F.first("tokens").alias("tokens"), F.first("texts").alias("texts"), F.first("line").alias("line")
    )
    by_line = settle(by_line)
    sizes = by_line.groupBy("leaf").agg(F.count("*").alias("n"))
    constants = settle(sizes.join(leaf_constants(by_line, needed), "leaf", "left"))
    guided = join_counted(by_line.withColumnRenamed("n", "lines"), constants, ["leaf"], ["own"])
    split = guided.withColumn("words", F.regexp_extract_all("line", F.lit(WORD), F.lit(0)))

    def shaped(word: Column, at: Column) -> Column:
        return F.when((at < DEPTH) | F.array_contains(F.get("constants", at - DEPTH), word), word).otherwise(F.lit(MARK))

    shapes = split.select("leaf", "own", "lines", "tokens", "words", F.transform("words", shaped).alias("shape"))
    behind = lambda words: F.slice(words, DEPTH + 1, F.col("tokens") - DEPTH)
    marks = lambda words: F.size(F.filter(words, lambda w: w == MARK))
    fields, fields_now = marks(behind("words")), marks(behind("shape"))
    follows = (fields_now - fields) * 100 <= (F.col("tokens") - DEPTH - fields) * MOST_VARIED
    template = F.when(F.col("tokens") <= DEPTH, F.col("own")).when(follows, F.xxhash64("shape")).otherwise(F.col("own"))
    made = settle(shapes.select("leaf", "own", template.alias("template"), F.col("lines").alias("n")))
    discard(by_line, constants)
    return made


def dropped_lines(keyed: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, long_tokens: int | None = None) -> DataFrame:
    """row and ``gone``, the places of its lines to drop, settled."""
    needed = _needed(min_docs, long_tokens)
    occurrences = settle(line_occurrences(keyed, min_tokens))
    live = live_occurrences(occurrences, needed)
    discard(occurrences)
    release(keyed.sparkSession)
    templates = line_templates(live, needed)
    placed = join_counted(live.select("row", "leaf", "own", "tokens", "place"), templates, ["leaf", "own"], ["row", "place"])
    placed = settle(placed.drop("own"))
    discard(live, templates)
    by_text = placed.groupBy("leaf", "template", "place.body").agg(F.min("place").alias("first"), F.count("*").alias("n"), F.min("tokens").alias("tokens"))
    by_template = by_text.groupBy("leaf", "template").agg(
        F.count("*").alias("n_docs"), F.sum("n").alias("n"), F.min("first").alias("first"), F.min("tokens").alias("tokens")
    )
    recurring = settle(by_template.where(F.col("n_docs") >= needed).select("leaf", "template", "n", "first"))
    gone = join_counted(placed, recurring, ["leaf", "template"], ["row", "place"]).where(F.col("place") != F.col("first"))
    made = settle(gone.groupBy("row").agg(F.collect_set("place.at").alias("gone")))
    discard(placed, recurring)
    release(keyed.sparkSession)
    return made


def drop_template_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, long_tokens: int | None = None, counts: tuple[str, str] | None = None
) -> DataFrame:
    """The documents without the lines of recurring templates; ``counts`` names columns for their lines and dropped lines."""
    others = [c for c in docs.columns if c != "text"]
    inner = docs.select("text", F.col("doc_id").alias("doc_id"), F.struct(*others).alias("others"))
    keyed = with_row_key(inner, "row")
    gone = dropped_lines(keyed.select("row", "doc_id", "text"), min_docs, min_tokens, long_tokens)
    cut = keyed.select("row", "others", _lines(F.col("text")).alias("lines"))
    joined = cut.join(gone.hint("merge"), "row", "left")  # alike at every size
    # Places left, by one hash set a document; then lines by place.
    left = joined.withColumn("left", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("gone", F.array().cast("array<int>"))))
    kept = F.array_join(F.transform("left", lambda at: F.get("lines", at)), "\n")
    kept = F.when(F.col("lines").isNull(), None).when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(kept)
    n_lines = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long")
    n_dropped = F.coalesce(F.array_size("gone"), F.lit(0)).cast("long")
    made = left.select("others", kept.alias("text"), n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))
    columns = [F.col("text") if c == "text" else F.col("others")[c].alias(c) for c in docs.columns]
    return made.select(*columns, *(F.col(c).alias(name) for c, name in zip(("n_lines", "n_dropped"), counts or ())))


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = drop_template_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=("n_lines", "n_dropped"))
    return left.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents
), lines AS (
  SELECT rid, doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM docs
), masked AS (
  SELECT rid, doc_id, text, pos, regexp_replace(line, '[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*', '<*>', 'g') AS line FROM lines
), occ AS (
  SELECT *, row(doc_id IS NULL, coalesce(doc_id, 0), pos) AS place, regexp_extract(line, '^[\x20\x09-\x0D]*((?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]*){1,3})', 1) AS lead
  FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM masked) WHERE n >= 3
), by_line AS (
  SELECT n, lead, line, count(DISTINCT text) AS n_docs FROM occ GROUP BY n, lead, line
), live AS (
  SELECT * FROM (SELECT *, sum(n_docs) OVER (PARTITION BY n, lead) AS texts FROM by_line) WHERE texts >= 3
), words AS (
  SELECT n, lead, line, n_docs, texts, unnest(ws) AS word, generate_subscripts(ws, 1) AS k
  FROM (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM live)
), constants AS (
  SELECT n, lead, k, word FROM words WHERE k > 3 GROUP BY n, lead, k, word HAVING sum(n_docs) >= greatest(3, ceil(max(texts) / 20))
), shapes AS (
  SELECT n, lead, line, string_agg(CASE WHEN k <= 3 OR c.word IS NOT NULL THEN w.word ELSE '<*>' END, ' ' ORDER BY k) AS shape,
         count(*) FILTER (k > 3 AND w.word = '<*>') AS fields, count(*) FILTER (k > 3 AND c.word IS NULL AND w.word <> '<*>') AS varied
  FROM words w LEFT JOIN constants c USING (n, lead, k, word) GROUP BY n, lead, line
), templates AS (
  SELECT n, lead, line, CASE WHEN n > 3 AND varied * 100 <= (n - 3 - fields) * 30 THEN 'shape ' || shape ELSE 'line ' || line END AS template FROM shapes
), placed AS (
  SELECT o.rid, o.pos, o.text, o.place, o.n, o.lead, t.template FROM occ o JOIN templates t USING (n, lead, line)
), recurring AS (
  SELECT n, lead, template, min(place) AS first FROM placed GROUP BY n, lead, template HAVING count(DISTINCT text) >= 3
), gone AS (
  SELECT rid, pos FROM placed JOIN recurring USING (n, lead, template) WHERE place <> first
), rebuilt AS (
  SELECT l.rid, count(*) AS n_lines, count(g.pos) AS n_dropped,
         coalesce(string_agg(CASE WHEN g.pos IS NULL THEN l.line END, chr(10) ORDER BY l.pos), '') AS kept
  FROM lines l LEFT JOIN gone g ON l.rid = g.rid AND l.pos = g.pos GROUP BY l.rid
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, md5(kept) AS text_md5
FROM docs LEFT JOIN rebuilt USING (rid)
"""
