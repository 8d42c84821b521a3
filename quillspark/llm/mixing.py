"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the budget in proportion to its weight. A source
is never repeated more than ``max_epochs`` times: where its share is above
that, it is clamped and the excess goes to the others by weight, again and
again until no share is above its clamp. A share of e epochs takes each
document floor(e) times, and once more those documents of the source that come
first in a seeded order, until the remaining fraction is used up.

Sources may be as many as they like: they are a table, ranked and weighed by
ranges, and a round of water-filling is a sum over it, of which one row comes
to the driver. Where the fraction of a source ends is found by descending
through bins of the seeded order, so no task sorts more than a sliver of a source.

Edge cases: a null text has no words; rows without a source form a source of
their own, which comes last; an empty table gives an empty result; repeated
rows fall on the same place of the seeded order and share one decision; a
source without words takes none. Extra columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.llm.common import WORD, discard, join_counted, local_table, settle, table, word_count

#: The hash places of the seeded order: 15 hexadecimal digits, taken BIN_DIGITS at a time for LEVELS levels of bins.
PLACE_DIGITS, BIN_DIGITS, LEVELS = 15, 3, 2
#: Tables with a row a source are sent to all tasks up to so many rows, and joined by source beyond.
MOST_SENT, RANKED_ROWS = 50_000, 100_000
KEYS = ["none", "name"]


def place(seed: int, doc_id: Column, text: Column) -> Column:
    """A document's place in the seeded order; a null id goes by its text."""
    key = F.coalesce(doc_id.cast("string"), text, F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key)), 1, PLACE_DIGITS)
    return F.conv(digits, 16, 10).cast("long")


def sized_rows(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, the source as (none, name), size and place of every document."""
    source = F.col("source")
    size, at = word_count(F.col("text")), place(seed, F.col("doc_id"), F.col("text"))
    return docs.select("doc_id", source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name"), size.alias("size"), at.alias("place"))


def of_source(rows: DataFrame, sources: DataFrame, few: bool, spread: list[str]) -> DataFrame:
    """rows with the columns of a settled table of sources, which has n, the rows of each."""
    if few:
        return rows.join(F.broadcast(sources.drop("n")), KEYS)
    return join_counted(rows, sources, KEYS, spread)


def weighed(sized: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """none, name, n, size and weight of every source, settled; in code point order, null last, they weigh ``weights``, repeating."""
    sums = settle(sized.groupBy(*KEYS).agg(F.sum("size").alias("size"), F.count("*").alias("n")))
    ranges = -(-sums.count() // RANKED_ROWS) or 1
    ranged = settle(sums.repartitionByRange(ranges, *KEYS).withColumn("part", F.spark_partition_id()))
    by_part = sorted((r.part, r["count"]) for r in ranged.groupBy("part").count().collect())  # a row a range
    before = [(part, sum(c for _, c in by_part[:k])) for k, (part, _) in enumerate(by_part)]
    offsets = local_table(sized.sparkSession, ("part", "before"), before)
    number = F.row_number().over(Window.partitionBy("part").orderBy(*KEYS)) - 1 + F.col("before")
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(number, F.lit(len(weights))).cast("int"))
    made = settle(ranged.join(F.broadcast(offsets), "part").select(*KEYS, "n", "size", weight.cast("long").alias("weight")))
    discard(sums, ranged)
    return made


def water_fill(sources: DataFrame, max_epochs: int, budget: int | None = None) -> DataFrame:
    """The sources (with size and weight) with target, whole repetitions and quota, the words of the fraction that is left.

    A round clamps the sources whose share is above their clamp. As that raises
    the share of the others, a source once clamped stays so, and the rounds end.
    """
    wide = lambda c: c.cast("decimal(19,0)")
    cap, weight = F.col("size") * max_epochs, F.col("weight")
    sums = sources.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")).head()
    budget = sums["size"] if budget is None else budget
    rest, open_weight, clamped = budget, sums.weight, 0
    while True:
        above = wide(weight) * wide(F.lit(rest)) > wide(cap) * wide(F.lit(open_weight))
        now = sources.agg(F.count_if(above).alias("n"), F.sum(F.when(above, cap)).alias("cap"), F.sum(F.when(~above, weight)).alias("weight")).head()
        if now.n == clamped:
            break
        rest, open_weight, clamped = max(0, budget - now.cap), now.weight or 0, now.n
    part, parts = wide(weight) * wide(F.lit(rest)), F.lit(max(1, open_weight)).cast("long")
    shared = sources.withColumns({"above": above, "part": part, "whole": F.lit(0)})
    whole = F.when(F.col("size") == 0, 0).when(F.col("above"), max_epochs).otherwise(F.expr(f"part div (size * CAST({max(1, open_weight)} AS DECIMAL(19,0)))"))
    shared = shared.withColumn("whole", F.least(whole.cast("long"), F.lit(max_epochs).cast("long")))
    target = F.when(F.col("above"), cap.cast("double")).otherwise(F.col("part").cast("double") / parts)
    left = F.col("part") - wide(F.col("whole")) * wide(F.col("size")) * wide(parts)
    quota = F.when(F.col("above"), 0.0).otherwise(left.cast("double") / parts)
    return shared.select(*sources.columns, target.alias("target"), "whole", quota.alias("quota"))


def fraction_ends(sized: DataFrame, shares: DataFrame, few: bool) -> DataFrame:
    """none, name, n and last: the last place of the seeded order that each source's fraction takes, settled."""
    ends = shares.select(*KEYS, "n", F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("before"), "quota")
    shift, made = 4 * PLACE_DIGITS, None
    for _ in range(LEVELS):
        inside = of_source(sized, ends, few, ["place"]).where(F.shiftright("place", shift) == F.col("bin")) if made is not None else of_source(sized, ends, few, ["place"])
        shift -= 4 * BIN_DIGITS
        by_bin = inside.groupBy(*KEYS, F.shiftright("place", shift).alias("bin")).agg(
            F.sum("size").alias("size"), F.min("before").alias("base"), F.min("quota").alias("quota")
        )
        order = Window.partitionBy(*KEYS).orderBy("bin")  # 16**BIN_DIGITS bins of a source at most
        by_bin = by_bin.withColumn("before", F.col("base") + F.sum("size").over(order) - F.col("size"))
        crossing = by_bin.where("before < quota").groupBy(*KEYS).agg(F.max(F.struct("bin", "before", "quota")).alias("c"))
        further = settle(shares.select(*KEYS, "n").join(crossing, KEYS).select(*KEYS, "n", "c.*"))
        if made is not None:
            discard(made)
        ends = made = further
    inside = of_source(sized, ends, few, ["place"]).where(F.shiftright("place", shift) == F.col("bin"))
    upto = F.col("before") + F.sum("size").over(Window.partitionBy(*KEYS).orderBy("place").rangeBetween(Window.unboundedPreceding, 0))
    fits = 2 * F.col("upto") - F.col("size") <= 2 * F.col("quota")
    reached = inside.withColumn("upto", upto).groupBy(*KEYS).agg(F.max(F.when(fits, F.col("place"))).alias("reached"))
    last = F.coalesce("reached", F.shiftleft("bin", shift) - 1)
    settled = settle(ends.join(reached, KEYS).select(*KEYS, last.alias("last")))
    discard(made)
    return settled


class SourceMix:
    """A fitted mix: a settled row a source with its size, target, whole repetitions and last place of the fraction."""

    def __init__(self, sources: DataFrame, few: bool):
        self.sources, self.few = sources, few

    @staticmethod
    def fit(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, most_sent: int = MOST_SENT) -> "SourceMix":
        """Fit on rows of (none, name, size, place)."""
        sources = weighed(sized, weights)
        few = sources.count() <= most_sent
        shares = settle(water_fill(sources, max_epochs))
        ends = fraction_ends(sized, shares, few)
        fitted = shares.join(ends, KEYS, "left").select(*KEYS, "n", F.col("size").alias("source_size"), "target", "whole", F.coalesce("last", F.lit(-1)).alias("last"))
        fitted = settle(fitted)
        discard(sources, shares, ends)
        return SourceMix(fitted, few)

    def copies(self, rows: DataFrame, spread: list[str]) -> DataFrame:
        """Add source_size, target and copies to rows that have none, name and place."""
        copies = F.col("whole") + F.when(F.col("place") <= F.col("last"), 1).otherwise(0)
        return of_source(rows, self.sources, self.few, spread).withColumn("copies", copies)


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 7, most_sent: int = MOST_SENT) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every document.

    The texts are read once; only a few columns a document are kept for the rest.
    """
    sized = settle(sized_rows(docs, seed))
    mixed = SourceMix.fit(sized, weights, max_epochs, most_sent).copies(sized, ["place"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 7, most_sent: int = MOST_SENT) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with the columns it had.

    Documents without words take no room in the mix; they stay once. The
    decision hangs on a row and its source's share alone, so texts are not
    shuffled where the sources are few enough to be sent.
    """
    sized = settle(sized_rows(docs, seed))
    fitted = SourceMix.fit(sized, weights, max_epochs, most_sent)
    source = F.col("source")
    inner = docs.select(
        F.struct("*").alias("doc"), source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name"),
        word_count(F.col("text")).alias("size"), place(seed, F.col("doc_id"), F.col("text")).alias("place"),
    )
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).cast("int")
    repeated = fitted.copies(inner, ["place"]).select("doc", F.explode(F.array_repeat(F.lit(0), times)).alias("again"))
    return repeated.select("doc.*")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('7|' || coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 15) AS BIGINT) AS place
  FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source
), total AS (SELECT coalesce(sum(source_size), 0)::BIGINT AS t, coalesce(sum(weight), 0)::BIGINT AS w FROM src
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS k FROM src
), prefix AS (
  SELECT o.*, t - coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
         w - coalesce(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS left_w
  FROM ordered o, total
), marked AS (
  SELECT *, bool_and(weight * rest > 3 * source_size * left_w) OVER (ORDER BY k) AS clamped FROM prefix
), open AS (
  SELECT arg_min(rest, k) AS rest, arg_min(left_w, k) AS left_w FROM marked WHERE NOT clamped
), shares AS (
  SELECT source, source_size, clamped,
         CASE WHEN clamped THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(weight * open.rest AS DOUBLE) / open.left_w END AS target,
         CASE WHEN source_size = 0 THEN 0 WHEN clamped THEN 3 ELSE (weight * open.rest) // (open.left_w * source_size) END AS whole,
         CASE WHEN clamped THEN 0.0
              WHEN source_size = 0 THEN CAST(weight * open.rest AS DOUBLE) / open.left_w
              ELSE CAST(weight * open.rest - (weight * open.rest) // (open.left_w * source_size) * open.left_w * source_size AS DOUBLE) / open.left_w END AS quota
  FROM marked LEFT JOIN open ON true
), placed AS (
  SELECT s.doc_id, s.size, h.source_size, h.target, h.whole, h.quota,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized s JOIN shares h ON s.source IS NOT DISTINCT FROM h.source
)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN 2 * upto - size <= 2 * quota AND quota > 0 THEN 1 ELSE 0 END) * size AS BIGINT) AS taken,
       CAST(whole + CASE WHEN 2 * upto - size <= 2 * quota AND quota > 0 THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM placed
"""
