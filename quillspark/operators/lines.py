"""Operators on lines: word boxes to lines, broken lines, line diffs, thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lines_of_boxes(boxes: DataFrame, page: str, gap: int = 15) -> DataFrame:
    """page, line, text: words put to lines; a word within ``gap`` of the word above joins its line.

    ``boxes`` has page, ord (order of recognition), word, x, y. Words of blanks are left out.
    """
    down = Window.partitionBy(page).orderBy("y", "ord", "word")
    words = boxes.where(F.trim("word") != "")
    starts = (F.abs(F.col("y") - F.lag("y").over(down)) >= gap).cast("int")
    numbered = words.withColumn("starts", F.coalesce(starts, F.lit(0))).withColumn("line", F.sum("starts").over(down))
    in_order = F.array_sort(F.collect_list(F.struct("x", "y", "ord", "word")))
    return numbered.groupBy(page, "line").agg(F.array_join(F.transform(in_order, lambda w: w["word"]), " ").alias("text"))


def page_text(lines: DataFrame, page: str) -> DataFrame:
    """page, text: a page's lines in order."""
    in_order = F.array_sort(F.collect_list(F.struct("line", "text")))
    return lines.groupBy(page).agg(F.array_join(F.transform(in_order, lambda r: r["text"]), "\n").alias("text"))


#: Lines that always begin a block.
BLOCK = (
    r"(?U)^\s*$|^Article\s+\d|^ARTICLE\s+\d|^\d+[.)]\s+\S|^[A-ZÀÂÉÈÊÎÔÛÙ]{3,}|^[-•*►]\s+|^Vu\b|^Considérant\b"
    r"|^Le\s+(?:Préfet|Maire|Président)|^ARRÊTÉ|^DÉCISION|^ANNEXE"
)


def repair_line_breaks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, text: lines that go on in the next one joined to it.

    Whether a line begins a block hangs on itself and the line before alone, so
    it is a running sum over the document's lines.
    """
    lines = docs.select(key, F.posexplode(F.split(text, "\n", -1)).alias("at", "line")).withColumn("line", F.regexp_replace("line", r"(?U)\s+$", ""))
    order = Window.partitionBy(key).orderBy("at")
    before = F.lag("line").over(order)
    begins = before.isNull() | (before == "") | F.col("line").rlike(BLOCK) | before.rlike(r"(?U)[.;:!?»]\s*$") | F.col("line").rlike(r"^\p{Lu}")
    blocks = lines.withColumn("begins", begins.cast("int")).withColumn("block", F.sum("begins").over(order))
    in_order = lambda *c: F.array_sort(F.collect_list(F.struct(*c)))
    joined = blocks.groupBy(key, "block").agg(F.array_join(F.transform(in_order("at", "line"), lambda r: r["line"]), " ").alias("line"))
    return joined.groupBy(key).agg(F.array_join(F.transform(in_order("block", "line"), lambda r: r["line"]), "\n").alias("text"))


def otsu_threshold(histogram: DataFrame, image: str) -> DataFrame:
    """image, threshold: the value that parts two classes with the greatest variance between; ``histogram`` has value and n."""
    upto = Window.partitionBy(image).orderBy("value")
    whole = Window.partitionBy(image)
    h = histogram.select(
        image, "value", F.sum("n").over(upto).cast("double").alias("w0"), F.sum(F.col("n") * F.col("value")).over(upto).cast("double").alias("s0"),
        F.sum("n").over(whole).cast("double").alias("w"), F.sum(F.col("n") * F.col("value")).over(whole).cast("double").alias("s"),
    )
    w1 = F.col("w") - F.col("w0")
    apart = F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / w1
    between = F.when((F.col("w0") > 0) & (w1 > 0), F.col("w0") * w1 * apart * apart).otherwise(0.0)
    best = F.max(F.struct(F.round(between, 3).alias("v"), (-F.col("value")).alias("minus")))
    return h.groupBy(image).agg((-best["minus"]).alias("threshold"))


def diff_lines(pairs: DataFrame, key: str, before: str, after: str, step: str) -> DataFrame:
    """key, line, type, before, after, step: changes line by line, as difflib aligns them.

    Alignment has no built-in form; whole documents go to Python in Arrow batches.
    """
    import pyarrow as pa

    def run(batches):
        import difflib

        for batch in batches:
            out = []
            for row in range(batch.num_rows):  # texts of one row at a time become Python's
                k, a, b = (batch.column(i)[row].as_py() for i in range(3))
                old, new = (a or "").splitlines(), (b or "").splitlines()
                for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, old, new, autojunk=False).get_opcodes():
                    if tag == "equal":
                        continue
                    for d in range(max(i2 - i1, j2 - j1)):
                        was = old[i1 + d] if i1 + d < i2 else ""
                        now = new[j1 + d] if j1 + d < j2 else ""
                        out.append((k, i1 + 1 + (d if tag != "insert" else 0), tag, was, now, step))
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int32(), *[pa.string()] * 4]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], [key, "line", "type", "before", "after", "step"])

    return pairs.select(key, before, after).mapInArrow(run, f"{key} long, line int, type string, before string, after string, step string")
