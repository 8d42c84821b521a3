"""What the cleaning steps correct, as records of type and count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import cleaning, rules

RECORDS = "array<struct<type:string,count:int>>"


def _record(kind: str, fires: Column, count: Column) -> Column:
    """An array of one record where a rule fires, else an empty one."""
    made = F.array(F.struct(F.lit(kind).alias("type"), count.cast("int").alias("count")))
    return F.when(fires, made).otherwise(F.array().cast(RECORDS))


def encoding_corrections(rows: DataFrame, column: str) -> DataFrame:
    """The rows with corrections of the encoding step, behind its automatic repair: type and count of each rule that fires.

    Counts are places that differ; rules on line ends count once.
    """
    before, after = F.col("before"), F.col("after")
    differ = cleaning.char_differences(before, after)
    once, found = F.lit(1), F.col("found")
    steps = (
        ("cleanup_artefacts", cleaning.drop_stray_a, differ, found > 0),
        ("corrupted_chars", lambda c: cleaning.straighten_quotes(F.replace(c, F.lit("�"), F.lit(""))), differ, found > 0),
        ("private_unicode", lambda c: cleaning.whitelist(cleaning.sub(c, "[-]", "")), differ, found > 0),
        ("control_chars", cleaning.drop_controls, F.length(before) - F.length(after), before != after),
        ("line_endings", lambda c: cleaning.sub(c, r"\r\n?", "\n"), once, before != after),
        ("blank_lines", lambda c: cleaning.sub(c, r"\n{4,}", "\n\n\n"), once, before != after),
    )
    inner = rows.select(F.struct("*").alias("row"), F.col(column).alias("before"), F.array().cast(RECORDS).alias("made"))
    for kind, rule, count, fires in steps:
        # Counts are columns of their own, lest they be made once for the test and once for the record.
        inner = inner.withColumn("after", rule(F.col("before"))).withColumn("found", count)
        added = _record(kind, (before != after) & fires, found)
        inner = inner.select("row", after.alias("before"), F.concat("made", added).alias("made"))
    return inner.select("row.*", F.col("made").alias("corrections"))


def totals(corrections: Column) -> Column:
    """struct<total_corrections, categories>."""
    total = F.aggregate(corrections, F.lit(0), lambda sum_, c: sum_ + c["count"])
    return F.struct(total.alias("total_corrections"), F.size(corrections).alias("categories"))


def lookalikes(text: Column) -> Column:
    """array<string>: every look-alike character of a text, in order."""
    return F.regexp_extract_all(text, F.lit(f"[{''.join(rules.LOOKALIKES)}]"), F.lit(0))


def unicode_corrections(text: Column) -> Column:
    """struct<total, kinds>: how many look-alike characters a text has, and how many different ones."""
    found = lookalikes(text)
    return F.struct(F.size(found).alias("total"), F.size(F.array_distinct(found)).alias("kinds"))


def structure_corrections(rows: DataFrame, column: str) -> DataFrame:
    """The rows with corrections of titles and articles.

    The record of articles is told by the text before titles were put right, so it
    is there, with a count of 0, where a title alone has changed.
    """
    inner = rows.select(F.struct("*").alias("row"), cleaning.strip_page_numbers(F.col(column)).alias("start"))
    inner = inner.withColumn("titled", cleaning.normalize_act_words(F.col("start")))
    inner = inner.withColumn("numbered", cleaning.normalize_articles(F.col("titled")))
    headings = F.regexp_count("titled", F.lit(cleaning.article_heading()))
    made = F.concat(
        _record("structure_title", F.col("start") != F.col("titled"), F.lit(1)),
        _record("structure_articles", F.col("start") != F.col("numbered"), headings),
    )
    return inner.select("row.*", made.alias("corrections"))
