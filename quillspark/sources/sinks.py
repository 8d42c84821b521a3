"""Acts and texts to files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import cleaning, extract
from quillspark.operators import lines


def write_acts(acts: DataFrame, path: str) -> None:
    """One text file a partition of each source and index, so that sources do not overwrite one another."""
    named = acts.select("source", F.format_string("arrete_%03d", "index").alias("act"), F.col("file").alias("value"))
    named.write.mode("overwrite").partitionBy("source", "act").text(path, lineSep="\n")


def write_texts(rows: DataFrame, path: str, stem: str = "stem") -> None:
    """One text file for each stem: rows have the stem and text."""
    rows.select(F.col(stem).alias("stem"), F.col("text").alias("value")).write.mode("overwrite").partitionBy("stem").text(path, lineSep="\n")


def stem_of(path: Column, suffix: str = "") -> Column:
    """A file's path without folder and extension, with a suffix."""
    return F.concat(F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1), F.lit(suffix))


def mirrored(path: Column, suffix: str) -> Column:
    """A file's path with a suffix before its extension."""
    return F.regexp_replace(path, r"^(.*?)(\.[^./]*)?$", f"$1{suffix}$2")


def anonymized_files(texts: DataFrame) -> DataFrame:
    """path, text: the texts with names masked, at their paths with ``_anonymise``."""
    return texts.select(mirrored(F.col("path"), "_anonymise").alias("path"), extract.anonymized(F.col("text")).alias("text"))


def unpaged_files(texts: DataFrame) -> DataFrame:
    """path, text: the texts without page numbers, at their paths with ``_cleaned``."""
    return texts.select(mirrored(F.col("path"), "_cleaned").alias("path"), cleaning.strip_page_numbers(F.col("text")).alias("text"))


def rejoined_files(texts: DataFrame) -> DataFrame:
    """path, text, lines_before, lines_after: the texts with broken lines joined, and how many lines they have."""
    joined = lines.repair_line_breaks(texts, "path", "text").withColumnRenamed("text", "joined")
    count = lambda c: F.size(F.split(c, "\n", -1))
    return texts.join(joined, "path").select("path", F.col("joined").alias("text"), count("text").alias("lines_before"), count("joined").alias("lines_after"))


def write_json(rows: DataFrame, path: str) -> None:
    """One JSON object a line, nulls kept."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def acts_document(acts: DataFrame) -> DataFrame:
    """source, json: one indented object a source with all its acts; acts have source, index and json (an act's members)."""
    listed = F.array_sort(F.collect_list(F.struct("index", "act")))
    rows = acts.groupBy("source").agg(F.count("*").alias("total_arretes"), F.transform(listed, lambda a: a["act"]).alias("arretes"))
    members = F.struct(F.col("source").cast("string").alias("source"), "total_arretes", "arretes")
    return rows.select("source", F.to_json(members, {"pretty": "true", "ignoreNullFields": "false"}).alias("json"))


def envelope(rows: DataFrame, order: list[Column]) -> DataFrame:
    """at, line: the lines of one JSON document {success, count, raa_exemples} with all rows, in their order.

    The rows stay rows, each with the comma before it, so that nothing gathers
    them in one value; written in the order of ``at`` they are the document.
    """
    ranked = rows.select(F.struct(*order).alias("rank"), F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("row"))
    ends = ranked.agg(F.min("rank").alias("first"), F.count("*").alias("n"))  # one row
    body = ranked.join(F.broadcast(ends)).select(
        F.struct(F.lit(1).alias("part"), F.col("rank")).alias("at"), F.concat(F.when(F.col("rank") == F.col("first"), "").otherwise(","), "row").alias("line")
    )
    none = F.lit(None).cast(ranked.schema["rank"].dataType)
    opening = F.concat(F.lit('{"success":true,"count":'), F.col("n").cast("string"), F.lit(',"raa_exemples":['))
    head = ends.select(F.struct(F.lit(0).alias("part"), none.alias("rank")).alias("at"), opening.alias("line"))
    tail = ends.select(F.struct(F.lit(2).alias("part"), none.alias("rank")).alias("at"), F.lit("]}").alias("line"))
    return head.union(body).union(tail)


def error_envelope(message: str) -> str:
    """What is answered where the rows cannot be read."""
    import json

    return json.dumps({"success": False, "erreur": message}, ensure_ascii=False, separators=(",", ":"))
