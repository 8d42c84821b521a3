"""An archive site's links: extraction, first occurrences, site map, downloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import web
from quillspark.functions.cleaning import strip, sub

ANCHOR = r"(?is)<a\b[^>]*?href=\"([^\"]*)\"[^>]*>(.*?)</a>"


def anchors(pages: DataFrame) -> DataFrame:
    """page_id, pos, base, href, label of every link of every page."""
    found = F.arrays_zip(
        F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(2)).alias("label")
    )
    rows = pages.select("page_id", F.col("url").alias("base"), F.posexplode(found).alias("pos", "a"))
    label = strip(sub(sub(F.col("a.label"), "<[^>]*>", ""), r"(?U)\s+", " "))
    return rows.select("page_id", "pos", "base", F.col("a.href").alias("href"), label.alias("label"))


def keep_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; keys are aggregated, not sorted, so hot keys combine early."""
    names = rows.columns
    rank = F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)), *(F.col(c) for c in names))
    return rows.groupBy(*keys).agg(F.min(rank).alias("r")).select(*(F.col(f"r.{c}").alias(c) for c in names))


def pending(docs: DataFrame, history: DataFrame, key: str = "url") -> DataFrame:
    """Documents that the history does not hold."""
    return docs.join(history.select(key).distinct(), key, "left_anti")


def unique_paths(docs: DataFrame, path: str, order: list[Column]) -> DataFrame:
    """Paths made unique by a number before the extension."""
    nth = F.row_number().over(Window.partitionBy(path).orderBy(*order))
    stem, tail = F.regexp_replace(path, r"\.[^./]*$", ""), F.regexp_extract(path, r"(\.[^./]*)$", 1)
    return docs.withColumn(path, F.when(nth > 1, F.concat(stem, F.lit(" ("), (nth - 1).cast("string"), F.lit(")"), tail)).otherwise(F.col(path)))


def months_between(rows: DataFrame, month_key: str, a: str, b: str) -> DataFrame:
    """Rows of months from a to b, whichever is first."""
    return rows.where(F.col(month_key).between(min(a, b), max(a, b)))


def site_map(documents: DataFrame) -> DataFrame:
    """year, month, n_docs: the months of a site with their documents counted; the documents stay rows of their own."""
    return documents.groupBy("year", "month").agg(F.count("*").alias("n_docs"))


def site_summary(documents: DataFrame) -> DataFrame:
    """year, n_months, n_docs, first_month, last_month."""
    return site_map(documents).groupBy("year").agg(
        F.count("*").alias("n_months"), F.sum("n_docs").alias("n_docs"), F.min("month").alias("first_month"), F.max("month").alias("last_month")
    )
