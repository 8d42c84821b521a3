"""Entry points for spark-submit: ``run.py COMMAND IN OUT``.

clean: folder of texts to cleaned acts as files; anonymise, unpage, rejoin: texts
to texts; extract: texts to fields, JSON and tagged texts; crawl: a table of
pages (page_id, url, html) to a site's months, documents and pages with errors.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import extract, rules
from quillspark.operators import acts, archive, crawl, steps
from quillspark.sources import files, sinks


def clean(spark: SparkSession, source: str, target: str) -> None:
    """Cleaned texts, and a file for each act of each text."""
    texts = steps.cleaned(files.read_texts(spark, source, recursive=True), "text").select("path", "text")
    texts.write.mode("overwrite").parquet(f"{target}/texts")
    texts = spark.read.parquet(f"{target}/texts")
    heads = texts.select("path", acts.header(F.col("text")).alias("head"), acts.summary(F.col("text")).alias("listed"))
    found = acts.split_acts(texts, "path", "text")
    joined = found.join(heads, found.source == heads.path)
    name = sinks.stem_of(F.col("source")).alias("source")
    sinks.write_acts(joined.select(name, "index", acts.act_file(F.col("head"), F.col("listed"), F.col("contenu")).alias("file")), f"{target}/acts")


def _texts(change: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str, str], None]:
    def run(spark: SparkSession, source: str, target: str) -> None:
        changed = change(files.read_texts(spark, source, recursive=True).select("path", "text"))
        sinks.write_texts(changed.select(sinks.stem_of(F.col("path")).alias("stem"), "text"), target)

    return run


def extracted(spark: SparkSession, source: str, target: str) -> None:
    """A row of fields, a JSON object and a tagged text for each text."""
    rows = files.read_texts(spark, source, recursive=True).select("path", "text", F.col("text").alias("tagged"))
    found = rows.select("path", "text", "tagged", *extract.fields(F.col("text")))
    json = extract.act_json(F.lit(0), F.col("text"), {n: F.col(n) for n in rules.FIELDS})
    extract.tagged(found.withColumn("json", json), "tagged", list(rules.FIELDS)).write.mode("overwrite").parquet(target)


def page_links(pages: DataFrame) -> DataFrame:
    """page_id, pos, base, url, label of the links of fetched pages (page_id, url, html), resolved against their page."""
    from quillspark.functions import web

    rows = archive.anchors(pages).withColumn("url", web.absolute(F.col("href"), F.col("base")))
    return rows.where("url IS NOT NULL").select("page_id", F.col("pos").cast("long").alias("pos"), "base", "url", "label")


def crawled(spark: SparkSession, source: str, target: str) -> None:
    links = page_links(spark.read.parquet(source))
    months = crawl.site_months(links)
    for name, table in (("months", months), ("documents", crawl.page_documents(links)), ("errors", crawl.pages_without_months(links, months))):
        table.write.mode("overwrite").parquet(f"{target}/{name}")


COMMANDS = {
    "clean": clean, "anonymise": _texts(sinks.anonymized_files), "unpage": _texts(sinks.unpaged_files), "rejoin": _texts(sinks.rejoined_files),
    "extract": extracted, "crawl": crawled,
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("command", choices=sorted(COMMANDS))
    parser.add_argument("source")
    parser.add_argument("target")
    chosen = parser.parse_args(arguments)
    COMMANDS[chosen.command](SparkSession.builder.getOrCreate(), chosen.source, chosen.target)


if __name__ == "__main__":
    main()
