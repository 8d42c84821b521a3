"""From the links of an archive's pages to its years, months and documents.

Pages come with their base (their own URL), links with the page's base, their
place, absolute URL and label. Fetching is left to a source of pages; a level of
the site follows from the one above it by a join on the URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import web
from quillspark.operators.archive import keep_first


def of_origin(links: DataFrame, only: bool = True) -> DataFrame:
    """Links to the site of their page alone, if asked for."""
    return links.where(web.origin_of(F.col("url")) == web.origin_of(F.col("base"))) if only else links


def year_links(links: DataFrame, same_origin: bool = True) -> DataFrame:
    """page_id, base, url, label, year, place: the years that pages link to, each URL once, latest first."""
    found = of_origin(links.where(web.is_year_link(F.col("url"), F.col("label"), F.col("base"))), same_origin)
    once = keep_first(found, ["page_id", "url"], [F.col("pos")]).withColumn("year", web.year_of(F.col("url"), F.col("label"))).where("year > 0")
    order = Window.partitionBy("page_id").orderBy(F.desc("year"), "pos")
    return once.select("page_id", "base", "url", "label", "year", F.row_number().over(order).alias("place"))


def official_years(links: DataFrame, pages: DataFrame) -> DataFrame:
    """page_id, url, label, year: years of gazette pages on the same site; of a page without any, the page itself.

    ``pages`` has page_id, base and heading; a page's year is its path's, else its heading's.
    """
    modern = lambda text: F.regexp_extract(text, r"(20\d{2})", 1).try_cast("int")
    found = of_origin(links).where(web.looks_official(F.col("url")))
    found = found.withColumn("year", F.coalesce(modern(F.col("label")), web.year_in_path(F.col("url")))).where("year IS NOT NULL").withColumn("url", web.without_slash(F.col("url")))
    label = F.coalesce(F.nullif(F.col("label"), F.lit("")), F.concat(F.lit("Année "), F.col("year").cast("string")))
    once = keep_first(found, ["page_id", "url"], [F.col("pos")]).select("page_id", "url", label.alias("label"), "year")
    alone = pages.join(once.select("page_id").distinct(), "page_id", "left_anti")
    own = alone.withColumn("year", F.coalesce(web.year_in_path(F.col("base")), modern(F.col("heading")))).where(F.col("year").isNotNull() & web.looks_official(F.col("base")))
    return once.union(own.select("page_id", web.without_slash(F.col("base")), F.concat(F.lit("Année "), F.col("year").cast("string")), "year"))


def month_links(links: DataFrame) -> DataFrame:
    """page_id, url, label, year, month, month_key, place: the months that a year's page links to.

    Not the page itself, not years or documents; of the page's branch and, where it has one, its year.
    """
    own = web.year_of(F.col("base"), F.lit(""))
    rows = links.withColumn("url", web.strip_suffix(F.col("url"))).withColumn("own", own)
    kept = rows.where((F.col("url") != web.strip_suffix(F.col("base"))) & ~web.is_year_link(F.col("url"), F.col("label"), F.col("base")) & web.is_month_link(F.col("url"), F.col("label")))
    kept = kept.where(web.in_branch(F.col("url"), F.col("label"), F.col("base"), F.col("own")))
    inferred = web.year_of(F.col("url"), F.col("label"))
    made = kept.withColumn("year", F.when(inferred > 0, inferred).otherwise(F.col("own"))).withColumn("month", web.month_of(F.col("url"), F.col("label")))
    return _months(made.where((F.col("month") > 0) & ((F.col("own") == 0) | (F.col("year") == F.col("own")))), [F.col("month")])


def collection_months(links: DataFrame, same_origin: bool = True) -> DataFrame:
    """page_id, url, label, year, month, month_key, place: months of all years below a page that lists months alone."""
    rows = links.withColumn("url", web.strip_suffix(F.col("url")))
    below = F.concat(F.regexp_replace(web.strip_suffix(F.col("base")), "/+$", ""), F.lit("/"))
    kept = of_origin(rows.where(F.startswith(F.col("url"), below) & web.is_month_link(F.col("url"), F.col("label"))), same_origin)
    made = kept.withColumn("year", web.year_of(F.col("url"), F.col("label"))).withColumn("month", web.month_of(F.col("url"), F.col("label")))
    return _months(made.where("year > 0 AND month > 0"), [F.desc("year"), F.col("month")])


def _months(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Months once a key and URL, labelled, in order."""
    made = rows.withColumn("month_key", web.month_key(F.col("month"), F.col("year"))).withColumn("label", web.month_label(F.col("month"), F.col("year"), F.col("label")))
    once = keep_first(made, ["page_id", "month_key", "url"], [F.col("pos")])
    place = F.row_number().over(Window.partitionBy("page_id").orderBy(*order, F.collate("label", "fr"), "pos"))
    return once.select("page_id", "url", "label", "year", "month", "month_key", place.alias("place"))


def page_documents(links: DataFrame, same_origin: bool = True) -> DataFrame:
    """page_id, base, url, title, pos: the documents that pages link to, each once a page."""
    found = of_origin(links.where(web.is_pdf(F.col("url"))), same_origin)
    once = keep_first(found, ["page_id", "url"], [F.col("pos")])
    return once.select("page_id", "base", "url", F.coalesce(F.nullif(F.col("label"), F.lit("")), web.file_name(F.col("url"))).alias("title"), "pos")


def site_months(links: DataFrame, same_origin: bool = True) -> DataFrame:
    """page_id, kind, year, year_label, month, month_key, url, label, selection: what each page contributes to the site's map.

    A month's page is a month of its URL's year. A year's page has its months, or, without
    any, its own documents as month 00; one with neither contributes nothing. A root has the
    months below it, if it links to no years, which are pages of their own.
    """
    pages = links.select("page_id", "base").distinct().withColumn("kind", web.page_kind(F.col("base"))).withColumn("own", web.year_of(F.col("base"), F.lit("")))
    single = pages.where("kind = 'month'").withColumn("month", web.month_of(F.col("base"), F.lit("")))
    single = single.select("page_id", "kind", F.col("own").alias("year"), "month", web.strip_suffix(F.col("base")).alias("url"), web.month_label(F.col("month"), F.col("own")).alias("label"))
    months = month_links(links).join(pages.where("kind = 'year'"), "page_id").select("page_id", "kind", F.col("own").alias("year"), "month", "url", "label")
    documents = page_documents(links, same_origin).select("page_id").distinct()
    direct = pages.where("kind = 'year'").join(months.select("page_id").distinct(), "page_id", "left_anti").join(documents, "page_id", "left_semi")
    direct_label = F.concat(F.lit("PDF directs "), F.col("own").cast("string"))
    direct = direct.select("page_id", "kind", F.col("own").alias("year"), F.lit(0).alias("month"), web.strip_suffix(F.col("base")).alias("url"), direct_label.alias("label"))
    roots = pages.where("kind = 'root'").join(year_links(links, same_origin).select("page_id").distinct(), "page_id", "left_anti")
    below = collection_months(links, same_origin).join(roots.select("page_id", "kind"), "page_id").select("page_id", "kind", "year", "month", "url", "label")
    every = single.union(months).union(direct).union(below).join(pages.select("page_id", "base"), "page_id")
    key = web.month_key(F.col("month"), F.col("year"))
    return every.select(
        "page_id", "kind", "year", web.year_label(F.col("base"), F.col("year")).alias("year_label"), "month", key.alias("month_key"), "url", "label",
        web.selection_key(F.col("url"), F.col("year"), key).alias("selection"),
    )


def pages_without_months(links: DataFrame, months: DataFrame) -> DataFrame:
    """page_id and error of pages of years with neither months nor documents, and of roots with neither years nor months."""
    pages = links.select("page_id", "base").distinct().withColumn("kind", web.page_kind(F.col("base")))
    years = year_links(links).select("page_id").distinct().withColumn("has_years", F.lit(True))
    left = pages.join(months.select("page_id").distinct(), "page_id", "left_anti").join(years, "page_id", "left")
    said = F.when(F.col("kind") == "year", F.concat(F.lit("Aucun mois valide trouvé pour "), web.year_of(F.col("base"), F.lit("")).cast("string"), F.lit(".")))
    said = said.when((F.col("kind") == "root") & F.col("has_years").isNull(), "Aucune année RAA détectée sur la page racine.")
    return left.select("page_id", said.alias("error")).where("error IS NOT NULL")


def selected(documents: DataFrame, months: DataFrame, key: str = "month_key") -> DataFrame:
    """Documents of the months chosen."""
    return documents.join(months.select(key).distinct(), key, "left_semi")


def changed_selection(chosen: DataFrame, months: DataFrame, year: int) -> DataFrame:
    """selection: the keys chosen, without those of other years and with all of the given one."""
    of_other = months.where(F.col("year") != year).select("selection")
    return chosen.select("selection").join(of_other.distinct(), "selection", "left_anti").union(months.where(F.col("year") == year).select("selection")).distinct()


def counts(documents: DataFrame, history: DataFrame) -> DataFrame:
    """One row: documents selected, downloaded before, and pending."""
    seen = history.select("url").distinct().withColumn("seen", F.lit(1))
    n, done = F.count("*"), F.count("seen")
    return documents.join(seen, "url", "left").agg(n.alias("selected"), done.alias("downloaded"), (n - done).alias("pending"))
