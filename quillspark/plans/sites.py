"""Queries over the pages of an archive site, and what a selection of them downloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions import formats, web
from quillspark.operators import archive, crawl
from quillspark.plans import inputs
from quillspark.plans.base import query
from quillspark.sources import sinks

# ---- what the SQL shares: functions of SQL texts for URLs u, labels l, bases b, years y and months m ----

#: How an archive's paths and labels name months and years.
_MONTHS = "Janvier|Fevrier|Février|Mars|Avril|Mai|Juin|Juillet|Aout|Août|Septembre|Octobre|Novembre|Decembre|Décembre"
_PLAIN = ("janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre")
_SHOWN = ("Janvier", "Février", "Mars", "Avril", "Mai", "Juin", "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre")
_Y = r"(?:19|20)\d{2}"
_SEGMENT = rf"(?:Annee-{_Y}|Les-recueils-des-actes-administratifs-annee-{_Y}|Raa-[^/]+?-{_Y})"
_YEAR_OF_SEGMENT = r"(?:Annee-|Les-recueils-des-actes-administratifs-annee-|Raa-[^/]+?-)((?:19|20)\d{2})"


def _bare(u: str) -> str:
    return f"regexp_replace({u}, '[?#].*$', '')"


def _path(u: str) -> str:
    return f"regexp_extract({_bare(u)}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(/.*)$', 1)"


def _origin(u: str) -> str:
    return f"lower(regexp_extract({u}, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1))"


def _pdf(u: str) -> str:
    return rf"(regexp_matches({u}, '(?i)\.pdf(?:$|[?#])') OR regexp_matches({u}, '(?i)/(?:i?re)?contenu/telechargement/'))"


def _year_link(u: str, lab: str, b: str) -> str:
    return rf"({_bare(u)} <> {_bare(b)} AND (regexp_matches({_path(u)}, '(?i)/{_SEGMENT}/?$') OR regexp_matches({lab}, '(?i)ann[éeÉ]e\s+{_Y}')))"


def _month_link(u: str, lab: str) -> str:
    by_path = rf"regexp_matches({_path(u)}, '(?i)(?:{_MONTHS})(?:-\d{{4}})?/?$')"
    return f"(NOT {_pdf(_bare(u))} AND ({by_path} OR regexp_matches({lab}, '(?i)(?:^|[^A-Za-z0-9_])(?:{_MONTHS})(?:$|[^A-Za-z0-9_])')))"


def _year(u: str, lab: str) -> str:
    return (
        rf"coalesce(CAST(regexp_extract_all({_path(u)} || '/', '(?i)(?:^|/){_YEAR_OF_SEGMENT}/', 1)[-1] AS INT), "
        rf"CAST(regexp_extract_all({lab}, '{_Y}')[-1] AS INT), "
        rf"CAST(regexp_extract_all({u} || ' ' || {lab} || ' ', '(?:^|[^\d])({_Y})[^\d]', 1)[-1] AS INT), 0)"
    )


def _month(u: str, lab: str) -> str:
    return "CASE " + " ".join(f"WHEN contains(strip_accents(lower({u} || ' ' || {lab})), '{m}') THEN {i + 1}" for i, m in enumerate(_PLAIN)) + " ELSE 0 END"


def _kind(u: str) -> str:
    return (
        f"CASE WHEN regexp_matches({_path(u)}, '(?i)/(?:Annee-{_Y}|Raa-[^/]+?-{_Y})/.') THEN 'month' WHEN regexp_matches({_path(u)}, '(?i)/{_SEGMENT}/?$') THEN 'year' "
        f"WHEN regexp_matches({_path(u)}, '(?i)/(?:{_MONTHS})(?:-{_Y})?/?$') THEN 'month' "
        f"WHEN regexp_matches({_path(u)}, '(?i)(?:^|/)Annee-{_Y}(?:/|$)|Raa-[^/]+?-{_Y}') THEN 'year' ELSE 'root' END"
    )


def _context(u: str) -> str:
    return f"lower(regexp_extract({_path(u)}, '(?i)/({_SEGMENT})(?:/|$)', 1))"


def _hint(u: str) -> str:
    return f"regexp_matches(lower({_path(u)}), 'recueil-des-actes-administratifs|(?:^|[^A-Za-z0-9_])raa(?:$|[^A-Za-z0-9_])|documents-publications|documents\\+et\\+publications')"


def _label(m: str, y: str, fallback: str) -> str:
    names = "[" + ", ".join(f"'{n}'" for n in _SHOWN) + "]"
    return f"CASE WHEN {m} > 0 AND {y} > 0 THEN {names}[{m}] || ' ' || CAST({y} AS STRING) ELSE {fallback} END"


def _key(m: str, y: str) -> str:
    return f"(CAST({y} AS STRING) || '-' || lpad(CAST({m} AS STRING), 2, '0'))"


def _path_year(u: str) -> str:
    return rf"CAST(regexp_extract_all({_path(u)} || ' ', '(20\d{{2}})[^\d]', 1)[-1] AS INT)"


def _no_slash(u: str) -> str:
    return f"regexp_replace(trim({u}), '/$', '')"


_SITE = inputs.SITE_SQL
_PAGES = f"SELECT page_id, {inputs.SITE_BASE} AS base, {inputs.SITE_HEADING} AS heading FROM pages"
_START = "https://www.prefecture-test.fr/Publications/Recueil-des-actes-administratifs"


@query("site_pages", f"""
SELECT page_id, {_kind('base')} AS kind, {_context('base')} AS context, {_hint('base')} AS official, {_path_year('base')} AS path_year,
       coalesce(CAST(nullif(regexp_extract(heading, '(19\\d{{2}}|20\\d{{2}})', 1), '') AS INT), 0) AS first_year,
       CASE WHEN {_hint('base')} THEN {_no_slash('base')} ELSE '{_START}' END AS start,
       'Année ' || CAST({_year('base', "''")} AS STRING) || CASE WHEN regexp_matches(base, '(?i)Raa-du-departement-de-([^/]+?)-\\d{{4}}')
         THEN ' · ' || replace(regexp_extract(base, '(?i)Raa-du-departement-de-([^/]+?)-\\d{{4}}', 1), '-', ' ') ELSE '' END AS label
FROM ({_PAGES})
""")  # fmt: skip
def _site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("base")
    return inputs.site_pages(spark, sf_dir).select(
        "page_id", web.page_kind(base).alias("kind"), web.year_context(base).alias("context"), web.looks_official(base).alias("official"),
        web.year_in_path(base).alias("path_year"), web.first_year(F.col("heading")).alias("first_year"), web.start_url(base, _START).alias("start"),
        web.year_label(base, web.year_of(base, F.lit(""))).alias("label"),
    )


_YEARS = f"""
SELECT page_id, url, label, year, CAST(row_number() OVER (PARTITION BY page_id ORDER BY year DESC, pos) AS INT) AS place FROM (
  SELECT page_id, url, min(pos) AS pos, arg_min(label, pos) AS label, arg_min({_year('url', 'label')}, pos) AS year
  FROM ({_SITE}) WHERE {_year_link('url', 'label', 'base')} AND {_origin('url')} = {_origin('base')} GROUP BY page_id, url
) WHERE year > 0
"""


@query("site_years", _YEARS)
def _site_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.year_links(inputs.site_links(spark, sf_dir)).drop("base")


_OFFICIAL = f"""
WITH found AS (
  SELECT page_id, {_no_slash('url')} AS url, pos, label, coalesce(CAST(nullif(regexp_extract(label, '(20\\d{{2}})', 1), '') AS INT), {_path_year('url')}) AS year
  FROM ({_SITE}) WHERE {_origin('url')} = {_origin('base')} AND {_hint('url')}
), years AS (
  SELECT page_id, url, arg_min(label, pos) AS label, arg_min(year, pos) AS year FROM found WHERE year IS NOT NULL GROUP BY page_id, url
)
SELECT page_id, url, coalesce(nullif(label, ''), 'Année ' || CAST(year AS STRING)) AS label, year FROM years
UNION ALL
SELECT page_id, {_no_slash('base')}, 'Année ' || CAST(year AS STRING), year FROM (
  SELECT *, coalesce({_path_year('base')}, CAST(nullif(regexp_extract(heading, '(20\\d{{2}})', 1), '') AS INT)) AS year FROM ({_PAGES})
) WHERE year IS NOT NULL AND {_hint('base')} AND page_id NOT IN (SELECT page_id FROM years)
"""


@query("site_official_years", _OFFICIAL)
def _site_official(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.official_years(inputs.site_links(spark, sf_dir), inputs.site_pages(spark, sf_dir))


def _once(rows: str, order: str) -> str:
    return f"""
SELECT page_id, url, label, year, month, month_key, CAST(row_number() OVER (PARTITION BY page_id ORDER BY {order}, strip_accents(lower(label)), pos) AS INT) AS place FROM (
  SELECT page_id, url, month_key, min(pos) AS pos, arg_min(year, pos) AS year, arg_min(month, pos) AS month, arg_min({_label('month', 'year', "coalesce(nullif(label, ''), 'Mois ' || CAST(month AS STRING))")}, pos) AS label
  FROM (SELECT *, {_key('month', 'year')} AS month_key FROM ({rows})) GROUP BY page_id, url, month_key)"""


_BRANCH = (
    f"(starts_with(regexp_replace({_path('url')}, '/+$', '') || '/', regexp_replace({_path('base')}, '/+$', '') || '/') "
    f"OR CASE WHEN {_context('base')} <> '' THEN {_context('url')} = {_context('base')} ELSE own = 0 OR {_year('url', 'label')} = own END)"
)
_MONTH_ROWS = f"""
SELECT *, CASE WHEN {_year('url', 'label')} > 0 THEN {_year('url', 'label')} ELSE own END AS year, {_month('url', 'label')} AS month FROM (
  SELECT page_id, pos, base, {_bare('url')} AS url, label, {_year('base', "''")} AS own FROM ({_SITE}))
WHERE url <> {_bare('base')} AND NOT {_year_link('url', 'label', 'base')} AND {_month_link('url', 'label')} AND {_BRANCH}"""
_MONTH_LINKS = _once(f"SELECT * FROM ({_MONTH_ROWS}) WHERE month > 0 AND (own = 0 OR year = own)", "month")


@query("site_month_links", _MONTH_LINKS)
def _site_month_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.month_links(inputs.site_links(spark, sf_dir))


_COLLECTION_ROWS = f"""
SELECT *, {_year('url', 'label')} AS year, {_month('url', 'label')} AS month FROM (SELECT page_id, pos, base, {_bare('url')} AS url, label FROM ({_SITE}))
WHERE starts_with(url, regexp_replace({_bare('base')}, '/+$', '') || '/') AND {_month_link('url', 'label')} AND {_origin('url')} = {_origin('base')}"""
_COLLECTIONS = _once(f"SELECT * FROM ({_COLLECTION_ROWS}) WHERE year > 0 AND month > 0", "year DESC, month")


@query("site_collection_months", _COLLECTIONS)
def _site_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.collection_months(inputs.site_links(spark, sf_dir))


_MONTHS_SQL = f"""
WITH p AS (SELECT DISTINCT page_id, base, {_kind('base')} AS kind, {_year('base', "''")} AS own FROM ({_SITE})
), m AS (SELECT p.page_id, base, kind, own AS year, month, url, label FROM ({_MONTH_LINKS}) l JOIN p USING (page_id) WHERE kind = 'year'
), every AS (
  SELECT page_id, base, kind, own AS year, {_month('base', "''")} AS month, {_bare('base')} AS url,
         {_label(_month('base', "''"), 'own', f"'Mois ' || CAST({_month('base', chr(39) * 2)} AS STRING)")} AS label FROM p WHERE kind = 'month'
  UNION ALL SELECT * FROM m
  UNION ALL SELECT page_id, base, kind, own, 0, {_bare('base')}, 'PDF directs ' || CAST(own AS STRING) FROM p
    WHERE kind = 'year' AND page_id NOT IN (SELECT page_id FROM m)
      AND page_id IN (SELECT page_id FROM ({_SITE}) WHERE {_pdf('url')} AND {_origin('url')} = {_origin('base')})
  UNION ALL SELECT p.page_id, base, kind, year, month, url, label FROM ({_COLLECTIONS}) c JOIN p USING (page_id)
    WHERE kind = 'root' AND p.page_id NOT IN (SELECT page_id FROM ({_YEARS}))
)
SELECT page_id, kind, year, 'Année ' || CAST(year AS STRING) || CASE WHEN regexp_matches(base, '(?i)Raa-du-departement-de-([^/]+?)-\\d{{4}}')
         THEN ' · ' || replace(regexp_extract(base, '(?i)Raa-du-departement-de-([^/]+?)-\\d{{4}}', 1), '-', ' ') ELSE '' END AS year_label,
       month, {_key('month', 'year')} AS month_key, url, label, url AS selection FROM every
"""


@query("site_months", _MONTHS_SQL)
def _site_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.site_months(inputs.site_links(spark, sf_dir))


@query("site_errors", f"""
WITH p AS (SELECT DISTINCT page_id, base, {_kind('base')} AS kind FROM ({_SITE})), months AS ({_MONTHS_SQL})
SELECT page_id, CASE WHEN kind = 'year' THEN 'Aucun mois valide trouvé pour ' || CAST({_year('base', "''")} AS STRING) || '.'
                     ELSE 'Aucune année RAA détectée sur la page racine.' END AS error
FROM p WHERE page_id NOT IN (SELECT page_id FROM months) AND (kind = 'year' OR kind = 'root' AND page_id NOT IN (SELECT page_id FROM ({_YEARS})))
""")  # fmt: skip
def _site_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = inputs.site_links(spark, sf_dir)
    return crawl.pages_without_months(links, crawl.site_months(links))


@query("site_year_list", f"SELECT year, CAST(row_number() OVER (ORDER BY year DESC) AS INT) AS place FROM (SELECT DISTINCT year FROM ({_MONTHS_SQL}) WHERE year > 0)")
def _year_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years once each, latest first; a row a year, few enough for one task."""
    years = crawl.site_months(inputs.site_links(spark, sf_dir)).where("year > 0").select("year").distinct()
    return years.withColumn("place", F.row_number().over(Window.orderBy(F.desc("year"))))


_DOCUMENTS = f"""
SELECT page_id, url, pos, coalesce(nullif(label, ''), regexp_extract({_path('url')}, '([^/]+)/*$', 1)) AS title FROM (
  SELECT page_id, url, min(pos) AS pos, arg_min(label, pos) AS label FROM ({_SITE}) WHERE {_pdf('url')} AND {_origin('url')} = {_origin('base')} GROUP BY page_id, url)"""
_PAGE_MONTHS = f"SELECT page_id, min(month_key) AS month_key, min(year) AS year FROM ({_MONTHS_SQL}) GROUP BY page_id"


def _page_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of pages under the first month that a page contributes."""
    links = inputs.site_links(spark, sf_dir)
    months = crawl.site_months(links).groupBy("page_id").agg(F.min("month_key").alias("month_key"), F.min("year").alias("year"))
    return crawl.page_documents(links).join(months, "page_id")


@query("site_documents", f"SELECT page_id, url, pos, title FROM ({_DOCUMENTS})")
def _site_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.page_documents(inputs.site_links(spark, sf_dir)).drop("base")


_CRAWLED = f"SELECT url, arg_min(title, (-year, month_key, page_id, pos)) AS title, arg_min(month_key, (-year, month_key, page_id, pos)) AS month_key FROM ({_DOCUMENTS}) d JOIN ({_PAGE_MONTHS}) m USING (page_id) GROUP BY url"


def _crawled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents once a site, in the order of a crawl: latest years first, then months, pages and places."""
    order = [-F.col("year"), F.col("month_key"), F.col("page_id"), F.col("pos")]
    return archive.keep_first(_page_documents(spark, sf_dir), ["url"], order).select("url", "title", "month_key")


@query("crawled_documents", _CRAWLED)
def _crawled_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _crawled(spark, sf_dir)


@query("selected_documents", f"SELECT url, title, month_key FROM ({_CRAWLED}) WHERE month_key IN (SELECT month_key FROM ({_MONTHS_SQL}) WHERE year = 2021)")
def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = crawl.site_months(inputs.site_links(spark, sf_dir)).where("year = 2021")
    return crawl.selected(_crawled(spark, sf_dir), months).select("url", "title", "month_key")


_CHOSEN = f"SELECT DISTINCT selection FROM ({_MONTHS_SQL}) WHERE month < 6"


@query("changed_selection", f"""
SELECT selection FROM ({_CHOSEN}) WHERE selection NOT IN (SELECT selection FROM ({_MONTHS_SQL}) WHERE year <> 2020)
UNION SELECT selection FROM ({_MONTHS_SQL}) WHERE year = 2020
""")  # fmt: skip
def _changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = crawl.site_months(inputs.site_links(spark, sf_dir))
    return crawl.changed_selection(months.where("month < 6").select("selection").distinct(), months, 2020)


_HISTORY = "SELECT 'https://www.prefecture-test.fr/contenu/telechargement/' || CAST(event_id % 25 AS STRING) || '/acte.pdf' AS url, ts FROM events WHERE event_type <> 'click'"


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_HISTORY.replace("FROM events", "FROM {events}"), events=inputs.table(spark, sf_dir, "events"))


@query("download_counts", f"SELECT count(*) AS selected, count(h.url) AS downloaded, count(*) - count(h.url) AS pending FROM ({_CRAWLED}) LEFT JOIN (SELECT DISTINCT url FROM ({_HISTORY})) h USING (url)")
def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crawl.counts(_crawled(spark, sf_dir), _history(spark, sf_dir))


@query("latest_downloads", f"SELECT url, strftime(max(ts), '%d/%m/%Y %H:%M:%S') AS downloaded FROM ({_HISTORY}) GROUP BY url ORDER BY max(ts) DESC, url LIMIT 18")
def _latest_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 18 latest downloads: a top-k report."""
    last = _history(spark, sf_dir).groupBy("url").agg(F.max("ts").alias("ts")).orderBy(F.desc("ts"), "url").limit(18)
    return last.select("url", formats.french_time(F.col("ts")).alias("downloaded"))


@query("preview_documents", f"SELECT page_id, pos, url FROM ({_DOCUMENTS}) ORDER BY page_id, pos LIMIT 60")
def _preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 60 documents: a preview."""
    return crawl.page_documents(inputs.site_links(spark, sf_dir)).select("page_id", "pos", "url").orderBy("page_id", "pos").limit(60)


_AROUND = "label || CASE pos % 3 WHEN 0 THEN ' du 03/0' || CAST(1 + pos % 9 AS STRING) || '/2021 (1,5 Mo)' WHEN 1 THEN ' 12 ko' ELSE ' 1/2/2021' END"


@query("document_details", f"""
SELECT page_id, pos, date, size, concat_ws(' • ', date, size, nullif(label, '')) AS details, left(replace(regexp_replace(coalesce(nullif(label, ''), 'document'), '[\\\\/:*?"<>|]', '_', 'g'), '  ', ' '), 120) AS folder
FROM (SELECT page_id, pos, label, nullif(regexp_extract(around, '(?:^|[^A-Za-z0-9_])(\\d{{2}}/\\d{{2}}/\\d{{4}})(?:$|[^A-Za-z0-9_])', 1), '') AS date,
        nullif(regexp_replace(regexp_extract(around, '(?i)(?:^|[^A-Za-z0-9_])(\\d+[.,]?\\d*\\s*(?:Ko|Mo|Go))(?:$|[^A-Za-z0-9_])', 1), '\\s*([KkMmGg][Oo])', ' \\1'), '') AS size
      FROM (SELECT *, {_AROUND} AS around FROM ({_SITE})))
""")  # fmt: skip
def _details(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.site_links(spark, sf_dir).withColumn("around", F.expr(_AROUND))
    found = rows.select("page_id", "pos", "label", web.document_date(F.col("around")).alias("date"), web.document_size(F.col("around")).alias("size"))
    details = web.compact(F.coalesce("date", F.lit("")), F.coalesce("size", F.lit("")), F.col("label"))
    return found.select("page_id", "pos", "date", "size", details.alias("details"), web.folder_name(F.col("label")).alias("folder"))


@query("month_labels", f"""
SELECT page_id, pos, {_label('m', 'y', "coalesce(nullif(label, ''), 'Mois ' || CAST(m AS STRING))")} AS month_label FROM (
  SELECT *, CAST((page_id + pos) % 13 AS INT) AS m, CAST(CASE WHEN pos % 2 = 0 THEN 2020 ELSE 0 END AS INT) AS y FROM ({_SITE}))
""")  # fmt: skip
def _month_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, y = F.expr("CAST((page_id + pos) % 13 AS INT)"), F.expr("CAST(CASE WHEN pos % 2 = 0 THEN 2020 ELSE 0 END AS INT)")
    return inputs.site_links(spark, sf_dir).select("page_id", "pos", web.month_label(m, y, F.col("label")).alias("month_label"))


@query("site_map_json", f"""
SELECT year, to_json({{'year': year, 'months': list({{'month_key': month_key, 'n_pages': n}} ORDER BY month_key)}}) AS json
FROM (SELECT year, month_key, count(*) AS n FROM ({_MONTHS_SQL}) GROUP BY year, month_key) GROUP BY year
""")  # fmt: skip
def _json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object a year; a year has few months."""
    months = crawl.site_months(inputs.site_links(spark, sf_dir)).groupBy("year", "month_key").agg(F.count("*").alias("n_pages"))
    nested = months.groupBy("year").agg(F.array_sort(F.collect_list(F.struct("month_key", "n_pages"))).alias("months"))
    return nested.select("year", F.to_json(F.struct("year", "months")).alias("json"))


@query("crawl_settings", """
SELECT event_id, greatest(0, low) AS min_delay, greatest(greatest(0, low), high) AS max_delay, greatest(1000, timeout) AS timeout_ms
FROM (SELECT event_id, coalesce(CASE WHEN event_id % 5 > 0 THEN CAST(event_id % 3000 - 500 AS INT) END, 1200) AS low, coalesce(CASE WHEN event_id % 7 > 0 THEN CAST(event_id % 2500 AS INT) END, 2600) AS high,
             coalesce(CASE WHEN event_id % 3 > 0 THEN CAST(user_id % 2000 AS INT) END, 15000) AS timeout FROM events)
""")  # fmt: skip
def _settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    least = F.expr("CASE WHEN event_id % 5 > 0 THEN CAST(event_id % 3000 - 500 AS INT) END")
    most = F.expr("CASE WHEN event_id % 7 > 0 THEN CAST(event_id % 2500 AS INT) END")
    timeout = F.expr("CASE WHEN event_id % 3 > 0 THEN CAST(user_id % 2000 AS INT) END")
    return inputs.table(spark, sf_dir, "events").select("event_id", formats.settings(least, most, timeout).alias("s")).select("event_id", "s.*")


@query("durations", """
SELECT event_id, CASE WHEN s < 60 THEN printf('%.1fs', s) ELSE printf('%dm %02ds', CAST(floor(s) AS BIGINT) // 60, CAST(floor(s) AS BIGINT) % 60) END AS lasted
FROM (SELECT event_id, CAST(event_id % 7000 AS DOUBLE) / 10 AS s FROM events)
""")  # fmt: skip
def _durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").select("event_id", formats.duration(F.expr("CAST(event_id % 7000 AS DOUBLE) / 10")).alias("lasted"))


@query("page_files", """
WITH p AS (SELECT conv_id, turn + 1 AS page, min(text) AS text FROM conversations GROUP BY 1, 2
), n AS (SELECT conv_id, CAST(max(page) + 1 AS BIGINT) AS total FROM p GROUP BY 1
), i AS (SELECT conv_id, unnest(range(1, total + 1)) AS page FROM n
)
SELECT conv_id, md5(string_agg(chr(10) || '===== PAGE ' || CAST(page AS STRING) || ' =====' || chr(10) || coalesce(text, ''), chr(10) ORDER BY page)) AS file_md5
FROM i LEFT JOIN p USING (conv_id, page) GROUP BY conv_id
""")  # fmt: skip
def _page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.table(spark, sf_dir, "conversations").groupBy("conv_id", (F.col("turn") + 1).alias("page")).agg(F.min("text").alias("text"))
    held = pages.groupBy("conv_id").agg(F.map_from_entries(F.collect_list(F.struct("page", "text"))).alias("pages"), (F.max("page") + 1).alias("total"))
    return held.select("conv_id", F.md5(formats.page_file(F.col("pages"), F.col("total"))).alias("file_md5"))


@query("delays", "SELECT event_id, true AS within FROM events")
def _delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "events").select("event_id", formats.delay(F.lit(1200), F.lit(2600), 7).alias("d"))
    return rows.select("event_id", F.col("d").between(1200, 2600).alias("within"))




@query("api_envelope", f"""
WITH r AS (SELECT id, numero_arrete, objet FROM ({inputs.RAA_ROWS}))
SELECT '{{"success":true,"count":' || CAST(count(*) AS STRING) || ',"raa_exemples":[' AS line FROM r
UNION ALL SELECT CASE WHEN row_number() OVER (ORDER BY id) > 1 THEN ',' ELSE '' END || to_json({{'id': id, 'numero_arrete': numero_arrete, 'objet': objet}}) FROM r
UNION ALL SELECT ']}}'
""")  # fmt: skip
def _envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.raa_rows(spark, sf_dir).select("id", "numero_arrete", "objet")
    return sinks.envelope(rows, [F.col("id")]).select("line")
