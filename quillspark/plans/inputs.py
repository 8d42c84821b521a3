"""Inputs of the domain made from the driver's tables.

The tables hold invented prose without the domain's patterns, so each query
first builds acts, noisy texts, links or word boxes from them. The expressions
are SQL that Spark and DuckDB read alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.rules import MONTH_NAMES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(key: str, values) -> str:
    quoted = ("'" + v.replace("'", "''") + "'" for v in values)
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(quoted)) + " END"


_MONTH = _case("doc_id % 12", [m.lower() for m in MONTH_NAMES])
_DAY, _YEAR = "CAST(1 + doc_id % 28 AS STRING)", "CAST(2018 + doc_id % 7 AS STRING)"
_NUMBER = f"({_YEAR} || '-' || CAST(1000 + doc_id % 900 AS STRING))"
_SUBJECT = _case("doc_id % 4", ["portant permis", "relatif aux eaux", "fixant un tarif", "portant avis"])
_NAME = _case("doc_id % 4", ["Jean TESTUNE", "TESTDEUX Marie", "Anne Claire TESTTROIS", "Luc Testquatre"])
_TWO = _case("doc_id % 3", ["Art. 2. ", "ARTICLE DEUX : ", "Article 2 - "])
_ONE = _case("doc_id % 3", ["ARTICLE PREMIER : ", "Article 1er. ", "Art. 1 : "])
_NL = "chr(10)"

#: An act of a gazette around a document's text.
ACT = " || ".join([
    "'PREFECTURE DU VAL-TEST'", _NL, "'Recueil ' || CAST(doc_id AS STRING)", _NL,
    f"CASE WHEN doc_id % 3 = 0 THEN 'SOMMAIRE' || {_NL} || 'Page ' || CAST(doc_id % 9 AS STRING) || {_NL} ELSE '' END",
    f"'Arrêté n° ' || {_NUMBER} || ' du ' || {_DAY} || ' ' || {_MONTH} || ' ' || {_YEAR} || ' ' || {_SUBJECT}", _NL,
    "CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'VU le code numéro ' || CAST(doc_id % 11 AS STRING) END", _NL,
    "'CONSIDÉRANT que le Préfet décide'", _NL, "'ARRETE'", _NL,
    _ONE, "'Le PREFET et le MAIRE sont chargés'", _NL, _TWO, f"'Monsieur ' || {_NAME} || ' est nommé'", _NL,
    "CASE WHEN doc_id % 6 = 0 THEN 'Article 4 suite' ELSE 'Article 3 : fin' END", _NL,
    "coalesce(text, '')", _NL,
    f"'Fait à Testville, le ' || {_DAY} || ' ' || {_MONTH} || ' ' || {_YEAR}", _NL,
    f"'Signé : le préfet : Mme ' || {_NAME}",
])


def acts_sql() -> str:
    return f"SELECT doc_id, source, {ACT} AS act FROM documents"


def acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.expr(ACT).alias("act"))


def noisy_sql(marks: list[str]) -> str:
    return f"SELECT doc_id, {_case(f'doc_id % {len(marks)}', marks)} || chr(10) || text AS t FROM documents"


def noisy(spark: SparkSession, sf_dir: str, marks: list[str]) -> DataFrame:
    """doc_id, t: each document's text below one of the given lines."""
    at = F.pmod("doc_id", F.lit(len(marks))).cast("int")
    mark: Column = F.get(F.array(*map(F.lit, marks)), at)
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(mark, F.lit("\n"), "text").alias("t"))


#: Rows of the table of acts, from orders and customers.
RAA_ROWS = f"""
SELECT o_orderkey AS id, CAST(2018 + o_orderkey % 7 AS STRING) || '-' || CAST(o_orderkey AS STRING) AS numero_arrete,
       CAST(o_orderdate AS DATE) AS date_acte, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'Préfet de ' || c_name END AS fonction_signataire,
       'Vu le code ' || o_orderpriority AS base_legale, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE c_mktsegment END AS prefecture,
       CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN '0' ELSE 'le statut ' || o_orderstatus || ' de ' || c_mktsegment END AS objet
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def raa_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: table(spark, sf_dir, t) for t in ("orders", "customer")}
    return spark.sql(RAA_ROWS.replace("FROM orders JOIN customer", "FROM {orders} JOIN {customer}"), **tables)


_K = "(page_id + pos)"
#: Links of an archive site over the anchors of a page.
LINK_URL = "'https://www.prefecture-test.fr' || " + (
    f"CASE {_K} % 6 WHEN 0 THEN '/Publications/Annee-' || CAST(2018 + page_id % 7 AS STRING) "
    f"WHEN 1 THEN '/Publications/Annee-2021/' || {_case('page_id % 12', MONTH_NAMES)} || '-2021' "
    "WHEN 2 THEN '/contenu/telechargement/' || CAST(page_id % 40 AS STRING) || '/acte.pdf' "
    "WHEN 3 THEN '/files/RAA-' || CAST(page_id % 50 AS STRING) || '-2022.PDF?x=1' "
    "WHEN 4 THEN '/Raa-du-departement-de-Test-' || CAST(2018 + pos % 5 AS STRING) ELSE href END"
)
LINK_LABEL = (
    f"CASE {_K} % 5 WHEN 0 THEN 'Année ' || CAST(2018 + page_id % 7 AS STRING) WHEN 1 THEN {_case('page_id % 12', MONTH_NAMES)} || ' 2020' "
    "WHEN 2 THEN 'maintenance du site' ELSE label END"
)

LINKS_SQL = f"""
SELECT page_id, pos, {LINK_URL} AS url, {LINK_LABEL} AS label FROM (
  SELECT page_id, unnest(hs) AS href, unnest(ls) AS label, unnest(range(len(hs))) AS pos FROM (
    SELECT page_id, regexp_extract_all(html, '(?is)<a\\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1) AS hs,
           list_transform(regexp_extract_all(html, '(?is)<a\\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2),
                          lambda l: trim(regexp_replace(regexp_replace(l, '<[^>]*>', '', 'g'), '\\s+', ' ', 'g'))) AS ls
    FROM pages))
"""


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.operators.archive import anchors

    return anchors(table(spark, sf_dir, "pages")).select("page_id", "pos", F.expr(LINK_URL).alias("url"), F.expr(LINK_LABEL).alias("label"))


#: Word boxes of pages from line items.
BOXES = """
SELECT l_orderkey AS page, l_linenumber AS ord, 'w' || CAST(l_partkey AS STRING) AS word,
       CAST(l_suppkey % 97 AS INT) AS x, CAST(l_partkey % 60 AS INT) AS y FROM lineitem
"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BOXES.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))


_PAGE_YEAR = "CAST(2018 + page_id % 7 AS STRING)"
#: Pages of an archive site by page_id: their own URL and heading.
SITE_BASE = "'https://www.prefecture-test.fr' || " + (
    f"CASE page_id % 6 WHEN 0 THEN '/Publications/Annee-' || {_PAGE_YEAR} WHEN 1 THEN '/Raa-du-departement-de-Val-Test-' || {_PAGE_YEAR} || '/' "
    "WHEN 2 THEN '/Publications/Recueil-des-actes-administratifs' WHEN 3 THEN '/Publications/Annee-2021/' || "
    f"{_case('page_id % 12', MONTH_NAMES)} || '-2021' WHEN 4 THEN '/Publications' ELSE '/RAA/' END"
)
SITE_HEADING = "CASE page_id % 4 WHEN 0 THEN 'Recueil 2019 et 2020' WHEN 1 THEN 'Archives 1998' WHEN 2 THEN 'RAA 2023' ELSE '' END"
_FOLDER = "regexp_replace(base, '/+$', '')"
#: Links of such pages: to years, to months below and elsewhere, to documents, to another site.
SITE_URL = (
    "CASE (page_id + pos) % 8 WHEN 0 THEN 'https://www.prefecture-test.fr/Publications/Annee-' || CAST(2018 + pos % 7 AS STRING) "
    f"WHEN 1 THEN {_FOLDER} || '/' || {_case('(page_id + pos) % 12', MONTH_NAMES)} || '-' || {_PAGE_YEAR} "
    "WHEN 2 THEN 'https://www.prefecture-test.fr/contenu/telechargement/' || CAST(page_id % 40 AS STRING) || '/acte.pdf' "
    f"WHEN 3 THEN {_FOLDER} || '/' || {_case('pos % 12', MONTH_NAMES)} || '?page=2' "
    "WHEN 4 THEN 'https://www.prefecture-test.fr/Raa-du-departement-de-Val-Test-' || CAST(2018 + pos % 5 AS STRING) || '/Mars' "
    f"WHEN 5 THEN 'https://www.prefecture-test.fr/Publications/Annee-2021/' || {_case('page_id % 12', MONTH_NAMES)} || '-2021' "
    "WHEN 6 THEN 'https://autre-test.fr/raa/Annee-2020' ELSE base || '#haut' END"
)
SITE_LABEL = (
    f"CASE (page_id + 2 * pos) % 5 WHEN 0 THEN 'Année ' || CAST(2018 + pos % 7 AS STRING) WHEN 1 THEN {_case('pos % 12', MONTH_NAMES)} || ' ' || {_PAGE_YEAR} "
    "WHEN 2 THEN '' WHEN 3 THEN 'Lire la suite' ELSE label END"
)
SITE_SQL = (
    f"SELECT page_id, pos, base, {SITE_URL} AS url, {SITE_LABEL} AS label FROM (SELECT page_id, pos, label, {SITE_BASE} AS base FROM ("
    + LINKS_SQL.replace(LINK_URL, "href").replace(LINK_LABEL, "label")
    + "))"
)


def site_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, pos, base, url, label of the links of a site's pages."""
    from quillspark.operators.archive import anchors

    rows = anchors(table(spark, sf_dir, "pages")).select("page_id", F.col("pos").cast("long").alias("pos"), "label", F.expr(SITE_BASE).alias("base"))
    return rows.select("page_id", "pos", "base", F.expr(SITE_URL).alias("url"), F.expr(SITE_LABEL).alias("label"))


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.expr(SITE_BASE).alias("base"), F.expr(SITE_HEADING).alias("heading"))
