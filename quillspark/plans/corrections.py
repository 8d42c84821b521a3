"""Queries over what the cleaning steps correct."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import audits, cleaning, rules
from quillspark.operators import acts as act_ops
from quillspark.operators import lines
from quillspark.plans import inputs
from quillspark.plans.base import S, query, replaced
from quillspark.plans.registry import SECTION_LINES

_ODD = ["nÂ ° Â fin � l’un “b”", "a​b €c \n\n\n\n\nd", "rien\r\nde plus", "café \x07 x"]


def _differences(a: str, b: str) -> str:
    return f"len(list_filter(list_zip(string_split({a}, ''), string_split({b}, '')), lambda p: p[1] IS DISTINCT FROM p[2]))"


_ENCODING_SQL = f"""
WITH t0 AS (SELECT doc_id, t AS a FROM ({inputs.noisy_sql(_ODD)})
), t1 AS (SELECT *, {replaced("replace(a, 'Â' || chr(160), chr(160))", (f"Â({S})", r"\1"))} AS b FROM t0
), t2 AS (SELECT *, translate(replace(b, chr(65533), ''), '’‘“”–—', '''''\"\"--') AS c FROM t1
), t3 AS (SELECT *, {replaced("c", (r"[^\x20-\x7E\x{00A0}-\x{024F}\x{1E00}-\x{1EFF}\n\t]", ""))} AS d FROM t2
), t4 AS (SELECT *, {replaced("d", (r"\n{4,}", chr(10) * 3))} AS e FROM t3
), n AS (
  SELECT doc_id, 'cleanup_artefacts' AS type, {_differences('a', 'b')} AS n FROM t4 UNION ALL SELECT doc_id, 'corrupted_chars', {_differences('b', 'c')} FROM t4
  UNION ALL SELECT doc_id, 'private_unicode', {_differences('c', 'd')} FROM t4 UNION ALL SELECT doc_id, 'blank_lines', CASE WHEN d <> e THEN 1 ELSE 0 END FROM t4
)"""


@query("encoding_corrections", _ENCODING_SQL + " SELECT doc_id, type, CAST(n AS INT) AS count FROM n WHERE n > 0")
def _encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audits.encoding_corrections(inputs.noisy(spark, sf_dir, _ODD), "t")
    # explode() would put a filter below it that makes all corrections a second time.
    return found.select("doc_id", F.explode_outer("corrections").alias("c")).where("c IS NOT NULL").select("doc_id", "c.*")


@query("encoding_totals", _ENCODING_SQL + " SELECT doc_id, CAST(sum(n) AS INT) AS total_corrections, CAST(count(*) FILTER (n > 0) AS INT) AS categories FROM n GROUP BY doc_id")
def _encoding_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audits.encoding_corrections(inputs.noisy(spark, sf_dir, _ODD), "t").where("t IS NOT NULL")
    return found.select("doc_id", audits.totals(F.col("corrections")).alias("s")).select("doc_id", "s.*")


_LIKE = ["а rticle​ 1­2 “x”", "prix… １２", "Ѕ ‐― о"]
_CLASS = "".join(rules.LOOKALIKES)


@query("lookalike_counts", f"SELECT c AS character, count(*) AS n FROM (SELECT unnest(regexp_extract_all(t, '[{_CLASS}]')) AS c FROM ({inputs.noisy_sql(_LIKE)})) GROUP BY c")
def _lookalikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.noisy(spark, sf_dir, _LIKE).select(F.explode(audits.lookalikes(F.col("t"))).alias("character"))
    return rows.groupBy("character").agg(F.count("*").alias("n"))


@query("unicode_totals", f"SELECT doc_id, CAST(len(f) AS INT) AS total, CAST(len(list_distinct(f)) AS INT) AS kinds FROM (SELECT doc_id, regexp_extract_all(t, '[{_CLASS}]') AS f FROM ({inputs.noisy_sql(_LIKE)}) WHERE t IS NOT NULL)")
def _unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.noisy(spark, sf_dir, _LIKE).where("t IS NOT NULL")
    return rows.select("doc_id", audits.unicode_corrections(F.col("t")).alias("s")).select("doc_id", "s.*")


_COMPOSE = ["été å", "déjà", "ẛ̣ Å"]


@query("clean_s2_composed", f"SELECT doc_id, md5(nfc_normalize(t)) AS composed_md5 FROM ({inputs.noisy_sql(_COMPOSE)})")
def _composed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.noisy(spark, sf_dir, _COMPOSE).withColumn("t", cleaning.composed(F.col("t")))
    return rows.select("doc_id", F.md5("t").alias("composed_md5"))


_WIDE = ["Ａｂ１！　x", "a\r\nb\rc d\u0085e", "rien"]


@query("clean_s1_narrow", f"""
SELECT doc_id, md5({replaced("translate(t, '！ＡＢＣａｂｃ０１２３　', '!ABCabc0123 ')", (r"\r\n?|[\x{0085}\x{2028}\x{2029}]", chr(10)))}) AS cleaned_md5 FROM ({inputs.noisy_sql(_WIDE)})
""")  # fmt: skip
def _narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.noisy(spark, sf_dir, _WIDE).select("doc_id", cleaning.narrow(F.col("t")).alias("t"))
    return rows.select("doc_id", F.md5(cleaning.plain_line_ends(F.col("t"))).alias("cleaned_md5"))


_NAMED = ["d&eacute;j&agrave; &amp;lt; &laquo;x&raquo; &inconnu;", "a & b &eacute", "&eacute; <b>"]


@query("clean_s1_entities", f"""
SELECT doc_id, md5(CASE WHEN contains(t, '<') THEN t ELSE replace(replace(replace(replace(replace(t, '&eacute;', 'é'), '&agrave;', 'à'), '&laquo;', '«'), '&raquo;', '»'), '&amp;', '&') END) AS cleaned_md5
FROM ({inputs.noisy_sql(_NAMED)})
""")  # fmt: skip
def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.noisy(spark, sf_dir, _NAMED).select("doc_id", F.md5(cleaning.decode_entities(F.col("t"))).alias("cleaned_md5"))


_CONTROL = ["a\x07b\x0bc", "x\ty", "\x1f\x7fz"]


@query("clean_s1_controls", f"SELECT doc_id, md5({replaced('t', (chr(91) + r'\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', ''))}) AS cleaned_md5 FROM ({inputs.noisy_sql(_CONTROL)})")
def _controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.noisy(spark, sf_dir, _CONTROL).select("doc_id", F.md5(cleaning.drop_controls(F.col("t"))).alias("cleaned_md5"))


@query("section_missing", f"""
WITH RECURSIVE {SECTION_LINES}
SELECT doc_id, CAST(count(*) AS INT) AS n_sections, array_to_string(list_filter(['VISAS', 'DISPOSITIF', 'ARTICLES', 'SIGNATURE'], lambda x: NOT list_contains(list(label), x)), ' ') AS missing
FROM sections GROUP BY doc_id
""")  # fmt: skip
def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.acts(spark, sf_dir).select("doc_id", act_ops.sections(F.col("act")).alias("s"))
    return rows.select("doc_id", F.size("s").alias("n_sections"), F.array_join(act_ops.missing_labels(F.col("s")), " ").alias("missing"))


@query("diff_json")
def _diff_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON array a document of its differing lines."""
    rows = inputs.acts(spark, sf_dir).select("doc_id", "act", cleaning.fix_structure(F.col("act")).alias("clean"))
    found = lines.diff_lines(rows, "doc_id", "act", "clean", "structure")
    return found.groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("line", "type", "before", "after", "step")))).alias("json"))
