"""Queries over the driver's tables and the SQL they are compared with.

DuckDB's patterns have no lookaround and know ASCII words alone, so oracles
capture what Spark's patterns look at; the inputs keep matches apart.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import audits, cleaning, extract, rules, web
from quillspark.operators import acts as act_ops
from quillspark.operators import archive, lines, search, steps
from quillspark.plans import inputs
from quillspark.plans.base import NL, ORACLES, QUERIES, L, Query, S, query, shared_folder
from quillspark.plans.base import replaced as _r
from quillspark.streaming import files as streams


# ---- cleaning: each query puts lines that its rules fire on above the texts ----


def _cleaning(name: str, marks: list[str], rule: Callable[[Column], Column], sql: str | None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = inputs.noisy(spark, sf_dir, marks)
        after = rule(F.col("t"))
        return rows.select("doc_id", (after != F.col("t")).alias("changed"), F.md5(after).alias("cleaned_md5"))

    QUERIES[name] = run
    if sql:
        ORACLES[name] = f"SELECT doc_id, c <> t AS changed, md5(c) AS cleaned_md5 FROM (SELECT doc_id, t, {sql} AS c FROM ({inputs.noisy_sql(marks)}))"


_cleaning(
    "clean_s1_mojibake", ["PrÃ©fet et arrÃªtÃ©", "déjà vu", "cÃ´te Ã§a"], cleaning.repair_mojibake,
    "CASE WHEN regexp_matches(t, '[ÃÂ].') THEN "
    + reduce(lambda c, p: "replace({}, '{}', '{}')".format(c, *(x.replace("'", "''") for x in p)), cleaning._mojibake().items(), "t") + " ELSE t END",
)
_cleaning("clean_s1_stray_a", ["nÂ\u00a0° Â fin", "Âge", "xÂ\ty"], cleaning.drop_stray_a, _r("replace(t, 'Â\u00a0', '\u00a0')", (f"Â({S})", r"\1")))
_cleaning("clean_s1_quotes", ["l’arrêt ‘a’ “b” – — c", "rien", "“un”"], cleaning.straighten_quotes, "translate(t, '’‘“”–—', '''''\"\"--')")
_cleaning(
    "clean_s1_whitelist", ["a€b•c…\ue000\ufffd\u200bd", "œuvre ñ Ÿ \u00a0", "Привет x"], lambda c: cleaning.whitelist(cleaning.drop_unreadable(c)),
    _r("t", (r"[^\x20-\x7E\x{00A0}-\x{024F}\x{1E00}-\x{1EFF}\n\t]", "")),
)
_cleaning("clean_s1_newlines", ["a\r\nb\rc", "a\n\n\n\n\n\nb", "x"], cleaning.unify_newlines, _r("t", (r"\r\n?", "\n"), (r"\n{4,}", "\n\n\n")))
_one = {c: t for c, t in rules.LOOKALIKES.items() if len(t) == 1}
_gone = [c for c, t in rules.LOOKALIKES.items() if not t] + [chr(c) for c in (0x200E, 0x200F, *range(0x202A, 0x202F), *range(0x2066, 0x206A))]
_cleaning(
    "clean_s2_lookalikes", ["а\u2003rticle\u200b 1\u00ad2 \u201cx\u201d", "prix\u2026 \uff11\uff12 \u202ey", "Ѕ \u2010\u2015"], cleaning.fix_unicode,
    f"replace(translate(t, '{''.join([*_one, *_gone])}', '{''.join(_one.values())}'), '\u2026', '...')",
)
_cleaning(
    "clean_s3_articles", ["I'arrete et I’acte", "vu Ia loi ; Ie code ; Ies lois", "IA Il I a"], cleaning.repair_articles,
    _r("t", (rf"(^|{NL})I(['’][a-zà-ÿ])", r"\1l\2"), (rf"(^|{NL})I(a|es?)($|{NL})", r"\1l\2\3")),
)
_cleaning("clean_s3_hyphens", ["pre-\nfecture du", "admi- \n nistration", "a -\n b"], cleaning.join_hyphenated, _r("t", (rf"([a-zà-ÿ])-{S}*\n{S}*([a-zà-ÿ])", r"\1\2")))
_words = ", ".join(f"'{w}'" for w in rules.WORDS_WITH_M)
_cleaning(
    "clean_s3_rn", ["la cornrnune et l'adrninistration moderne", "Rnaire rnaire journal", "cornrnunes"], cleaning.repair_rn,
    f"CASE WHEN contains(t, 'rn') THEN array_to_string(list_transform(regexp_extract_all(t, '{L}+|{NL}+'), "
    f"lambda w: CASE WHEN contains(w, 'rn') AND lower(replace(w, 'rn', 'm')) IN ({_words}) THEN replace(w, 'rn', 'm') ELSE w END), '') ELSE t END",
)
_cleaning("clean_s3_spaces", ["a  b\t\tc", "  x   y  ", "z"], cleaning.single_spaces, _r("t", *[(r"([^\s])[ \t]{2,}([^\s])", r"\1 \2")] * 2))  # twice, as captures keep neighbours from meeting

_MARKS = {
    "spaced_capitals": (["S O M M A I R E du", "A B", "Le P R E F E T ."], None),
    "quotes": (['il dit "oui" et "non"', 'un " seul', "x"], [(r'"([^"]*?)"', "«\u00a0\\1\u00a0»")]),
    "open_quote": (["« oui", "«   non", "«x"], [(rf"«{S}*([^\s])", "«\u00a0\\1")]),
    "close_quote": (["oui »", "non»", "x  »"], [(rf"([^\s]){S}*»", "\\1\u00a0»")]),
    "high_marks": (["quoi ? non! a ;b", "a\n;", "x"], [(rf"([^\s]){S}*([;?!])", "\\1\u202f\\2")]),
    "colon": (["objet : ceci", "a:b c :\nd", "fin:«x"], [(rf"([^\s]){S}*:({S}|«|$)", "\\1\u00a0:\\2")]),
    "space_after": (["a.b,c;d", "www.site.fr", "1.2"], [(r"([.,;:!?])([A-Za-zÀ-ſ«])", r"\1 \2")]),
    "dashes": (["a -- b---c", "x --\ny", "a-b"], [(rf"{S}*---?{S}*", " — ")]),
    "apostrophes": (["l'acte d'un", "'x' n'", "j'ai"], [(r"([A-Za-zÀ-ſ])'([A-Za-zÀ-ſ])", r"\1’\2")]),
    "leaders": (["Titre........12", "a...b", "...."], [(r"\.{4,}", "...")]),
    "code_articles": (["article L.2213-1 et R.12", "AL.5", "D.3"], [(rf"(^|{NL})([LRDA])\.(\d)", r"\1\2. \3")]),
    "numbers": (["n° 12 et N°3", "n°  4", "n ° 5"], [(rf"([nN])°{S}*(\d)", "\\1°\u00a0\\2")]),
    "space_before": (["a , b .", "c\n, d", "x"], [(rf"{S}+([.,])", r"\1")]),
    "double_spaces": (["a  b   c", "    x", "y"], [(r"[ ]{2,}", " ")]),
}
for _name, _pattern, _by in cleaning.TYPOGRAPHY:
    _marks, _pairs = _MARKS[_name]
    _cleaning(f"clean_s4_{_name}", _marks, lambda c, p=_pattern, b=_by: cleaning.sub(c, p, b), _r("t", *_pairs) if _pairs else None)
_cleaning("clean_s4_all", ["S O M M A I R E\nL'arrete n°12 : \"oui\"; a,b........4", "x -- y ?"], cleaning.fix_typography, None)


_AUDITED = ["l'acte : \"oui\" ; fin.Debut", "n° 4 -- a"]


def _sql_audit() -> str:
    """Matches of each rule on the text that the rules before it left; runs of single capitals stand in no text here."""
    sql, n = f"SELECT doc_id, t AS t0 FROM ({inputs.noisy_sql(_AUDITED)})", 0
    counts = []
    for name, (_, pairs) in _MARKS.items():
        if pairs:
            pattern = pairs[0][0].replace("'", "''")
            counts.append(f"SELECT '{name}' AS type, len(regexp_extract_all(t{n}, '{pattern}')) AS n FROM every")
            sql = f"SELECT *, {_r(f't{n}', *pairs)} AS t{n + 1} FROM ({sql})"
            n += 1
    return f"WITH every AS ({sql}) SELECT type, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM ({' UNION ALL '.join(counts)}) WHERE n > 0 GROUP BY type"


@query("clean_s4_audit", _sql_audit())
def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.noisy(spark, sf_dir, _AUDITED)
    found = cleaning.typography_audit(rows, "t").select("doc_id", F.explode_outer("corrections").alias("a")).where("a IS NOT NULL")
    return found.groupBy("a.type").agg(F.count("*").alias("n_docs"), F.sum("a.count").alias("total"))


_PAGE = (
    rf"(?m)^{S}*(?:=+{S}*(?:PAGE|Page|page){S}*\d+{S}*=+|(?:PAGE|Page|page){S}*\d+(?:{S}*/{S}*\d+)?(?:{S}+sur{S}+\d+)?"
    rf"|(?:P\.?|p\.?){S}*\d+|\d+{S}*/{S}*\d+|[-—–]{S}*\d+{S}*[-—–]|\d+)(?:{S}*)$"
)


def _sql_unpaged(t: str) -> str:
    return _r(t, (_PAGE, ""), (rf"(^|{NL})[Pp]age{S}*\d+($|{NL})", r"\1\2"), (rf"(?m)^=+{S}*=+$", ""), (r"\n{3,}", "\n\n"), (rf"^{S}+|{S}+$", ""))


def _sql_act_words(t: str) -> str:
    return _r(
        t, (rf"(?mi)^({S}*)ARR[Êê]TE({S}*)$|^({S}*)ARRETE({S}*)$", r"\1\3ARRÊTE\2\4"), (rf"(?mi)^({S}*)ARR[EÊê]T[Éé]({S}*)$", r"\1ARRÊTÉ\2"),
        (rf"(?mi)^({S}*)D[ÉEé]CIDE({S}*)$", r"\1DÉCIDE\2"), (rf"(?mi)^({S}*)ORDONNE({S}*)$", r"\1ORDONNE\2"),
    )


def _sql_keywords(t: str) -> str:
    return _r(
        t, (rf"(?m)^({S}*)(?:VU|vu)($|{NL})", r"\1Vu\2"), (rf"(?m)^({S}*)(?:CONSID[ÉE]RANT|Consid[ée]rant|consid[ée]rant)($|{NL})", r"\1Considérant\2"),
        (rf"(?m)^({S}*)(?:ATTENDU|attendu)($|{NL})", r"\1Attendu\2"),
    )


_cleaning("clean_s5_page_numbers", ["PAGE 3\nVu le texte\n1/12\nfin", "=== PAGE 4 ===\nUn\n- 5 -\nDeux Page 6 trois", "====\nx\np. 3\ny"], cleaning.strip_page_numbers, _sql_unpaged("t"))
_cleaning("clean_s5_act_words", ["Arrete\nsuite", "  decide \nx\nARRÊTÉ\n", "ordonne"], cleaning.normalize_act_words, _sql_act_words("t"))


def _sql_articles(t: str) -> str:
    pairs = []
    for word in sorted(rules.ORDINALS, key=len, reverse=True):
        word_ci = word.replace("è", "[èÈ]")
        pairs.append((rf"(?mi)^({S}*)(?:ARTICLE|ART\.?{S}*){S}*{word_ci}{S}*[:.—–-]?{S}*", rf"\1{chr(10)}\x01 {rules.ORDINALS[word]} — ".replace(r"\x01", "\x01")))
    pairs.append((rf"(?mi)^({S}*)(?:ARTICLE|ART\.?{S}*){S}*0*(\d+){S}*(?:er|[eèÈ]re|[eèÈ]me|e)?{S}*[:.—–-]?{S}*", "\\1\n\x01 \\2 — "))
    pairs.append((rf"(?mi)^({S}*)(?:ARTICLE|ART\.?{S}*){S}*UNIQUE{S}*[:.—–-]?{S}*", "\\1\n\x01 unique — "))
    return f"replace({_r(t, *pairs)}, '\x01', 'Article')"


_cleaning("clean_s5_articles", ["ARTICLE PREMIER: Le texte\nArt. 2. Deux\nArticle 3ème - trois", "Article Unique. x\nart 12 : y", "ARTICLE DEUXIÈME"], cleaning.normalize_articles, _sql_articles("t"))
_cleaning("clean_s5_keywords", ["VU le code\nCONSIDERANT que\nattendu x", "vu\n considérant y", "Vue"], cleaning.normalize_keywords, _sql_keywords("t"))


def _sql_titles() -> str:
    pairs = []
    for pattern, plain in rules.TITLES:
        pattern = pattern.replace(r"\s", S)
        pairs.append((rf"(^|[\n.!—])([ \t\x{{00A0}}\x{{202F}}]*){pattern}($|{NL})", rf"\1\2{plain[0].upper() + plain[1:]}\3"))
        pairs.append((rf"(^|{NL}){pattern}($|{NL})", rf"\1{plain}\2"))
    return _r("t", *pairs)


_cleaning("clean_s6_titles", ["Le PREFET et le MAIRE. MINISTRE ici", "SOUS-PRÉFÈTE - x\nDIRECTEUR GENERAL", "PREFETURE"], cleaning.lower_titles, _sql_titles())
_cleaning("clean_s6_capitals", ["le DÉPARTEMENT et la CONSTITUTIONNELLE mesure. RÉGION", "TOUT EN HAUT", "la SARL"], cleaning.lower_capitals, None)
_cleaning("clean_s7_final", ["a  \nb\t\n\n\n\n\nc", "\u00a0\u202fx", "y"], cleaning.fix_final, (
    "array_to_string(list_transform(string_split(CASE WHEN c7 <> '' AND NOT ends_with(c7, chr(10)) THEN c7 || chr(10) ELSE c7 END, chr(10)), "
    "lambda l: repeat(' ', len(regexp_extract(l, '^[\\x{00A0}\\x{202F}]*'))) || regexp_replace(l, '^[\\x{00A0}\\x{202F}]*', '')), chr(10))"
).replace("c7", _r("t", (r"(?m)[ \t]+$", ""), (r"\n{4,}", "\n\n\n"))))


@query("clean_pipeline")
def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps.cleaned(inputs.acts(spark, sf_dir), "act").select("doc_id", F.col("act").alias("cleaned"))


@query(
    "char_diff_count",
    "SELECT doc_id, len(list_filter(list_zip(string_split(t, ''), string_split(c, '')), lambda p: p[1] IS DISTINCT FROM p[2])) AS n_differences FROM "
    f"(SELECT doc_id, t, {_r('t', ('o', '00'), ('[.]', '!'))} AS c FROM ({inputs.noisy_sql(['avant', 'après'])}))",
)
def _char_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = cleaning.sub(cleaning.sub(F.col("t"), "o", "00"), "[.]", "!")
    rows = inputs.noisy(spark, sf_dir, ["avant", "après"])
    return rows.select("doc_id", cleaning.char_differences(F.col("t"), after).cast("long").alias("n_differences"))


# ---- acts ----


def _flag(pattern: str) -> str:
    return f"regexp_matches(line, '{pattern}')"


#: The sections by a recursion from line to line: ``before`` is the label that a line finds, ``label`` the one it gives.
SECTION_LINES = f"""
l AS MATERIALIZED (
  SELECT doc_id, pos, line, {_flag(rf"(?i)^{S}*(?:SOMMAIRE|VU|ARTICLE|CONSID|ARR[ÊEê]T[ÉEé])")} AS body, {_flag(rf"(?i)^{S}*SOMMAIRE(?:$|{NL})")} AS summary,
         {_flag(rf"(?i)^{S}*ARR[ÊEê]T[ÉEé](?:$|{NL})")} AS act, {_flag(rf"^{S}*(?:VU|Vu|vu)(?:$|{NL})")} AS visa, {_flag(rf"(?i)^{S}*(?:CONSID[ÉEé]RANT|ATTENDU)")} AS recital,
         {_flag(rf"(?i)^{S}*D[ÉEé]CIDE{S}*$")} AS decided, {_flag(rf"(?i)^{S}*ARTICLE{S}+[0-9]+")} AS article,
         {_flag(rf"(?i)(?:^|{NL})(?:SIGN[ÉEé]|SIGNÉE)(?:$|{NL})")} AS signed, {_flag(rf"(?i)^{S}*ANNEXE")} AS annex
  FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM (SELECT doc_id, string_split(act, chr(10)) AS ls FROM ({inputs.acts_sql()})))
), f AS (
  SELECT *, max(body) OVER w AS covered, coalesce(max(summary) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS listed
  FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), s AS (
  SELECT doc_id, CAST(-1 AS BIGINT) AS pos, 'ENTETE' AS before, 'ENTETE' AS label, false AS cut FROM documents
  UNION ALL
  SELECT doc_id, pos, before, label, pos > 0 AND (label <> before OR summary AND NOT listed OR act AND NOT listed OR NOT act AND (label = 'DISPOSITIF' AND decided OR label = 'SIGNATURE' AND signed OR label = 'ANNEXES' AND annex)) AS cut
  FROM (
    SELECT *, CASE WHEN summary AND NOT listed THEN 'SOMMAIRE' WHEN act AND listed THEN before WHEN act THEN 'ARRETE_TITRE' WHEN visa THEN 'VISAS' WHEN recital THEN 'CONSIDERANTS'
                   WHEN decided THEN 'DISPOSITIF' WHEN before = 'ARTICLES' OR article THEN 'ARTICLES' WHEN signed THEN 'SIGNATURE' WHEN annex THEN 'ANNEXES' ELSE before END AS label
    FROM (SELECT f.*, CASE WHEN f.covered THEN s.label ELSE 'ENTETE_GLOBAL' END AS before FROM s JOIN f ON f.doc_id = s.doc_id AND f.pos = s.pos + 1)
  )
), n AS (
  SELECT s.doc_id, s.pos, line, s.before, s.label, sum(CAST(cut AS INT)) OVER (PARTITION BY s.doc_id ORDER BY s.pos) AS k, lead(cut) OVER (PARTITION BY s.doc_id ORDER BY s.pos) AS last,
         lead(s.before) OVER (PARTITION BY s.doc_id ORDER BY s.pos) AS after
  FROM s JOIN l ON l.doc_id = s.doc_id AND l.pos = s.pos
), sections AS (
  SELECT doc_id, CAST(k AS INT) AS k, arg_max(CASE WHEN last THEN after ELSE label END, pos) AS label, {_r("string_agg(line, chr(10) ORDER BY pos)", (rf"^{S}+|{S}+$", ""))} AS content FROM n GROUP BY doc_id, k
)"""


@query("section_labels", f"WITH RECURSIVE {SECTION_LINES} SELECT doc_id, k AS \"at\", label, md5(content) AS content_md5 FROM sections")
def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.acts(spark, sf_dir).select("doc_id", F.posexplode_outer(act_ops.sections(F.col("act"))).alias("at", "s"))
    return rows.select("doc_id", "at", "s.label", F.md5("s.content").alias("content_md5"))


@query("section_counts", f"WITH RECURSIVE {SECTION_LINES} SELECT label, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM sections GROUP BY label")
def _section_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sections(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


@query("section_marks", f"""
WITH RECURSIVE {SECTION_LINES}
SELECT doc_id, coalesce(string_agg(chr(10) || '=== ' || label || ' ===' || chr(10) || content, chr(10) ORDER BY k) FILTER (content <> ''), '') AS marked FROM sections GROUP BY doc_id
""")  # fmt: skip
def _marks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.acts(spark, sf_dir).select("doc_id", act_ops.with_section_marks(F.col("act")).alias("marked"))


_SCORE = " + ".join(f"CAST(regexp_matches({{t}}, '{p}') AS INT)" for p in (
    rf"(?i)Article{S}+1", rf"(?im)^{S}*Vu\b", "(?i)Consid[éÉ]rant", "(?i)Pr[éÉ]fet", "(?i)Maire", rf"(?im)^{S}*ARR[ÊEê]T[ÉEé]{S}*$", rf"(?i)Fait{S}+[àaÀ]($|{NL})"))


@query("act_scores", f"SELECT doc_id, {_SCORE.replace('{t}', 'act')} AS score FROM ({inputs.acts_sql()})")
def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.acts(spark, sf_dir).select("doc_id", extract.score(F.col("act")).alias("score"))


_HEADER = rf"(?im)^{S}*ARR[ÊEê]T[ÉEé](?:{S}+N[°º]?{S}*\S+|{S}+DU{S}+\d|{S}+PORTANT\b|{S}+RELATIF\b|{S}+FIXANT\b|{S}*$)"
_NORMAL = _r("translate(act, '\u00a0\u202fªº²³¹', '  ao231')", (r"\r\n?", "\n"), (r"[ \t]+", " "), (r"\n{3,}", "\n\n"), (rf"^{S}+|{S}+$", ""))
_SPLIT = f"""
WITH pieces AS (
  SELECT doc_id AS source, unnest(ps) AS piece, unnest(range(len(ps))) AS pos
  FROM (SELECT doc_id, string_split({_r(_NORMAL, (f"({_HEADER})", chr(1) + "\\1"))}, chr(1))[2:] AS ps FROM ({inputs.acts_sql()}))
), scored AS (
  SELECT source, pos, c AS contenu, {_SCORE.replace('{t}', 'c')} AS score FROM (SELECT source, pos, {_r("piece", (rf"^{S}+|{S}+$", ""))} AS c FROM pieces)
)
SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY pos) AS INT) AS "index",
       coalesce(list_filter(list_transform(string_split(contenu, chr(10))[:10], lambda l: {_r("l", (rf"^{S}+|{S}+$", ""))}), lambda l: len(l) > 10)[1], 'TITRE_NON_DETECTE') AS titre,
       md5(contenu) AS contenu_md5, score
FROM scored WHERE len(contenu) >= 300 AND score >= 2
"""


@query("split_acts", _SPLIT)
def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    acts = act_ops.split_acts(inputs.acts(spark, sf_dir), "doc_id", "act")
    return acts.withColumn("contenu_md5", F.md5("contenu")).drop("contenu")


_STRIP = (rf"^{S}+|{S}+$", "")


def _first_piece(text: str) -> str:
    """What stands before the first header of an act."""
    return f"string_split({_r(text, (f'({_HEADER})', chr(1) + chr(92) + '1'))}, chr(1))[1]"


_HEAD_SQL = (
    f"CASE WHEN regexp_matches(act, '(?i)(^|{NL})SOMMAIRE($|{NL})') THEN regexp_extract(act, '(?is)^(.*?)(?:^|{NL})SOMMAIRE(?:$|{NL})', 1) "
    f"WHEN regexp_matches(act, '{_HEADER}') THEN {_first_piece('act')} ELSE '' END"
)
_TAIL = f"regexp_extract(act, '(?is)(?:^|{NL})(SOMMAIRE(?:$|{NL}).*)$', 1)"


@query("act_files", f"""
WITH a AS (SELECT * FROM ({_SPLIT.replace('md5(contenu) AS contenu_md5', 'contenu')})), h AS (SELECT doc_id, {_r(_HEAD_SQL, _STRIP)} AS head, {_r(_first_piece(_TAIL), _STRIP)} AS listed FROM ({inputs.acts_sql()}))
SELECT source, 'arrete_' || lpad(CAST("index" AS VARCHAR), 3, '0') || '.txt' AS name, md5(head || chr(10) || chr(10) || listed || chr(10) || chr(10) || contenu) AS file_md5
FROM a JOIN h ON a.source = h.doc_id
""")  # fmt: skip
def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.acts(spark, sf_dir)
    acts = act_ops.split_acts(docs, "doc_id", "act")
    heads = docs.select("doc_id", act_ops.header(F.col("act")).alias("head"), act_ops.summary(F.col("act")).alias("listed"))
    joined = acts.join(heads, acts.source == heads.doc_id)
    name = F.format_string("arrete_%03d.txt", "index")
    return joined.select("source", name.alias("name"), F.md5(act_ops.act_file(F.col("head"), F.col("listed"), F.col("contenu"))).alias("file_md5"))


_FIELD_SQL = {
    "fonction_auteur": rf"(?i)sign[ée]{S}*:{S}*([^\n]+?){S}*:",
    "date_acte": rf"(?:du|en date du|signé le){S}+(\d{{1,2}}{S}+{L}+{S}+\d{{4}}|\d{{1,2}}[/\-]\d{{1,2}}[/\-]\d{{4}})",
    "base_legale": rf"(?s)[Vv]u{S}+(.+?)(?:\n{S}*\n|\n[A-Z]|\z)",
    "objet_large": rf"[Aa]rr[eê]t[eé]{S}+n[°o]?{S}*[0-9A-Za-zÀ-ɏ_\-]+{S}+du{S}+[^\n]+?portant{S}+([^\n]*)",
    "prefecture": r"((?:SOUS[- ]?)?PREFECTURE\s+D(?:E|U|[''’])\s+[A-Z\- ]+?)(?:\.{3}|\n|\z)",
    "numero_acte": r"(?:^|[^0-9A-Za-zÀ-ɏ_])(?:n°\s*)?(\d{4}[/\-]\d{2,4}(?:[/\-]\d{2,4})?|\d{2}[/\-]\d{4}[/\-]\d{3})(?:$|[^0-9A-Za-zÀ-ɏ_])",
}
_FIELDS = ", ".join(f"CASE WHEN regexp_matches(act, '{p}') THEN {_r(f'''regexp_extract(act, '{p}', 1)''', (rf'^{S}+|{S}+$', ''))} END AS {n}" for n, p in _FIELD_SQL.items())


@query("extract_fields", f"SELECT doc_id, {_FIELDS} FROM ({inputs.acts_sql()})")
def _extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.acts(spark, sf_dir).select("doc_id", *extract.fields(F.col("act")))


def _sql_tagged() -> str:
    sql = f"SELECT doc_id, act, {_FIELDS} FROM ({inputs.acts_sql()})"
    for name in _FIELD_SQL:
        tag = "OBJET" if name == "objet_large" else name.upper()
        sql = (
            f"SELECT * REPLACE (CASE WHEN coalesce({name}, '') <> '' AND strpos(act, {name}) > 0 THEN substr(act, 1, strpos(act, {name}) - 1) || '<{tag}>' || {name} || "
            f"'</{tag}>' || substr(act, strpos(act, {name}) + len({name})) ELSE act END AS act) FROM ({sql})"
        )
    return f"SELECT doc_id, md5(act) AS tagged_md5 FROM ({sql})"


@query("tag_fields", _sql_tagged())
def _tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.acts(spark, sf_dir).select("doc_id", "act", *extract.fields(F.col("act")))
    return extract.tagged(rows, "act", list(rules.FIELDS)).select("doc_id", F.md5("act").alias("tagged_md5"))


@query("act_json", f"""
SELECT doc_id, CAST(to_json({{'id': doc_id + 1, 'numero_acte': numero_acte, 'date': date_acte, 'prefecture': prefecture, 'auteur': fonction_auteur,
       'objet': objet_large, 'base_legale': base_legale, 'contenu': {_r("act", _STRIP)}}}) AS VARCHAR) AS json FROM (SELECT doc_id, act, {_FIELDS} FROM ({inputs.acts_sql()}))
""")  # fmt: skip
def _json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.acts(spark, sf_dir).select("doc_id", "act", *extract.fields(F.col("act")))
    return rows.select("doc_id", extract.act_json(F.col("doc_id"), F.col("act"), {n: F.col(n) for n in rules.FIELDS}).alias("json"))


def _sql_anonymized() -> str:
    shapes = (rf"{rules.GIVEN}{S}+{rules.SURNAME}", rf"{rules.SURNAME}{S}+{rules.GIVEN}", rf"{rules.GIVEN}(?:{S}+{rules.GIVEN}){{1,3}}{S}+{rules.SURNAME}")
    return _r("act", *((rf"(^|{NL}){rules.CIVILITY}{S}+{s}($|{NL})", r"\1\2 XXX\3") for s in shapes))


@query("anonymize_names", f"SELECT doc_id, md5({_sql_anonymized()}) AS anonymized_md5 FROM ({inputs.acts_sql()})")
def _anonymize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.acts(spark, sf_dir).select("doc_id", F.md5(extract.anonymized(F.col("act"))).alias("anonymized_md5"))


_STRUCTURED = _sql_keywords(_sql_articles(_sql_act_words(_sql_unpaged("act"))))


@query("validate_structure", f"""
WITH c AS (SELECT doc_id, {_STRUCTURED} AS t FROM ({inputs.acts_sql()})
), n AS (
  SELECT doc_id, t, regexp_extract_all(t, '(?mi)^{S}*Article{S}+(\\d+|1er|unique){S}', 1) AS ns, regexp_extract(t, '(?m)^{S}*(ARR[ÊÉE]TE|D[ÉE]CIDE|ORDONNE){S}*$', 1) AS head,
         len(regexp_extract_all(t, '«')) AS opens, len(regexp_extract_all(t, '»')) AS closes, len(regexp_extract_all(t, '(?m)^{S}*Vu(?:$|{NL})')) AS visas FROM c
), f AS (SELECT *, list_transform(list_filter(ns, lambda x: regexp_matches(x, '^[0-9]')), lambda x: CAST(regexp_extract(x, '^(\\d+)', 1) AS BIGINT)) AS found FROM n
)
SELECT doc_id, true AS valid, nullif(head, '') AS title, CAST(len(ns) AS INT) AS article_count, CASE WHEN ns[1] = 'unique' THEN 'unique' WHEN len(ns) > 0 THEN 'numbered' END AS article_type,
       CAST(opens AS INT) AS opens, CAST(closes AS INT) AS closes, CAST(visas AS INT) AS visas,
       array_to_string(list_concat(list_concat(CASE WHEN head = '' THEN ['aucun titre'] ELSE [] END,
         CASE WHEN coalesce(ns[1], '') = 'unique' THEN [] ELSE list_transform(list_filter(range(1, len(found) + 1), lambda i: found[i] <> CASE WHEN i = 1 THEN 1 ELSE found[i - 1] + 1 END),
           lambda i: 'séquence: article ' || CAST(CASE WHEN i = 1 THEN 1 ELSE found[i - 1] + 1 END AS VARCHAR) || ' attendu, article ' || CAST(found[i] AS VARCHAR) || ' trouvé') END),
         list_concat(CASE WHEN opens <> closes THEN ['guillemets déséquilibrés'] ELSE [] END, CASE WHEN visas = 0 THEN ['aucun visa'] ELSE [] END)), '; ') AS warnings
FROM f
""")  # fmt: skip
def _validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.fix_structure(F.col("act"))
    return inputs.acts(spark, sf_dir).select("doc_id", clean.alias("act")).select("doc_id", extract.validation(F.col("act")).alias("v")).select("doc_id", "v.*").withColumn("warnings", F.array_join("warnings", "; "))


@query("diff_lines")
def _diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.acts(spark, sf_dir).select("doc_id", "act", cleaning.fix_structure(F.col("act")).alias("clean"))
    return lines.diff_lines(rows, "doc_id", "act", "clean", "structure")


@query(
    "french_date",
    f"SELECT doc_id, make_date(2018 + doc_id % 7, 1 + doc_id % 12, 1 + doc_id % 28) AS date_acte, 1 + doc_id % 12 AS month FROM ({inputs.acts_sql()})",
)
def _french(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = extract.field(F.col("act"), "date_acte")
    rows = inputs.acts(spark, sf_dir).select("doc_id", date.alias("d"))
    return rows.select("doc_id", extract.french_date(F.col("d")).alias("date_acte"), extract.month_number(F.col("d")).cast("long").alias("month"))


_CID = ["(cid:12)(cid:13)(cid:14)", "texte", "(cid:1)"]


@query(
    "route_pdf",
    "SELECT doc_id, CASE WHEN doc_id % 10 = 0 OR len(regexp_extract_all(t, '\\(cid:')) / greatest(len(t), 1) > 0.01 THEN 'ocr' ELSE 'texte' END AS route "
    f"FROM ({inputs.noisy_sql(_CID)})",
)
def _route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.noisy(spark, sf_dir, _CID).select("doc_id", extract.route(F.col("t"), F.col("doc_id") % 10 == 0).alias("route"))


# ---- lines ----

_LINES = """
WITH b AS ({boxes}), g AS (
  SELECT *, CASE WHEN abs(y - lag(y) OVER (PARTITION BY page ORDER BY y, ord, word)) >= 15 THEN 1 ELSE 0 END AS starts FROM b
), n AS (SELECT *, sum(starts) OVER (PARTITION BY page ORDER BY y, ord, word) AS line FROM g
)
SELECT page, CAST(line AS BIGINT) AS line, string_agg(word, ' ' ORDER BY x, y, ord, word) AS text FROM n GROUP BY page, line
""".replace("{boxes}", inputs.BOXES)


@query("ocr_lines", _LINES)
def _ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.lines_of_boxes(inputs.boxes(spark, sf_dir), "page")


@query("ocr_pages", f"SELECT page, string_agg(text, chr(10) ORDER BY line) AS text FROM ({_LINES}) GROUP BY page")
def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.page_text(_ocr(spark, sf_dir), "page")


_BLOCK = (
    rf"^{S}*$|^Article{S}+\d|^ARTICLE{S}+\d|^\d+[.)]{S}+\S|^[A-ZÀÂÉÈÊÎÔÛÙ]{{3,}}|^[-•*►]{S}+|^Vu($|{NL})|^Considérant($|{NL})"
    rf"|^Le{S}+(?:Préfet|Maire|Président)|^ARRÊTÉ|^DÉCISION|^ANNEXE"
)


@query("line_break_repair", f"""
WITH l AS (
  SELECT doc_id, unnest(range(len(ls))) AS pos, {_r("unnest(ls)", (rf"{S}+$", ""))} AS line FROM (SELECT doc_id, string_split(act, chr(10)) AS ls FROM ({inputs.acts_sql()}))
), m AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM l
), b AS (
  SELECT doc_id, pos, line, sum(CASE WHEN before IS NULL OR before = '' OR regexp_matches(line, '{_BLOCK}') OR regexp_matches(before, '[.;:!?»]{S}*$')
         OR regexp_matches(line, '^\\p{{Lu}}') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS block FROM m
), j AS (SELECT doc_id, block, string_agg(line, ' ' ORDER BY pos) AS line FROM b GROUP BY doc_id, block
)
SELECT doc_id, string_agg(line, chr(10) ORDER BY block) AS text FROM j GROUP BY doc_id
""")  # fmt: skip
def _breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repair_line_breaks(inputs.acts(spark, sf_dir), "doc_id", "act")


@query("binarize_otsu", """
WITH h AS (SELECT p_brand AS image, p_size AS value, count(*) AS n FROM part GROUP BY 1, 2
), c AS (
  SELECT image, value, CAST(sum(n) OVER u AS DOUBLE) AS w0, CAST(sum(n * value) OVER u AS DOUBLE) AS s0,
         CAST(sum(n) OVER (PARTITION BY image) AS DOUBLE) AS w, CAST(sum(n * value) OVER (PARTITION BY image) AS DOUBLE) AS s
  FROM h WINDOW u AS (PARTITION BY image ORDER BY value)
), v AS (
  SELECT image, value, round(CASE WHEN w0 > 0 AND w - w0 > 0 THEN w0 * (w - w0) * (s0 / w0 - (s - s0) / (w - w0)) * (s0 / w0 - (s - s0) / (w - w0)) ELSE 0.0 END, 3) AS v FROM c
)
SELECT image, threshold FROM (SELECT image, value AS threshold, row_number() OVER (PARTITION BY image ORDER BY v DESC, value) AS k FROM v) WHERE k = 1
""")  # fmt: skip
def _otsu(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = inputs.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("image"), F.col("p_size").alias("value")).agg(F.count("*").alias("n"))
    return lines.otsu_threshold(part, "image")


# ---- archive ----

_PATH = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(/.*)$', 1)"
_ISPDF = "(regexp_matches(url, '(?i)\\.pdf(?:$|[?#])') OR regexp_matches(url, '(?i)/(?:i?re)?contenu/telechargement/'))"
#: How the paths of an archive name months and years.
_MONTH_WORDS = "Janvier|Fevrier|Février|Mars|Avril|Mai|Juin|Juillet|Aout|Août|Septembre|Octobre|Novembre|Decembre|Décembre"
_Y = "(?:19|20)\\d{2}"
_YEAR_PATH = f"Annee-{_Y}|Les-recueils-des-actes-administratifs-annee-{_Y}|Raa-[^/]+?-{_Y}"
PAGE_KIND = (
    f"CASE WHEN regexp_matches({_PATH}, '(?i)/(?:Annee-{_Y}|Raa-[^/]+?-{_Y})/.') THEN 'month' WHEN regexp_matches({_PATH}, '(?i)/(?:{_YEAR_PATH})/?$') THEN 'year' "
    f"WHEN regexp_matches({_PATH}, '(?i)/(?:{_MONTH_WORDS})(?:-{_Y})?/?$') THEN 'month' "
    f"WHEN regexp_matches({_PATH}, '(?i)(?:^|/)Annee-{_Y}(?:/|$)|Raa-[^/]+?-{_Y}') THEN 'year' ELSE 'root' END"
)
_KIND = f"CASE WHEN {_ISPDF} THEN 'pdf' ELSE {PAGE_KIND} END"
_YEAR_FORM = "(?:Annee-|Les-recueils-des-actes-administratifs-annee-|Raa-[^/]+?-)"
_YEAROF = (
    f"coalesce(CAST(regexp_extract_all({_PATH} || '/', '(?i)(?:^|/){_YEAR_FORM}((?:19|20)\\d{{2}})/', 1)[-1] AS INT), "
    f"CAST(regexp_extract_all(label, '(?:19|20)\\d{{2}}')[-1] AS INT), "
    f"CAST(regexp_extract_all(url || ' ' || label || ' ', '(?:^|[^\\d])((?:19|20)\\d{{2}})[^\\d]', 1)[-1] AS INT), 0)"
)
_MONTHOF = "CASE " + " ".join(f"WHEN contains(strip_accents(lower(url || ' ' || label)), '{m}') THEN {i + 1}" for i, m in enumerate(rules.MONTHS)) + " ELSE 0 END"
_RESOLVED = f"SELECT page_id, pos, url, label, {_KIND} AS kind, {_YEAROF} AS year, {_MONTHOF} AS month FROM ({inputs.LINKS_SQL})"


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    url, label = F.col("url"), F.col("label")
    return inputs.links(spark, sf_dir).select(
        "page_id", "pos", url, label, web.link_kind(url).alias("kind"), web.year_of(url, label).alias("year"), web.month_of(url, label).alias("month")
    )


@query("page_links", inputs.LINKS_SQL)
def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.links(spark, sf_dir).select("page_id", F.col("pos").cast("long").alias("pos"), "url", "label")


@query("link_kinds", f"SELECT page_id, CAST(pos AS BIGINT) AS pos, kind, year, month FROM ({_RESOLVED})")
def _kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir).select("page_id", F.col("pos").cast("long").alias("pos"), "kind", "year", "month")


_YEARLINK = rf"(regexp_matches({_PATH}, '(?i)/{_YEAR_FORM}(?:19|20)\d{{2}}/?$') OR regexp_matches(label, '(?i)ann[éeÉ]e\s+(?:19|20)\d{{2}}'))"


@query("year_links", f"SELECT page_id, CAST(pos AS BIGINT) AS pos, url FROM ({inputs.LINKS_SQL}) WHERE {_YEARLINK}")
def _years(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.links(spark, sf_dir)
    return rows.where(web.is_year_link(F.col("url"), F.col("label"), F.lit(""))).select("page_id", F.col("pos").cast("long").alias("pos"), "url")


@query("dedupe_links", f"SELECT page_id, CAST(pos AS BIGINT) AS pos, url, label FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id, pos) AS k FROM ({inputs.LINKS_SQL})) WHERE k = 1")
def _dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.links(spark, sf_dir).withColumn("pos", F.col("pos").cast("long"))
    return archive.keep_first(rows, ["url"], [F.col("page_id"), F.col("pos")])


_DOCS = f"SELECT url, arg_min(label, (page_id, pos)) AS label, arg_min(year, (page_id, pos)) AS year, arg_min(month, (page_id, pos)) AS month FROM ({_RESOLVED}) WHERE kind = 'pdf' GROUP BY url"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pdfs = _resolved(spark, sf_dir).where(F.col("kind") == "pdf")
    return archive.keep_first(pdfs, ["url"], [F.col("page_id"), F.col("pos")]).select("url", "label", "year", "month")


@query("site_map_summary", f"SELECT year, count(DISTINCT month) AS n_months, count(*) AS n_docs, min(month) AS first_month, max(month) AS last_month FROM ({_DOCS}) GROUP BY year")
def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.site_summary(_documents(spark, sf_dir))


_HISTORY = "SELECT DISTINCT 'https://www.prefecture-test.fr/contenu/telechargement/' || CAST(event_id % 25 AS STRING) || '/acte.pdf' AS url FROM events WHERE event_type <> 'click'"


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_HISTORY.replace("FROM events", "FROM {events}"), events=inputs.table(spark, sf_dir, "events"))


@query("pending_downloads", f"SELECT url, label, year, month FROM ({_DOCS}) d WHERE NOT EXISTS (SELECT 1 FROM ({_HISTORY}) h WHERE h.url = d.url)")
def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.pending(_documents(spark, sf_dir), _history(spark, sf_dir))


@query("downloaded_per_month", f"SELECT year, month, count(*) AS n_docs, count(h.url) AS n_downloaded FROM ({_DOCS}) d LEFT JOIN ({_HISTORY}) h USING (url) GROUP BY year, month")
def _downloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = _history(spark, sf_dir).withColumn("seen", F.lit(1))
    return _documents(spark, sf_dir).join(seen, "url", "left").groupBy("year", "month").agg(F.count("*").alias("n_docs"), F.count("seen").alias("n_downloaded"))


@query("selected_months", f"SELECT url, year, month FROM ({_DOCS}) WHERE month BETWEEN 0 AND 8 AND year = (SELECT max(year) FROM ({_DOCS}))")
def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    latest = docs.agg(F.max("year").alias("latest"))  # a single row
    rows = docs.join(F.broadcast(latest), F.col("year") == F.col("latest"))
    return archive.months_between(rows, "month", 8, 0).select("url", "year", "month")


@query("download_paths", f"""
SELECT url, CASE WHEN k > 1 THEN regexp_replace(path, '\\.[^./]*$', '') || ' (' || CAST(k - 1 AS STRING) || ')' || regexp_extract(path, '(\\.[^./]*)$', 1) ELSE path END AS path
FROM (SELECT url, path, row_number() OVER (PARTITION BY path ORDER BY url) AS k FROM (
  SELECT url, 'RAA/prefecture-test/' || CAST(year AS STRING) || '/' || lpad(CAST(month AS STRING), 2, '0') || CASE WHEN month > 0 THEN '-' || strip_accents({inputs._case('month - 1', list(rules.MONTH_NAMES))}) ELSE '' END
         || '/' || CASE WHEN regexp_matches(name, '(?i)\\.pdf$') THEN name ELSE name || '.pdf' END AS path
  FROM (SELECT *, string_split({_PATH}, '/')[-1] AS name FROM ({_DOCS}))))
""")  # fmt: skip
def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("url", web.download_path(F.col("url"), F.col("year"), F.col("month")).alias("path"))
    return archive.unique_paths(docs, "path", [F.col("url")])


# ---- search ----

_EMPTY = "(objet IS NULL OR objet IN ('', '0'))"


@query("search_acts", f"SELECT id, numero_arrete, date_acte, objet FROM ({inputs.RAA_ROWS}) WHERE date_acte >= DATE '1995-01-01' AND date_acte <= DATE '1997-06-30' AND contains(lower(objet), 'build') AND contains(lower(fonction_signataire), 'préfet')")
def _search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search(inputs.raa_rows(spark, sf_dir), "1995-01-01", "1997-06-30", objet="BUILD", fonction_signataire="Préfet")
    return found.select("id", "numero_arrete", "date_acte", "objet").orderBy(F.desc("date_acte"), "id")


@query("api_projection", f"""
SELECT date_acte AS date, fonction_signataire AS auteur, base_legale, numero_arrete, CASE WHEN {_EMPTY} THEN '{rules.DEFAULT_OBJECT}' ELSE objet END AS objet,
       'Arrêté n°' || numero_arrete || ' relatif à ' || CASE WHEN {_EMPTY} THEN '{rules.DEFAULT_OBJECT}' ELSE objet END || '.' AS contenu FROM ({inputs.RAA_ROWS})
""")  # fmt: skip
def _api(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.api_rows(inputs.raa_rows(spark, sf_dir))


@query("acts_by_category", f"SELECT CASE WHEN prefecture = '' THEN 0 ELSE unicode(prefecture) % 4 END AS category, CASE WHEN prefecture IN ('', '0') THEN '{rules.DEFAULT_CELL}' ELSE prefecture END AS prefecture, count(*) AS n FROM ({inputs.RAA_ROWS}) GROUP BY 1, 2")
def _category(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.raa_rows(spark, sf_dir).select(search.category(F.col("prefecture")).alias("category"), search.or_default(F.col("prefecture")).alias("prefecture"))
    return rows.groupBy("category", "prefecture").agg(F.count("*").alias("n"))


@query("latest_acts", f"SELECT id, date_acte FROM ({inputs.RAA_ROWS}) ORDER BY date_acte DESC, id LIMIT 18")
def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 18 latest acts: a top-k report."""
    return inputs.raa_rows(spark, sf_dir).select("id", "date_acte").orderBy(F.desc("date_acte"), "id").limit(18)


@query("unique_acts", f"SELECT date_acte, id FROM (SELECT date_acte, id, row_number() OVER (PARTITION BY date_acte ORDER BY id) AS k FROM ({inputs.RAA_ROWS})) WHERE k = 1")
def _unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.raa_rows(spark, sf_dir).select("date_acte", "id")
    return archive.keep_first(rows, ["date_acte"], [F.col("id")])


# ---- streams: run over what is there, then read as tables ----


def _stream_paths(spark: SparkSession) -> tuple[str, str]:
    run = shared_folder(spark)
    return f"{run}/table", f"{run}/checkpoint"


def _table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = inputs.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@query("stream_activity", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, checkpoint = _stream_paths(spark)
    events = _table_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    streams.updates_to_end(streams.activity(events), table, checkpoint)
    latest = streams.latest_of(spark.read.parquet(table), ["start", "event_type"], ["n", "total"])
    return latest.withColumn("start", F.col("start").cast("timestamp_ntz")).withColumn("total", F.round("total", 4))


@query("stream_new_urls", "SELECT DISTINCT 'https://a.example/' || CAST(user_id AS STRING) || '/' || event_type AS url FROM events")
def _new_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, checkpoint = _stream_paths(spark)
    url = F.concat(F.lit("https://a.example/"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_type"))
    streams.new_keys_to_end(_table_stream(spark, sf_dir, "events").select(url.alias("url")), "url", table, checkpoint)
    return spark.read.parquet(table).select("url")


# ---- crawl plan ----

_MONTHS_OF = f"SELECT year, month, min(url) AS url, count(*) AS n_links FROM ({_RESOLVED}) WHERE kind = 'month' AND year > 0 AND month > 0 GROUP BY year, month"


@query("crawl_plan", f"""
SELECT year, CAST(year AS STRING) || '-' || lpad(CAST(month AS STRING), 2, '0') AS month_key, url, n_links FROM ({_MONTHS_OF})
UNION ALL
SELECT year, CAST(year AS STRING) || '-00' AS month_key, min(url) AS url, count(*) AS n_links FROM ({_RESOLVED}) r
WHERE kind = 'pdf' AND year > 0 AND NOT EXISTS (SELECT 1 FROM ({_MONTHS_OF}) m WHERE m.year = r.year) GROUP BY year
""")  # fmt: skip
def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months of each year, and a month 00 of the documents of years without any."""
    links = _resolved(spark, sf_dir).where("year > 0")
    months = links.where("kind = 'month' AND month > 0").groupBy("year", "month").agg(F.min("url").alias("url"), F.count("*").alias("n_links"))
    key = F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0"))
    direct = links.where("kind = 'pdf'").join(months.select("year").distinct(), "year", "left_anti")
    pseudo = direct.groupBy("year").agg(F.min("url").alias("url"), F.count("*").alias("n_links"))
    return months.select("year", key.alias("month_key"), "url", "n_links").union(
        pseudo.select("year", F.concat(F.col("year").cast("string"), F.lit("-00")), "url", "n_links")
    )


@query("same_origin_links", f"SELECT page_id, CAST(pos AS BIGINT) AS pos, starts_with(url, 'https://www.prefecture-test.fr/') AS same_origin FROM ({inputs.LINKS_SQL})")
def _origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    same = web.origin_of(F.col("url")) == F.lit("https://www.prefecture-test.fr")
    return inputs.links(spark, sf_dir).select("page_id", F.col("pos").cast("long").alias("pos"), same.alias("same_origin"))


_HEADING = rf"(?mi)^{S}*(?:ARTICLE|ART\.?{S}*){S}*(?:{'|'.join(w.replace('è', '[èÈ]') for w in sorted(rules.ORDINALS, key=len, reverse=True))}|0*\d+{S}*(?:er|[eèÈ]re|[eèÈ]me|e)?|UNIQUE){S}*[:.—–-]?{S}*"


@query("structure_corrections", f"""
WITH a AS (SELECT doc_id, {_sql_unpaged('act')} AS start FROM ({inputs.acts_sql()})), b AS (SELECT *, {_sql_act_words('start')} AS titled FROM a), c AS (SELECT *, {_sql_articles('titled')} AS numbered FROM b)
SELECT doc_id, 'structure_title' AS type, CAST(1 AS INT) AS count FROM c WHERE start <> titled
UNION ALL SELECT doc_id, 'structure_articles', CAST(len(regexp_extract_all(titled, '{_HEADING}')) AS INT) FROM c WHERE start <> numbered
""")  # fmt: skip
def _structure_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audits.structure_corrections(inputs.acts(spark, sf_dir), "act")
    # explode() would put a filter below it that makes all corrections a second time.
    return found.select("doc_id", F.explode_outer("corrections").alias("c")).where("c IS NOT NULL").select("doc_id", "c.*")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to acts to fields: cleaned, split, extracted, anonymised, dated."""
    acts = act_ops.split_acts(steps.cleaned(inputs.acts(spark, sf_dir), "act"), "doc_id", "act")
    found = acts.select("source", "index", "titre", "score", "contenu", *extract.fields(F.col("contenu")))
    return found.select(
        "source", "index", "titre", "score", "numero_acte", extract.french_date(F.col("date_acte")).alias("date_acte"), "fonction_auteur",
        extract.anonymized(F.col("contenu")).alias("contenu"),
    )


query("acts_pipeline")(flagship)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


from quillspark.plans import corrections, sites  # noqa: E402, F401  they add their queries
