import re

import pytest
from pyspark.sql import functions as F

from quillspark.functions import cleaning, extract, rules, web
from quillspark.operators import acts, archive, crawl, lines, search, steps


def apply(spark, rule, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.out for r in rows.select("i", rule(F.col("t")).alias("out")).orderBy("i").collect()]


CASES = [
    (cleaning.repair_articles, "I'arrete prefectoral de Ia prefecture", "l'arrete prefectoral de la prefecture"),
    (cleaning.join_hyphenated, "pre-\nfecture du departement", "prefecture du departement"),
    (cleaning.repair_rn, "la cornrnune, le journal et CORNE", "la commune, le journal et CORNE"),
    (cleaning.fix_unicode, "аrticle 1er…​", "article 1er..."),
    (cleaning.strip_page_numbers, "PAGE 3\nVu le décret...\n1/12", "Vu le décret..."),
    (cleaning.normalize_articles, "ARTICLE PREMIER: Le PREFET decide...", "\nArticle 1 — Le PREFET decide..."),
    (cleaning.normalize_articles, "Art. 2. x\nArticle 3ème - y", "\nArticle 2 — x\n\nArticle 3 — y"),
    (cleaning.normalize_articles, "ARTICLE UNIQUE", "\nArticle 1 — IQUE"),
    (cleaning.normalize_act_words, "arrete\nDecide\nARRÊTÉ", "ARRÊTE\nDÉCIDE\nARRÊTÉ"),
    (cleaning.lower_titles, "Le PREFET du Val-de-Marne ARRETE...", "Le préfet du Val-de-Marne ARRETE..."),
    (cleaning.lower_titles, "Fin. MAIRE ici", "Fin. Maire ici"),
    (cleaning.lower_capitals, "dans le DÉPARTEMENT comme pour la SARL", "dans le département comme pour la SARL"),
    (cleaning.lower_capitals, "TOUT EN HAUT ÉTÉ", "TOUT EN HAUT ÉTÉ"),
    (cleaning.fix_final, "a  \n b", "a\n b\n"),
    (cleaning.whitelist, "a€b́ œ", "ab œ"),
    (cleaning.repair_mojibake, "PrÃ©fet", "Préfet"),
    (extract.anonymized, "Monsieur Jean-Marc DUPONT-TEST et Mme TESTONE Anne", "Monsieur XXX et Mme XXX"),
]


@pytest.mark.parametrize("rule,before,after", CASES)
def test_rule(spark, rule, before, after):
    assert apply(spark, rule, before, None) == [after, None]


def test_typography(spark):
    got = apply(spark, cleaning.fix_typography, "Vu l'article L.2213-1 du CGCT;le prefet decide:\"oui\"", "S O M M A I R E")
    assert got == ["Vu l’article L. 2213-1 du CGCT ; le prefet decide : « oui »", "SOMMAIRE"]


def test_typography_audit(spark):
    rows = spark.createDataFrame([("a,b....c",), (None,)], "t string")
    got = [r.corrections for r in cleaning.typography_audit(rows, "t").collect()]
    assert {(c.type, c["count"]) for c in got[0]} == {("space_after", 2), ("leaders", 1)}


def test_pipeline_keeps_extra_columns_and_nulls(spark):
    rows = spark.createDataFrame([(1, "ARTICLE 1 : x", "k"), (2, None, "k"), (3, "", "k")], "doc_id long, act string, label string")
    got = {r.doc_id: r for r in steps.cleaned(rows, "act").collect()}
    assert got[1].act == "\n=== ARTICLES ===\nArticle 1 — x\n" and got[2].act is None and got[3].act == "" and got[1].label == "k"


def machine(text):
    """Sections by a plain state machine."""
    done, held, label, covered, listed = [], [], "ENTETE", False, False

    def flush():
        nonlocal held
        if held:
            done.append((label, "\n".join(held).strip()))
            held = []

    for line in text.split("\n"):
        if not covered:
            if re.match(r"\s*(SOMMAIRE|VU|ARTICLE|CONSID|ARR[ÊE]T[ÉE])", line, re.I):
                covered = True
            else:
                label = "ENTETE_GLOBAL"
        if not listed and re.match(r"\s*SOMMAIRE\b", line, re.I):
            flush()
            label, listed = "SOMMAIRE", True
        elif re.match(r"\s*ARR[ÊE]T[ÉE]\b", line, re.I):
            if not listed:
                flush()
                label = "ARRETE_TITRE"
        elif re.match(r"\s*(VU|Vu|vu)\b", line):
            if label != "VISAS":
                flush()
            label = "VISAS"
        elif re.match(r"\s*(CONSID[ÉE]RANT|ATTENDU)", line, re.I):
            if label != "CONSIDERANTS":
                flush()
            label = "CONSIDERANTS"
        elif re.match(r"\s*D[ÉE]CIDE\s*$", line, re.I):
            flush()
            label = "DISPOSITIF"
        elif label == "ARTICLES":
            pass
        elif re.match(r"\s*ARTICLE\s+\d+", line, re.I):
            flush()
            label = "ARTICLES"
        elif re.search(r"\bSIGN[ÉE]E?\b", line, re.I):
            flush()
            label = "SIGNATURE"
        elif re.match(r"\s*ANNEXE", line, re.I):
            flush()
            label = "ANNEXES"
        held.append(line)
    flush()
    return done


def test_sections_follow_the_machine(spark):
    import random

    random.seed(2)
    kinds = ["Titre", "SOMMAIRE", "ARRÊTÉ n° 1", "Vu la loi", "VU le code", "Considérant x", "DECIDE", "Article 1 — a", "texte", "Signé", "ANNEXE", "", "Vue"]
    texts = ["\n".join(random.choices(kinds, k=random.randint(1, 12))) for _ in range(300)]
    for text, got in zip(texts, apply(spark, acts.sections, *texts)):
        assert [(s.label, s.content) for s in got] == machine(text), text


def test_acts(spark):
    body = "Vu le code\nConsidérant que\nArticle 1\n" + "mot " * 80 + "\nFait à Testville"
    rows = spark.createDataFrame([("a", f"tête\nARRÊTÉ N° 1\n{body}\nArrêté du 2 mai\n{body}\nARRÊTÉ PORTANT x\ncourt"), ("b", None)], "source string, act string")
    got = acts.split_acts(rows, "source", "act").orderBy("index").collect()
    assert [(r.source, r["index"], r.titre) for r in got] == [("a", 1, "ARRÊTÉ N° 1"), ("a", 2, "Arrêté du 2 mai")]


def test_fields_dates_and_tags(spark):
    text = "Arrêté n° 2024-12 du 29 avril 2024 portant permis\nVu le code\n\nSigné : le préfet : M. X"
    rows = spark.createDataFrame([(text,), ("rien",)], "act string")
    got = rows.select("act", *extract.fields(F.col("act")))
    one, none = got.collect()
    assert (one.date_acte, one.objet_large, one.numero_acte, one.fonction_auteur, one.base_legale) == ("29 avril 2024", "permis", "2024-12", "le préfet", "le code")
    assert not any(none[n] for n in rules.FIELDS)
    assert "<NUMERO_ACTE>2024-12</NUMERO_ACTE>" in extract.tagged(got, "act", list(rules.FIELDS)).first().act
    assert [str(d) for d in apply(spark, extract.french_date, "29 avril 2024", "1er mai 2023", "3/12/2020", "31 février 2024", None)] == ["2024-04-29", "2023-05-01", "2020-12-03", "None", "None"]
    assert apply(spark, extract.month_number, "maintenance", "Février", "x") == [5, 2, 0]


def test_validation(spark):
    text = "ARRÊTE\nVu x\nArticle 1 — a\nArticle 3 — b « c"
    got = apply(spark, extract.validation, text)[0]
    assert (got.title, got.article_count, got.visas, got.opens, got.closes) == ("ARRÊTE", 2, 1, 1, 0) and len(got.warnings) == 2


def test_lines(spark):
    boxes = spark.createDataFrame([(1, 0, "a", 50, 0), (1, 1, "b", 5, 10), (1, 2, "c", 1, 24), (1, 3, "d", 0, 60), (1, 4, " ", 0, 90)], "page int, ord int, word string, x int, y int")
    assert [r.text for r in lines.page_text(lines.lines_of_boxes(boxes, "page"), "page").collect()] == ["c b a\nd"]
    rows = spark.createDataFrame([(1, "une phrase\nqui continue.\nAutre\nsuite\n\nVu x")], "k int, t string")
    assert lines.repair_line_breaks(rows, "k", "t").first().text == "une phrase qui continue.\nAutre suite\n\nVu x"
    pairs = spark.createDataFrame([(1, "a\nb\nc", "a\nx\nc\nd")], "k long, o string, n string")
    assert [(r.line, r.type, r.before, r.after) for r in lines.diff_lines(pairs, "k", "o", "n", "s").collect()] == [(2, "replace", "b", "x"), (4, "insert", "", "d")]


def test_web(spark):
    rows = spark.createDataFrame([("https://www.a.fr/Annee-2020/Mai-2020", "x"), ("https://a.fr/contenu/telechargement/3/f%20g", "Année 2019")], "url string, label string")
    got = rows.select(web.link_kind(F.col("url")).alias("k"), web.year_of(F.col("url"), F.col("label")).alias("y"), web.month_of(F.col("url"), F.col("label")).alias("m"), web.file_name(F.col("url")).alias("f")).collect()
    assert [tuple(r) for r in got] == [("month", 2020, 5, "Mai-2020.pdf"), ("pdf", 2019, 0, "f g.pdf")]
    base = F.lit("https://a.fr/d/p?q")
    assert apply(spark, lambda h: web.absolute(h, base), "/x", "y", "//b.c/z", "#k", "http://q/", "") == ["https://a.fr/x", "https://a.fr/d/y", "https://b.c/z", "https://a.fr/d/p#k", "http://q/", None]


def test_archive_and_search(spark):
    docs = spark.createDataFrame([("u1", 1), ("u1", 0), ("u2", 2)], "url string, pos int")
    assert sorted(map(tuple, archive.keep_first(docs, ["url"], [F.col("pos")]).collect())) == [("u1", 0), ("u2", 2)]
    assert [r.url for r in archive.pending(docs, docs.where("url = 'u1'")).collect()] == ["u2"]
    acts_ = spark.createDataFrame([("Préfet", "OBJET"), (None, "objet"), ("", "x")], "a string, o string")
    assert search.search(acts_, a="pRÉFET", o="obj").count() == 1 and search.search(acts_).count() == 3


def test_files_and_stream(spark, tmp_path):
    from quillspark.sources import files
    from quillspark.streaming import files as streams

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_bytes("é\nPAGE 3".encode())
    (tmp_path / "in/b.txt").write_bytes("é".encode("cp1252"))
    (tmp_path / "in/c.txt").write_bytes(b"\xef\xbb\xbfx")
    got = {r.path[-5:]: (r.encoding, r.text) for r in files.read_texts(spark, str(tmp_path / "in")).collect()}
    assert got == {"a.txt": ("utf-8", "é\nPAGE 3"), "b.txt": ("windows-1252", "é"), "c.txt": ("utf-8-sig", "x")}
    stream = streams.cleaned_stream(streams.text_stream(spark, str(tmp_path / "in")))
    streams.run_to_end(stream.where("path LIKE '%a.txt'"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert [r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["\n=== ENTETE_GLOBAL ===\né\n"]
