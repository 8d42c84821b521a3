import json
import os

import pytest
from pyspark.sql import functions as F

from quillspark.functions import audits, cleaning, formats, rules, web
from quillspark.operators import acts, archive, crawl
from quillspark.plans import base, inputs, sites
from quillspark.sources import files, pdf, sinks

SITE = "https://www.a.fr"


def column(spark, rule, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in rows.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


def test_page_kinds_by_hand(spark):
    cases = {
        "/Annee-2020/Prefecture": "month", "/Annee-2020/": "year", "/Annee-2020": "year", "/Raa-de-x-2021/Mars": "month", "/x/Raa-du-val-2021-suite/page": "year",
        "/Les-recueils-des-actes-administratifs-annee-2019": "year", "/Les-recueils-des-actes-administratifs-annee-2019/x": "root", "/Mars": "month",
        "/Mars-2020/": "month", "/Mars-1800": "root", "/xMars": "root", "/F%C3%A9vrier": "month", "/annee-2020": "year", "": "root", "/Publications": "root",
    }
    assert dict(zip(cases, column(spark, web.page_kind, *(SITE + c for c in cases)))) == cases


def test_url_functions_by_hand(spark):
    assert column(spark, web.looks_official, *(SITE + p for p in ("/Recueil-des-actes-administratifs/x", "/RAA/", "/raab", "/documents+et+publications", "/x"))) == [True, True, False, True, False]
    assert column(spark, web.year_in_path, SITE + "/2019/annee-2021", SITE + "/20211", SITE + "/1999") == [2021, None, None]
    assert column(spark, web.first_year, "en 1999 et 2020", "rien", None) == [1999, 0, 0]
    assert column(spark, web.year_context, SITE + "/Annee-2020/x", SITE + "/x") == ["annee-2020", ""]
    assert column(spark, lambda u: web.year_label(u, F.lit(2020)), SITE + "/Raa-du-departement-de-Haut-Test-2020", SITE) == ["Année 2020 · Haut Test", "Année 2020"]
    assert column(spark, web.document_size, "Arrêté (1,5 Mo)", "12ko", "12 kg") == ["1,5 Mo", "12 ko", None]
    assert column(spark, web.document_date, "du 03/04/2021.", "3/4/2021") == ["03/04/2021", None]
    assert column(spark, web.folder_name, ' a:b  c ', "", "x" * 200) == ["a_b c", "document", "x" * 120]
    assert column(spark, web.escaped_attribute, "<a href='`'>") == ["&lt;a href=&#39;&#96;&#39;&gt;"]
    assert column(spark, web.without_slash, " x/ ", "x//") == ["x", "x/"]
    labels = column(spark, lambda m: web.month_label(m.cast("int"), F.lit(2020), F.lit("  autre   mois ")), "5", "0")
    assert labels == ["Mai 2020", "autre mois"]


def links_of(spark, base_url, *links):
    rows = [(1, i, base_url, SITE + u if u.startswith("/") else u, label) for i, (u, label) in enumerate(links)]
    return spark.createDataFrame(rows, "page_id long, pos long, base string, url string, label string")


def test_months_of_a_year(spark):
    links = links_of(
        spark, SITE + "/p/Annee-2020", ("/p/Annee-2020/Mars-2020?x", "Mars"), ("/p/Annee-2020/Fevrier-2020", ""), ("/p/Annee-2021/Mai-2021", "Mai"),
        ("/p/Annee-2020", "Année"), ("/p/Annee-2020/Mars-2020#y", "encore"), ("/p/Annee-2020/mars.pdf", "Mars"), ("/autre", "Juin 2020"),
    )
    assert [(r.month_key, r.label, r.place) for r in crawl.month_links(links).orderBy("place").collect()] == [("2020-02", "Février 2020", 1), ("2020-03", "Mars 2020", 2)]
    got = crawl.site_months(links).orderBy("month").collect()
    assert [(r.kind, r.month_key, r.url) for r in got] == [("year", "2020-02", SITE + "/p/Annee-2020/Fevrier-2020"), ("year", "2020-03", SITE + "/p/Annee-2020/Mars-2020")]


def test_direct_documents_and_errors(spark):
    direct = links_of(spark, SITE + "/Annee-2020", ("/contenu/telechargement/1/a", "A"))
    assert [(r.month_key, r.label) for r in crawl.site_months(direct).collect()] == [("2020-00", "PDF directs 2020")]
    none = links_of(spark, SITE + "/Annee-2020", ("/x", "y"))
    assert [r.error for r in crawl.pages_without_months(none, crawl.site_months(none)).collect()] == ["Aucun mois valide trouvé pour 2020."]
    single = links_of(spark, SITE + "/Annee-2020/Mai-2020", ("/x", "y"))
    assert [(r.kind, r.month_key, r.label) for r in crawl.site_months(single).collect()] == [("month", "2020-05", "Mai 2020")]
    root = links_of(spark, SITE + "/p", ("/p/Mai-2020", ""), ("/p/Juin", "Juin 2019"), ("/q/Mai-2020", ""))
    assert [r.month_key for r in crawl.collection_months(root).orderBy("place").collect()] == ["2020-05", "2019-06"]


def test_years_and_fallback(spark):
    links = links_of(spark, SITE + "/raa", ("/Annee-2019", "x"), ("/z", "Année 2021"), ("https://b.fr/Annee-2020", ""), ("/Annee-2019", "again"))
    assert [(r.year, r.place) for r in crawl.year_links(links).orderBy("place").collect()] == [(2021, 1), (2019, 2)]
    pages = spark.createDataFrame([(1, SITE + "/raa/", "Recueil 2018")], "page_id long, base string, heading string")
    assert [tuple(r) for r in crawl.official_years(links, pages).collect()] == [(1, SITE + "/raa", "Année 2018", 2018)]


def test_selection(spark):
    months = spark.createDataFrame([("a", 2020, "2020-01"), ("b", 2020, "2020-02"), ("c", 2019, "2019-01")], "selection string, year int, month_key string")
    chosen = spark.createDataFrame([("c",), ("z",)], "selection string")
    assert sorted(r.selection for r in crawl.changed_selection(chosen, months, 2020).collect()) == ["a", "b", "z"]
    docs = spark.createDataFrame([("u", "2020-01"), ("v", "2019-01"), ("w", "2018-01")], "url string, month_key string")
    assert sorted(r.url for r in crawl.selected(docs, months.where("year = 2020")).collect()) == ["u"]
    assert tuple(crawl.counts(docs, docs.where("url = 'u'")).head()) == (3, 1, 2)


def test_formats(spark):
    seconds = spark.createDataFrame([(59.94,), (60.0,), (125.9,)], "s double")
    assert [r[0] for r in seconds.select(formats.duration(F.col("s"))).collect()] == ["59.9s", "1m 00s", "2m 05s"]
    s = spark.range(1).select(formats.settings(F.lit(-5), F.lit(-9), F.lit(10)).alias("s")).head().s
    assert tuple(s) == (0, 0, 1000)
    assert formats.literal("a.b(c)") == r"a\.b\(c\)"
    pages = spark.sql("SELECT map(1, 'x', 3, 'z') AS p, 3 AS n").select(formats.page_file(F.col("p"), F.col("n"))).head()[0]
    assert pages == "\n===== PAGE 1 =====\nx\n\n===== PAGE 2 =====\n\n\n===== PAGE 3 =====\nz"


def test_corrections(spark):
    rows = spark.createDataFrame([(1, "nÂ  x ‘a’\n\n\n\n\nb"), (2, "rien"), (3, None)], "i int, t string")
    got = {r.i: [(c.type, c["count"]) for c in r.corrections] for r in audits.encoding_corrections(rows, "t").collect()}
    assert [k for k, _ in got[1]] == ["cleanup_artefacts", "corrupted_chars", "blank_lines"] and dict(got[1])["corrupted_chars"] == 2
    assert got[2] == got[3] == []
    total = audits.encoding_corrections(rows, "t").select(audits.totals(F.col("corrections")).alias("s")).collect()[1].s
    assert tuple(total) == (0, 0)
    titled = spark.createDataFrame([(1, "arrete"), (2, "Article 2 : x"), (3, "ARRÊTE")], "i int, t string")
    got = {r.i: [(c.type, c["count"]) for c in r.corrections] for r in audits.structure_corrections(titled, "t").collect()}
    assert got == {1: [("structure_title", 1), ("structure_articles", 0)], 2: [("structure_articles", 1)], 3: []}
    assert column(spark, lambda t: acts.missing_labels(acts.sections(t)), "Vu le code\nArticle 1 x") == [["DISPOSITIF", "SIGNATURE"]]


def test_encoding_rules_by_hand(spark):
    assert column(spark, cleaning.repair_mojibake, "lâ€™arrÃªtÃ© â€“ 5 â‚¬", "déjà â fin") == ["l’arrêté – 5 €", "déjà â fin"]
    assert column(spark, cleaning.decode_entities, "&eacute;&amp;lt; & &x;", "<b>&eacute;") == ["é&lt; & &x;", "<b>&eacute;"]
    assert column(spark, cleaning.narrow, "Ａ１！　x") == ["A1! x"]
    assert column(spark, cleaning.composed, "é", "é", None) == ["é", "é", None]
    assert column(spark, cleaning.drop_controls, "a\x00b\tc\x7f") == ["ab\tc"]
    assert column(spark, acts.normalized, "ﬁn ª ½ ĳ x") == ["ﬁn a 1⁄2 ij x"]


def test_fixed_values_are_what_they_were():
    """Tables that oracles share with the rules, pinned by hand."""
    assert [rules.ORDINALS[w] for w in ("premier", "une", "seconde", "dixième", "seize")] == [1, 1, 2, 10, 16] and len(rules.ORDINALS) == 40
    assert rules.MONTHS[1] == "fevrier" and rules.MONTH_NAMES[7] == "Août" and len(rules.TITLES) == 15
    assert rules.LOOKALIKES["а"] == "a" and rules.LOOKALIKES["…"] == "..." and len(rules.LOOKALIKES) == 64
    assert cleaning._mojibake()["Ã©"] == "é" and cleaning._mojibake()["â€™"] == "’"


def test_sources(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "sub").mkdir(parents=True)
    (folder / "b.txt").write_bytes("é".encode("utf-16-le").join([b"\xff\xfe", b""]))
    (folder / "sub/a.txt").write_bytes(b"a\xffb")
    (folder / "x.pdf").write_bytes(b"2 pages")
    assert [r.path.rsplit("/", 1)[1] for r in files.text_files(spark, str(folder)).collect()] == ["b.txt", "a.txt"]
    assert files.text_files(spark, str(folder / "b.txt")).count() == 1
    with pytest.raises(ValueError):
        files.text_files(spark, str(folder / "x.pdf"))
    with pytest.raises(FileNotFoundError):
        files.text_files(spark, str(folder / "none"))
    got = {r.path[-5:]: (r.encoding, r.text) for r in files.read_texts(spark, str(folder), recursive=True).collect()}
    assert got == {"b.txt": ("utf-16-le", "é"), "a.txt": ("windows-1252", "aÿb")}
    assert [r.text for r in files.read_dropping(spark, str(folder / "sub")).collect()] == ["ab"]
    guessed = files.read_texts(spark, str(folder / "sub"), statistics=True).collect()
    assert len(guessed) == 1 and guessed[0].encoding and guessed[0].text
    (tmp_path / "rows.json").write_text(json.dumps([{"a": 1}, {"a": 2}]))
    assert sorted(r.a for r in files.read_json(spark, str(tmp_path / "rows.json")).collect()) == [1, 2]
    spark.createDataFrame([("delay", "5")], "name string, value string").write.parquet(str(tmp_path / "settings"))
    assert {tuple(r) for r in files.stored_settings(spark, str(tmp_path / "settings"), {"delay": "1", "mode": "x"}).collect()} == {("delay", "5"), ("mode", "x")}


def test_pdf_pages_through_a_reader(spark, tmp_path):
    for name, raw in (("a", b"one|two"), ("b", b"!"), ("c", b"one|*")):
        (tmp_path / f"{name}.pdf").write_bytes(raw)

    def reader(raw):
        if raw == b"!":
            raise ValueError("broken")
        return [(part.strip(b"*").decode(), part == b"*") for part in raw.split(b"|")]

    found = pdf.pages(pdf.pdf_files(spark, str(tmp_path)), reader)
    got = {r.path[-5]: (r.text, r.route) for r in pdf.texts(found).collect()}
    assert got == {"a": ("one\n\ntwo", "texte"), "b": ("", "ocr"), "c": ("one", "ocr")}
    with pytest.raises(RuntimeError):
        pdf.pages(pdf.pdf_files(spark, str(tmp_path)), None)


def test_sinks(spark, tmp_path):
    texts = spark.createDataFrame([("/d/a.txt", "Page 3\nMonsieur Jean DUPONTEST\nva"), ("/d/b.txt", None)], "path string, text string")
    assert [tuple(r) for r in sinks.anonymized_files(texts).orderBy("path").collect()][0] == ("/d/a_anonymise.txt", "Page 3\nMonsieur XXX\nva")
    assert sinks.unpaged_files(texts).orderBy("path").head().text == "Monsieur Jean DUPONTEST\nva"
    got = sinks.rejoined_files(texts.where("text IS NOT NULL")).head()
    assert (got.lines_before, got.lines_after) == (3, 2)
    stems = texts.select(sinks.stem_of(F.col("path")).alias("stem"), "text").where("text IS NOT NULL")
    sinks.write_texts(stems, str(tmp_path / "out"))
    assert os.listdir(tmp_path / "out") and spark.read.text(str(tmp_path / "out"), wholetext=True).head().value.startswith("Page 3")
    rows = spark.createDataFrame([(2, "é"), (1, None)], "id int, objet string")
    lines = sinks.envelope(rows, [F.col("id")]).orderBy("at").collect()
    assert json.loads("".join(r.line for r in lines)) == {"success": True, "count": 2, "raa_exemples": [{"id": 1, "objet": None}, {"id": 2, "objet": "é"}]}
    empty = "".join(r.line for r in sinks.envelope(rows.where("id > 9"), [F.col("id")]).orderBy("at").collect())
    assert json.loads(empty) == {"success": True, "count": 0, "raa_exemples": []}
    assert json.loads(sinks.error_envelope("é")) == {"success": False, "erreur": "é"}
    one = spark.createDataFrame([("s", 1, 5), ("s", 0, 6)], "source string, index int, n int").withColumn("act", F.struct("n")).drop("n")
    made = json.loads(sinks.acts_document(one).head().json)
    assert made["total_arretes"] == 2 and made["arretes"] == [{"n": 6}, {"n": 5}]
    written = spark.createDataFrame([("s", 1, "texte")], "source string, index int, file string")
    sinks.write_acts(written, str(tmp_path / "acts"))
    assert os.path.isdir(tmp_path / "acts" / "source=s" / "act=arrete_001")


def test_summary_counts_documents(spark):
    docs = spark.createDataFrame([(2020, 1, "a"), (2020, 1, "b"), (2020, 3, "c"), (2019, 2, "d")], "year int, month int, url string")
    assert sorted(map(tuple, archive.site_summary(docs).collect())) == [(2019, 1, 1, 2, 2), (2020, 2, 3, 1, 3)]


def test_streams_remember_keys_over_runs(spark, tmp_path):
    from quillspark.streaming import files as streams

    read = lambda: spark.readStream.schema("url string").parquet(str(tmp_path / "in"))
    spark.createDataFrame([("a",), ("a",), (None,)], "url string").write.parquet(str(tmp_path / "in"))
    streams.new_keys_to_end(read(), "url", str(tmp_path / "t"), str(tmp_path / "c"))
    spark.createDataFrame([("a",), ("b",)], "url string").write.mode("append").parquet(str(tmp_path / "in"))
    streams.new_keys_to_end(read(), "url", str(tmp_path / "t"), str(tmp_path / "c"))
    assert sorted((r.url, r.batch) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [("a", 0), ("b", 1)]


def test_a_cluster_needs_a_shared_folder(spark):
    assert base.shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert sites and inputs


def test_links_are_resolved_as_browsers_do(spark):
    from urllib.parse import urljoin

    hrefs = ["a.pdf", "./a", "../a", "../../../x", "/b/../c", "?q=1", "#h", "//b.fr/x", "http://c.fr/y", "a/./b/..", "..", "."]
    for base_url in ("https://a.fr/p/q/r.html?x=1", "https://a.fr/p/", "https://a.fr"):
        got = column(spark, lambda h, b=base_url: web.absolute(h, F.lit(b)), *hrefs)
        assert got == [urljoin(base_url if base_url.count("/") > 2 else base_url + "/", h) if h not in ("?q=1", "#h") else urljoin(base_url, h).replace("?x=1#", "#") for h in hrefs], base_url
    assert column(spark, lambda h: web.absolute(h, F.lit(SITE)), "", None) == [None, None]


def test_commands(spark, tmp_path):
    from quillspark import run

    (tmp_path / "in").mkdir()
    act = "ARRETE N° 2020-1 portant avis\nVu le code\nMonsieur Jean DUPONTEST\nLe préfet\nArticle 1 : " + "x " * 200 + "\nFait à Testville"
    (tmp_path / "in/a.txt").write_text(act)
    for command in ("clean", "anonymise", "unpage", "rejoin", "extract"):
        run.main([command, str(tmp_path / "in"), str(tmp_path / command)])
    assert "XXX" in spark.read.text(str(tmp_path / "anonymise"), wholetext=True).head().value
    assert os.path.isdir(tmp_path / "clean/acts/source=a") and spark.read.parquet(str(tmp_path / "extract")).head().json
    html = '<a href="Mai-2020">Mai</a><a href="/contenu/telechargement/1/x">X</a>'
    spark.createDataFrame([(1, SITE + "/Annee-2020/", html)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages"))
    run.main(["crawl", str(tmp_path / "pages"), str(tmp_path / "site")])
    assert [r.month_key for r in spark.read.parquet(str(tmp_path / "site/months")).collect()] == ["2020-05"]


def test_boxes_through_a_recognizer(spark, tmp_path):
    from quillspark.operators import lines

    (tmp_path / "a.pdf").write_bytes(b"x")
    found = pdf.boxes(pdf.pdf_files(spark, str(tmp_path)), lambda raw: [[("b", 50, 0), ("a", 5, 10)], []])
    assert [r.text for r in lines.lines_of_boxes(found, "page").collect()] == ["a b"]
    with pytest.raises(RuntimeError):
        pdf.boxes(pdf.pdf_files(spark, str(tmp_path)), None)


def test_streams_forget_behind_the_watermark_and_stop(spark, tmp_path):
    import datetime

    from quillspark.streaming import files as streams

    at = lambda hour: datetime.datetime(2024, 1, 1, hour)
    rows = [("a", at(1)), ("a", at(1)), ("b", at(2))]
    spark.createDataFrame(rows, "url string, t timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("url string, t timestamp").parquet(str(tmp_path / "in"))
    streams.run_to_end(streams.new_urls(stream, "t"), str(tmp_path / "out"), str(tmp_path / "c"))
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
    running = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c2")).start()
    streams.stop(running)
    assert not running.isActive
