import corpus_pipeline
from quillspark.llm import line_templates

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_long_lines_recur_from_two_texts(spark, stored):
    passage = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    rows = [(i, f"{own} own words\n{passage}\nshort line of two", "xx", "s", 0) for i, own in enumerate(("first", "second"))]
    docs = stored(rows, DOCS)
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, docs, "").collect()}
    assert got == {0: rows[0][1], 1: "second own words\nshort line of two"}
    assert {r.doc_id: r.text for r in line_templates.drop_template_lines(docs).collect()} == {r[0]: r[1] for r in rows}
