import duckdb

from quillspark.plans import inputs, registry


def test_acts_hold_whole_texts(spark, tmp_path):
    long = "premier mot " + "x y " * 2000 + "\nVu le code final\ndernier"
    rows = [(i, long if i else None, "s") for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("section_marks", "clean_pipeline", "act_json"):
        got = {r[0]: r[1] for r in registry.queries()[name](spark, str(tmp_path)).collect()}
        assert set(got) == set(range(6)) and all("code final" in got[i] for i in range(1, 6)), name
    sql = f"SELECT doc_id, source, {inputs.ACT} AS act FROM read_parquet('{tmp_path}/documents.parquet/*.parquet') ORDER BY doc_id"
    assert [tuple(r) for r in inputs.acts(spark, str(tmp_path)).orderBy("doc_id").collect()] == duckdb.sql(sql).fetchall()


def test_dates_of_whole_acts_equal_the_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = registry.queries()["french_date"](spark, sf).select("doc_id", "date_acte", "month").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(registry.oracle_sql()["french_date"]).fetchall())
