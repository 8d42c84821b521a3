import os

import duckdb
import pytest

import __spark_entry__ as entry
from quillspark.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", ["search_acts", "split_acts", "extract_fields", "dedupe_links", "ocr_lines", "clean_s5_articles"])
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "orders", "customer", "pages", "lineitem", "events", "part"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    found = registry.queries()[name](spark, SF)
    asked = con.execute(registry.oracle_sql()[name])
    order = [[d[0] for d in asked.description].index(c) for c in found.columns]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in asked.fetchall())


def test_entry_lists(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns
