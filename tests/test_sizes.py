"""Rules that larger inputs showed to be dear: where they run, and that they still do the whole job."""

from pyspark.sql import functions as F

from quillspark.functions import cleaning
from quillspark.plans import registry

SF = "/root/testdata/sf0.001"


def test_composition_stays_out_of_python(spark):
    rows = spark.createDataFrame([("é x",), ("Ạ̊",), ("plain",), (None,)], "t string").select(cleaning.composed(F.col("t")).alias("t"))
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    assert [r.t for r in rows.collect()] == ["é x", "Ạ̊", "plain", None]


def test_corrections_are_made_once(spark):
    for name in ("encoding_corrections", "structure_corrections"):
        plan = registry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line and "regexp_replace" in line], name


def test_characters_differ_in_place(spark):
    pairs = [("", "", 0), ("", "ab", 2), ("abc", "abc", 0), ("abc", "bc", 3), ("a\U0001F600c", "a\U0001F600d", 1), (None, "a", None)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(pairs)], "i int, a string, b string")
    got = [r.n for r in rows.select("i", cleaning.char_differences(F.col("a"), F.col("b")).alias("n")).orderBy("i").collect()]
    assert got[:5] == [n for *_, n in pairs[:5]]


def test_articles_that_follow_each_other_are_all_repaired(spark):
    rows = spark.createDataFrame([("Ie Ie Ie Ia\nIes I'a I’été xIe Iet",)], "t string")
    assert rows.select(cleaning.repair_articles(F.col("t"))).head()[0] == "le le le la\nles l'a l’été xIe Iet"


def test_runs_of_capitals_count_once(spark):
    rows = spark.createDataFrame([("le S O M M A I R E et A B C.",), ("A B",), ("A " * 20000,)], "t string")
    got = [[(c.type, c["count"]) for c in r.corrections] for r in cleaning.typography_audit(rows, "t").collect()]
    assert got == [[("spaced_capitals", 2)], [], [("spaced_capitals", 1)]]
