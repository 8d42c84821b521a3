"""Search over acts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import rules


def search(
    acts: DataFrame, since: str | None = None, until: str | None = None, **words: str | None
) -> DataFrame:
    """Acts that meet every given predicate: dates from and to, and words contained in columns, in either case.

    A given predicate rejects null and empty values; one that is not given passes all.
    The dates reach the scan as pushed filters.
    """
    tests = []
    if since:
        tests.append(F.col("date_acte") >= F.lit(since).cast("date"))
    if until:
        tests.append(F.col("date_acte") <= F.lit(until).cast("date"))
    for column, word in words.items():
        if word:
            tests.append(F.lower(column).contains(word.lower()))
    return acts.where(reduce(lambda a, b: a & b, tests)) if tests else acts


def or_default(value: Column, default: str = rules.DEFAULT_CELL) -> Column:
    """A default for null, empty and "0"."""
    return F.when(value.isNull() | value.isin("", "0"), F.lit(default)).otherwise(value)


def api_rows(acts: DataFrame) -> DataFrame:
    """Rows as the search page shows them."""
    subject = or_default(F.col("objet"), rules.DEFAULT_OBJECT)
    return acts.select(
        F.col("date_acte").alias("date"), F.col("fonction_signataire").alias("auteur"), "base_legale", "numero_arrete", subject.alias("objet"),
        F.concat(F.lit("Arrêté n°"), F.col("numero_arrete"), F.lit(" relatif à "), subject, F.lit(".")).alias("contenu"),
    )


def category(value: Column) -> Column:
    """0 to 3 by the first character's code; 0 for none."""
    return F.when(value.isNull() | (value == ""), F.lit(0)).otherwise(F.pmod(F.ascii(value), F.lit(4)))
