"""Act fields, tags, anonymisation, scores, validation and dates as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import rules
from quillspark.functions.cleaning import strip, sub


def field(text: Column, name: str) -> Column:
    """Group 1 of the first match of a field's pattern, stripped; null without a match."""
    pattern = rules.FIELDS[name]
    return F.when(text.rlike(pattern), strip(F.regexp_extract(text, pattern, 1)))


def fields(text: Column) -> list[Column]:
    return [field(text, name).alias(name) for name in rules.FIELDS]


def tagged(rows: DataFrame, text: str, names: list[str]) -> DataFrame:
    """The rows with the first literal occurrence of each field's value wrapped in its tag, one field after the other.

    Each field is a projection of its own: it looks at the text several times.
    """
    for name in names:
        tag, value, at = "OBJET" if name == "objet_large" else name.upper(), F.col(name), F.position(name, text)
        before, after = F.substring(text, F.lit(1), at - 1), F.substring(text, at + F.length(value), F.length(text))
        wrapped = F.concat(before, F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>"), after)
        rows = rows.withColumn(text, F.when((value != "") & (at > 0), wrapped).otherwise(F.col(text)))
    return rows


def act_json(at: Column, text: Column, values: dict[str, Column]) -> Column:
    """One act as a JSON object."""
    names = {
        "numero_acte": "numero_acte", "date": "date_acte", "prefecture": "prefecture", "auteur": "fonction_auteur",
        "objet": "objet_large", "base_legale": "base_legale",
    }
    members = [(at + 1).alias("id"), *(values[v].alias(k) for k, v in names.items()), strip(text).alias("contenu")]
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})


def anonymized(text: Column) -> Column:
    """Names after a compliment masked: given and surname, surname and given, several given names."""
    shapes = (
        rf"{rules.GIVEN}\s+{rules.SURNAME}",
        rf"{rules.SURNAME}\s+{rules.GIVEN}",
        rf"{rules.GIVEN}(?:\s+{rules.GIVEN}){{1,3}}\s+{rules.SURNAME}",
    )
    return reduce(lambda c, shape: sub(c, rf"(?U)\b{rules.CIVILITY}\s+{shape}\b", "$1 XXX"), shapes, text)


def score(text: Column) -> Column:
    """0 to 7: how many marks of an act the text shows."""
    return reduce(lambda a, b: a + b, [text.rlike(p).cast("int") for p in rules.SCORE_MARKS])


def title(text: Column) -> Column:
    """The first of the first ten lines with more than ten characters."""
    lines = F.transform(F.slice(F.split(text, "\n", -1), 1, 10), strip)
    return F.coalesce(F.get(F.filter(lines, lambda line: F.length(line) > 10), F.lit(0)), F.lit("TITRE_NON_DETECTE"))


def validation(text: Column) -> Column:
    """struct<valid, title, article_count, article_type, opens, closes, visas, warnings>."""
    head = r"(?mUd)^\s*(ARR[ÊÉE]TE|D[ÉE]CIDE|ORDONNE)\s*$"
    numbers = F.regexp_extract_all(text, F.lit(r"(?mUdiu)^\s*Article\s+(\d+|1er|unique)\s"), F.lit(1))
    first = F.get(numbers, F.lit(0))
    plain = F.transform(F.filter(numbers, lambda n: n.rlike("^[0-9]")), lambda n: F.regexp_extract(n, r"^(\d+)", 1).cast("long"))
    expected = lambda i: F.when(i == 0, F.lit(1)).otherwise(F.get(plain, i - 1) + 1)
    breaks = F.filter(
        F.transform(plain, lambda n, i: F.struct(expected(i).cast("long").alias("expected"), n.alias("found"))), lambda p: p["expected"] != p["found"]
    )
    said = F.transform(breaks, lambda p: F.concat(F.lit("séquence: article "), p["expected"].cast("string"), F.lit(" attendu, article "), p["found"].cast("string"), F.lit(" trouvé")))
    opens, closes = F.regexp_count(text, F.lit("«")), F.regexp_count(text, F.lit("»"))
    visas = F.regexp_count(text, F.lit(r"(?mUd)^\s*Vu\b"))
    warned = lambda test, words: F.when(test, F.array(F.lit(words))).otherwise(F.array().cast("array<string>"))
    warnings = F.concat(
        warned(~text.rlike(head), "aucun titre"),
        F.when(F.coalesce(first, F.lit("")) == "unique", F.array().cast("array<string>")).otherwise(said),
        warned(opens != closes, "guillemets déséquilibrés"),
        warned(visas == 0, "aucun visa"),
    )
    kind = F.when(first == "unique", "unique").when(first.isNotNull(), "numbered")
    return F.struct(
        F.lit(True).alias("valid"), F.when(text.rlike(head), F.regexp_extract(text, head, 1)).alias("title"),
        F.size(numbers).alias("article_count"), kind.alias("article_type"), opens.alias("opens"), closes.alias("closes"),
        visas.alias("visas"), warnings.alias("warnings"),
    )


def without_diacritics(text: Column) -> Column:
    """French letters without their diacritics."""
    return F.translate(text, "àâäáãéèêëíìîïóòôöõúùûüçñÿÀÂÄÁÃÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÇÑŸ", "aaaaaeeeeiiiiooooouuuucnyAAAAAEEEEIIIIOOOOOUUUUCNY")


def month_number(text: Column) -> Column:
    """The first month in calendar order whose name the text holds, else 0."""
    plain = without_diacritics(F.lower(text))
    return F.coalesce(*(F.when(plain.contains(m), F.lit(i + 1)) for i, m in enumerate(rules.MONTHS)), F.lit(0))


def french_date(text: Column) -> Column:
    """``29 avril 2024``, ``1er mai 2024`` or ``29/4/2024`` as a date; null if it is none."""
    words = r"^\s*(\d{1,2})(?:er)?\s+(\p{L}+)\s+(\d{4})\s*$"
    digits = r"^\s*(\d{1,2})[/-](\d{1,2})[/-](\d{4})\s*$"
    month = F.array_position(F.array(*map(F.lit, rules.MONTHS)), without_diacritics(F.lower(F.regexp_extract(text, words, 2))))
    spelt = F.concat_ws("-", F.regexp_extract(text, words, 3), month.cast("string"), F.regexp_extract(text, words, 1))
    plain = F.concat_ws("-", F.regexp_extract(text, digits, 3), F.regexp_extract(text, digits, 2), F.regexp_extract(text, digits, 1))
    written = F.when(text.rlike(words) & (month > 0), spelt).when(text.rlike(digits), plain)
    return F.try_to_date(written, "y-M-d")


def route(text: Column, has_image: Column) -> Column:
    """ocr for pages with images or many unmapped glyphs, else texte."""
    share = F.regexp_count(text, F.lit(r"\(cid:")) / F.greatest(F.length(text), F.lit(1))
    return F.when(has_image | (share > 0.01), "ocr").otherwise("texte")
