"""The ordered pipeline of cleaning steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import cleaning
from quillspark.operators.acts import with_section_marks

#: The steps in order and the rules of each; every rule takes and gives a text column.
STEPS = {
    "encoding": (
        cleaning.decode_entities, cleaning.repair_mojibake, cleaning.narrow, cleaning.plain_line_ends, cleaning.drop_stray_a,
        cleaning.drop_unreadable, cleaning.straighten_quotes, cleaning.whitelist, cleaning.unify_newlines,
    ),
    "unicode": (cleaning.fix_unicode,),
    "ocr": (cleaning.repair_articles, cleaning.join_hyphenated, cleaning.repair_rn, cleaning.single_spaces),
    "typography": (cleaning.fix_typography,),
    "structure": (cleaning.strip_page_numbers, cleaning.normalize_act_words, cleaning.normalize_articles, cleaning.normalize_keywords),
    "casing": (cleaning.lower_titles, cleaning.lower_capitals),
    "sections": (with_section_marks,),
    "final": (cleaning.fix_final,),
}


def cleaned(rows: DataFrame, column: str, steps: tuple[str, ...] = tuple(STEPS)) -> DataFrame:
    """The rows with a text column cleaned.

    Rules that look at their text more than once are kept in projections of
    their own, as one expression would evaluate all before it again each time.
    """
    for step in steps:
        for rule in STEPS[step]:
            rows = rows.withColumn(column, rule(F.col(column)))
    return rows
