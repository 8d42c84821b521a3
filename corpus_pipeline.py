"""A training corpus from documents: rules, lines, near-duplicates, mix, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows of docs and returns a
DataFrame; its result is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents.

Edge cases, alike in every stage: an empty table gives an empty one; rows that
repeat are rows of their own until the near-copies stage, which keeps one of
them; a null id stays null and comes last where ids decide; columns other than
those of documents are left behind. A null text has no words, so the quality
rules reject it; in a later stage it has no lines to drop, is a copy of other
texts without words, takes no room in the mix and stays once, and encodes to no
ids. A null source is a source of its own. Texts are worked on whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import line_templates, mixing, piece_bpe, quality, simhash
from quillspark.llm.common import settle, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules and their forest keep."""
    return quality.keep_good(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates, long ones from two texts on; n_chars follows the text."""
    left = line_templates.drop_template_lines(docs.select(*COLUMNS), long_tokens=line_templates.LONG_TOKENS)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: five-word shingles, a similarity of 0.8 or more."""
    return simhash.keep_one_each(docs.select(*COLUMNS), similar_width=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mix_documents(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return piece_bpe.encode_documents(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_quality),
    ("lines", drop_lines),
    ("near_copies", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode),
]

#: SQL can express neither the forest nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
