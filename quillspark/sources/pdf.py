"""PDF files as pages, through a reader that the caller brings.

No PDF or OCR library belongs to this package. A reader takes a file's bytes and
gives its pages: (text, has_image) each. Its pages then go the ways of texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.sources.files import read_raw

Reader = Callable[[bytes], Iterable[tuple[str, bool]]]
PAGES = "path string, page int, text string, has_image boolean, error string"


def pdf_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """path, content of every PDF file."""
    return read_raw(spark, path, recursive, "*.pdf")


def pages(files: DataFrame, reader: Reader | None) -> DataFrame:
    """path, page, text, has_image, error: a row a page; a file that the reader fails on has one row with its error."""
    if reader is None:
        raise RuntimeError("give a reader of PDF bytes: this package has none of its own")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                try:
                    rows = [(path, i + 1, text, image, None) for i, (text, image) in enumerate(reader(bytes(content)))]
                except Exception as error:  # noqa: BLE001  a file that cannot be read goes another way
                    rows = [(path, None, None, None, str(error))]
                yield pd.DataFrame(rows, columns=["path", "page", "text", "has_image", "error"])

    return files.select("path", "content").mapInPandas(run, PAGES)


def texts(of_pages: DataFrame) -> DataFrame:
    """path, text, route of every file: the pages' texts that are not empty with blank lines between, and the way it goes.

    ``ocr`` for files with an image behind the first page, many unmapped glyphs or an error, else ``texte``.
    """
    in_order = F.array_sort(F.collect_list(F.when(F.trim("text") != "", F.struct("page", "text"))))
    image = F.coalesce(F.bool_or(F.col("has_image") & (F.col("page") > 1)), F.lit(False))
    files = of_pages.groupBy("path").agg(in_order.alias("held"), image.alias("image"), F.bool_or(F.col("error").isNotNull()).alias("failed"))
    text = F.array_join(F.transform("held", lambda p: p["text"]), "\n\n")
    share = F.regexp_count("text", F.lit(r"\(cid:")) / F.greatest(F.length("text"), F.lit(1))
    route = F.when(F.col("failed") | F.col("image") | (share > 0.01), "ocr").otherwise("texte")
    return files.withColumn("text", text).select("path", "text", route.alias("route"))


Recognizer = Callable[[bytes], Iterable[list[tuple[str, int, int]]]]
BOXES = "path string, page int, ord int, word string, x int, y int"


def boxes(files: DataFrame, recognizer: Recognizer | None) -> DataFrame:
    """path, page, ord, word, x, y: the word boxes that a recognizer of images finds on each page, for ``lines_of_boxes``."""
    if recognizer is None:
        raise RuntimeError("give a recognizer of PDF bytes: this package has none of its own")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                for page, words in enumerate(recognizer(bytes(content)), 1):
                    rows = [(path, page, i, word, x, y) for i, (word, x, y) in enumerate(words)]
                    yield pd.DataFrame(rows, columns=["path", "page", "ord", "word", "x", "y"])

    return files.select("path", "content").mapInPandas(run, BOXES)
