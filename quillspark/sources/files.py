"""Text files as rows: encodings detected and decoded, whole files as values."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The marks that files of an encoding begin with.
MARKS = {"utf-8-sig": b"\xef\xbb\xbf", "utf-16-le": b"\xff\xfe", "utf-16-be": b"\xfe\xff"}


def read_raw(spark: SparkSession, path: str, recursive: bool = False, pattern: str = "*.txt") -> DataFrame:
    """path, content (bytes) of files that match, in no order; missing folders raise when read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(path).select("path", "content")


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """path, content of one text file, or of all below a folder, in the order of their paths.

    A file of another kind is a ValueError, a path that is not there a FileNotFoundError.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(where):
        raise FileNotFoundError(path)
    if system.getFileStatus(where).isFile() and not path.lower().endswith(".txt"):
        raise ValueError(f"not a text file: {path}")
    return read_raw(spark, path, recursive=True).orderBy("path")


def encoding_of(content: Column) -> Column:
    """The encoding of a mark, utf-8 where the bytes are valid, null where only their statistics can tell."""
    marked = [F.when(F.startswith(content, F.lit(mark)), name) for name, mark in MARKS.items()]
    return F.coalesce(*marked, F.when(F.is_valid_utf8(content.cast("string")), "utf-8"))


def guessed_encoding(raw: bytes) -> str:
    """By the statistics of the bytes, if a library for that is there; windows-1252 for Latin-1 and where nothing fits."""
    try:
        from charset_normalizer import from_bytes
    except ImportError:
        return "windows-1252"
    best = from_bytes(raw).best()
    name = best.encoding.lower() if best is not None else "windows-1252"
    return "windows-1252" if name in ("iso-8859-1", "latin-1", "latin_1", "iso8859-1") else name


def _decoded(content: pd.Series, encoding: pd.Series) -> pd.DataFrame:
    """Bytes by their encoding, or a guessed one; what it leaves open becomes U+FFFD, and a leading mark goes."""
    rows = []
    for raw, name in zip(content, encoding):
        name = name or (guessed_encoding(raw) if raw is not None else None)
        text = None if raw is None else raw.decode(name, "replace").removeprefix("\ufeff")
        rows.append((name, text))
    return pd.DataFrame(rows, columns=["encoding", "text"])


def read_texts(spark: SparkSession, path: str, recursive: bool = False, statistics: bool = False) -> DataFrame:
    """path, encoding, text of every text file, read once; valid UTF-8 is cast, and only other bytes go through Python.

    What has no mark and is not UTF-8 is windows-1252, or, if asked for, what the statistics of its bytes tell.
    """
    told = encoding_of(F.col("content"))
    raw = read_raw(spark, path, recursive).withColumn("encoding", told if statistics else F.coalesce(told, F.lit("windows-1252")))
    plain = F.col("encoding").isin("utf-8", "utf-8-sig") & F.col("encoding").isNotNull()
    decode = F.pandas_udf(_decoded, "encoding string, text string")
    other = decode(F.when(~F.coalesce(plain, F.lit(False)), F.col("content")), F.col("encoding"))
    rows = raw.withColumn("other", other)
    start = F.when(F.col("encoding") == "utf-8-sig", F.lit(4)).otherwise(F.lit(1))
    text = F.when(plain, F.substring("content", start, F.length("content")).cast("string")).otherwise(F.col("other.text"))
    return rows.select("path", F.coalesce("other.encoding", "encoding").alias("encoding"), text.alias("text"))


def _dropped(content: pd.Series) -> pd.Series:
    return content.map(lambda b: None if b is None else b.decode("utf-8", "ignore"))


def read_dropping(spark: SparkSession, path: str) -> DataFrame:
    """path, text with bytes that are not UTF-8 left out."""
    raw = read_raw(spark, path)
    drop = F.pandas_udf(_dropped, "string")
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    return raw.select("path", F.when(valid, F.col("content").cast("string")).otherwise(drop(F.when(~valid, F.col("content")))).alias("text"))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows of JSON files, an object a line or one array a file."""
    return spark.read.option("multiLine", True).json(path)


def stored_settings(spark: SparkSession, path: str, defaults: dict[str, str]) -> DataFrame:
    """name, value: the settings stored at a path (name, value) with defaults for the others."""
    known = spark.createDataFrame(list(defaults.items()), "name string, default string")
    stored = spark.read.schema("name string, value string").parquet(path)
    return known.join(stored, "name", "left").select("name", F.coalesce("value", "default").alias("value"))
