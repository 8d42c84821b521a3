"""Where queries and the SQL they are compared with are kept, and what their SQL shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: White space as Python and Spark's (?U) know it, for DuckDB.
S = r"[\s\x{000B}\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
L = r"[0-9A-Za-zÀ-ɏ_]"
NL = r"[^0-9A-Za-zÀ-ɏ_]"


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def replaced(text: str, *pairs: tuple[str, str]) -> str:
    """Nested replacements of all matches for DuckDB."""
    quoted = lambda s: s.replace("'", "''")
    return reduce(lambda c, p: f"regexp_replace({c}, '{quoted(p[0])}', '{quoted(p[1])}', 'g')", pairs, text)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; a local one where a local session names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="quillspark-")
    return f"{base.rstrip('/')}/quillspark-{uuid.uuid4().hex}"
