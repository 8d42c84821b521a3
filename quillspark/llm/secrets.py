"""Secret scans: all rules as one automaton, in a single pass over each text's bytes.

Rules are byte patterns with a least length, of the match or of the part that
begins at its first accepting byte (the value of an assignment). Matches of a
rule are leftmost, greedy and do not overlap; those below the least length are
dropped afterwards, as text they cover stays taken. Places are code points.

Edge cases: a null or empty text has no spans; repeated rows get equal rows; an
empty table gives an empty result; extra columns are left alone; texts of any
length are scanned whole, in memory proportional to the text.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quillspark.llm.automaton import Scanner, scanner
from quillspark.llm.common import map_batches, table


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int
    of_value: bool = False


#: The rules of the contract, in the order that breaks ties.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
)
#: Well-known shapes of further credentials.
MORE = (
    Rule("pem", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----", 27),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
)
RULES = BASE + MORE
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def compiled(rules: tuple[Rule, ...]) -> Scanner:
    return scanner(tuple(r.pattern for r in rules))


def secret_spans(text: str | None, rules: tuple[Rule, ...] = RULES, scan: Scanner | None = None) -> list[tuple[int, int, int]]:
    """(start, number of the rule, end) of every secret of a text, in order."""
    data = (text or "").encode()
    found = []
    for rule, start, first, end in (scan or compiled(rules)).matches(data):
        if end - (first if rules[rule].of_value else start) >= rules[rule].least:
            found.append((start, rule, end))
    if found and len(data) != len(text):
        places = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)  # code points up to a byte, itself included
        found = [(int(places[s]) - 1, r, int(places[s]) - 1 + e - s) for s, r, e in found]  # matches are ASCII
    return sorted(found)


def _listed(spans, rules: tuple[Rule, ...]) -> str:
    return ",".join(f"{rules[r].kind}:{s}:{e}" for s, r, e in spans)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, counts of the base kinds, a digest of their spans, and all spans."""

    scan = docs.sparkSession.sparkContext.broadcast(compiled(rules))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column("text").to_pylist():
            spans = secret_spans(text, rules, scan.value)
            base = [s for s in spans if s[1] < len(BASE)]
            counts = [sum(s[1] == k for s in base) for k in range(len(BASE))]
            rows.append((*counts, hashlib.sha256(_listed(base, rules).encode()).hexdigest(), _listed(spans, rules)))
        columns = list(zip(*rows)) if rows else [[]] * 5
        arrays = [pa.array(c, pa.int64() if i < 3 else pa.string()) for i, c in enumerate(columns)]
        return pa.record_batch([batch.column("doc_id"), *arrays], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return map_batches(docs.select("doc_id", "text"), run, SCHEMA)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


#: (kind, pattern for DuckDB, least length of the match or, with a group, of its value)
_SQL_RULES = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+""", 8),
    ("access", r"AKIA[A-Z0-9]+", 16),
    ("hex", r"[0-9a-f]+", 32),
    *((r.kind, r.pattern, r.least) for r in MORE),
)


def _sql_kind(k: int, kind: str, pattern: str, least: int) -> str:
    """Matches of one kind: the pieces between matches tell where each begins."""
    length = rf"""len(regexp_replace(m, '^[A-Za-z_]+["'']?\x20*[:=]\x20*["'']?', ''))""" if kind == "assign" else "len(m)"
    return f"""
  SELECT doc_id, {k} AS k, '{kind}' AS kind, begins AS s, begins + len(m) AS e FROM (
    SELECT doc_id, ms[i] AS m,
           list_sum(list_transform(ps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: len(x))), 0) AS begins
    FROM (SELECT doc_id, ms, ps, unnest(range(1, len(ms) + 1)) AS i FROM (
      SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS ps
      FROM documents WHERE text IS NOT NULL))
  ) WHERE {length} >= {least}"""


ORACLE = f"""
WITH found AS ({" UNION ALL ".join(_sql_kind(k, *r) for k, r in enumerate(_SQL_RULES))}
), listed AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, k) FILTER (k < 3) AS base,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, k) AS spans
  FROM found GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN listed l USING (doc_id)
"""
