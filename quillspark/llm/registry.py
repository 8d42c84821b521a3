"""The queries of this subpackage and the SQL they are compared with."""

from __future__ import annotations

import corpus_pipeline
from quillspark.llm import line_templates, mixing, packed_ids, piece_bpe, quality, secrets, simhash, suffixes, topk, toxicity

_OPERATORS = {
    "op1_source_mix": (mixing.op1_source_mix, mixing.ORACLE),
    "op2_quality": (quality.op2_quality, None),
    "op3_secrets": (secrets.op3_secrets, secrets.ORACLE),
    "op4_simhash": (simhash.op4_simhash, None),
    "op5_line_templates": (line_templates.op5_line_templates, line_templates.ORACLE),
    "op6_piece_bpe": (piece_bpe.op6_piece_bpe, None),
    "op7_topk": (topk.op7_topk, topk.ORACLE),
    "op8_suffix_dedup": (suffixes.op8_suffix_dedup, None),
    "op9_toxicity": (toxicity.op9_toxicity, None),
    "op10_packed_ids": (packed_ids.op10_packed_ids, None),
}


def queries() -> dict:
    return {name: query for name, (query, _) in _OPERATORS.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """The pipeline and the operators without SQL here are tested against brute force."""
    return {name: sql for name, (_, sql) in _OPERATORS.items() if sql}
