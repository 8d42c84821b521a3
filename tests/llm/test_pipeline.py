import os

import pytest

import corpus_pipeline
from quillspark.llm import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def test_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        names.append(name)
        if name != "encode":
            assert out.columns == docs.columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert names == ["quality", "lines", "near_copies", "mix", "encode"]
    rows = docs.collect()
    assert rows and all(r.exact for r in rows)
    again = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in again) == sorted((r.doc_id, r.n_tokens) for r in rows)


def test_every_operator_is_registered():
    names = set(registry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
