"""The pipeline's stages on a small folder of tables."""

import corpus_pipeline
from conftest import SF_SMALL


def test_stages_keep_their_contracts(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids, name
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        ids = now
    assert ids
