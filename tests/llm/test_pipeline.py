"""The pipeline's stages, one after another, on small tables."""

import corpus_pipeline
from arspark.llm import jaccard
from arspark.llm.common import table
from tests.conftest import SF_SMALL


def test_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], SF_SMALL).cache())
        assert kept[-1].columns == docs.columns
    found = {r.doc_id for r in jaccard.near_duplicates(kept[1]).collect() if r.doc_id == r.component_id}
    assert {r.doc_id for r in kept[2].select("doc_id").collect()} == found and kept[2].count() == len(found)
    assert kept[3].count() == kept[2].count()
    last = corpus_pipeline.STAGES[-1][1](spark, kept[-1], SF_SMALL)
    assert {r.doc_id for r in last.select("doc_id").distinct().collect()} == {r.doc_id for r in kept[-1].select("doc_id").collect()}
