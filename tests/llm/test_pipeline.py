from __future__ import annotations

import corpus_pipeline
from tallyspark.llm import decontaminate, simhash, toxicity
from tallyspark.llm.common import read

SF = "/root/testdata/sf0.001"


def test_stages_feed_each_other(spark):
    docs = read(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], SF).cache())
    for before, after in zip(seen[:-2], seen[1:-1], strict=True):
        assert after.columns == docs.columns
        assert after.count() <= before.count()
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False))
    toxic = {r["doc_id"] for r in toxicity.report(docs, read(spark, SF, "labels")).filter("toxic").collect()}
    assert ids[1] == ids[0] - toxic
    assert ids[2] == {r["component_id"] for r in simhash.near_duplicates(seen[1]).collect()}
    dirty = {r["doc_id"] for r in decontaminate.report(seen[2], read(spark, SF, "benchmark")).filter("contaminated").collect()}
    assert dirty and ids[3] == ids[2] - dirty
    assert ids[4] == ids[3] == ids[5]
    assert not seen[4].filter("text rlike '[a-z0-9]@mail[0-9]'").count()
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, seen[5].collect()))


def test_stages_take_odd_and_empty_tables(spark, odd, no_docs):
    for docs in (odd, no_docs):
        now = docs
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF)
            assert name == "bpe" or now.columns == docs.columns
        assert now.count() <= docs.count()
