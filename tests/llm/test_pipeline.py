"""The pipeline, stage by stage, against what the stages' operators must leave."""

import re

import corpus_pipeline
from conftest import DATA

from terrella.llm import common, near_dedup


def test_stages_keep_what_they_must(spark):
    docs = common.prepare(spark).read.parquet(f"{DATA}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = common.materialize(stage(spark, seen[-1], DATA), name)
        assert result.columns == docs.columns
        seen.append(result)
    texts = [{r["doc_id"]: r["text"] for r in s.collect()} for s in seen]
    assert set(texts[1]) == {d for d, t in texts[0].items() if t and re.search(r"[^\W\d_]", t)}
    kept = {r["doc_id"] for r in near_dedup.near_duplicates(seen[1]).filter("kept").collect()}
    assert set(texts[2]) == kept
    items = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert set(texts[3]) == {d for d, t in texts[2].items() if not any(i in " ".join(t.split()) for i in items)}
    assert set(texts[4]) == set(texts[3])
    assert not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9-]+", t) for t in texts[4].values())
    packed = corpus_pipeline.STAGES[-1][1](spark, seen[-1], DATA)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(texts[4])
