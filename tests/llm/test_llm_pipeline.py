"""The pipeline's stages and the registered queries."""

import corpus_pipeline
import __spark_entry__
from reelhouse.llm import decontaminate, language_id, minhash_dedup, queries
from reelhouse.llm.common import stage, table

SF = "/root/testdata/sf0.001"


def test_stages_filter_and_keep_columns(spark):
    docs = first = table(spark, SF, "documents")
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, stage(step(spark, docs, SF), f"test-{name}")
        seen[name] = ({r.doc_id for r in before.select("doc_id").collect()}, {r.doc_id for r in docs.select("doc_id").collect()})
        if name != "shard":
            assert docs.columns == first.columns
        if name == "language":
            said = language_id.identify(before, language_id.learn(before))
            assert seen[name][1] == {r.doc_id for r in said.where("lang_pred != 'und'").collect()}
        if name == "near_dedup":
            assert seen[name][1] == {r.doc_id for r in minhash_dedup.near_classes(before).where("kept").collect()}
        if name == "decontaminate":
            bad = decontaminate.contamination(before, table(spark, SF, "benchmark")).where("contaminated")
            assert seen[name][1] == seen[name][0] - {r.doc_id for r in bad.collect()}
    assert seen["mix"][1] <= seen["mix"][0] and seen["shard"][0] == seen["shard"][1]
    assert {"shard", "slot"} <= set(docs.columns)


def test_queries_are_registered():
    have = __spark_entry__.queries()
    assert set(queries.QUERIES) <= set(have) and "pipeline" in have
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
