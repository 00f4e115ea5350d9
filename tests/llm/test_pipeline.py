"""The corpus pipeline, stage by stage, and the registration of all queries."""

import __spark_entry__ as entry_point
import corpus_pipeline
import pytest
from test_resemblance import brute_kept

from skylake.llm import common, decontamination, queries, secret_scan, toxicity

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    names = entry_point.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_stages(spark):
    docs = common.load(spark, SF_DIR, "documents")
    labels, benchmark = common.load(spark, SF_DIR, "labels"), common.load(spark, SF_DIR, "benchmark")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = common.settle(stage(spark, before, SF_DIR), name)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        ids, old = {r.doc_id for r in kept.select("doc_id").collect()}, {r.doc_id for r in before.select("doc_id").collect()}
        assert ids <= old
        if name == "toxicity":
            gone = {r.doc_id for r in toxicity.op1_toxicity(before, labels).where("predicted = 1").collect()}
        elif name == "near_dedup":
            gone = old - brute_kept(sorted((r.doc_id, r.text) for r in before.select("doc_id", "text").collect()))
        elif name == "decontamination":
            gone = {r.doc_id for r in decontamination.op4_decontamination(before, benchmark).where("contaminated").collect()}
        else:
            gone = set()
            assert secret_scan.op7_secrets(kept).where("n_assign + n_access > 0").count() == 0
        assert ids == old - gone
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR).collect()
    assert {r.doc_id for r in packed} == ids
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.start, r.ids_crc32) for r in packed)


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLE_SQL])
def test_queries_run(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    assert df.count() >= 50
