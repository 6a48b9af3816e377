import helpers
import pytest

import corpus_pipeline as cp
from gapledger.llm import decontam, pu_quality, toxicity
from gapledger.llm.common import crc_remainder

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        done = cp.written(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs, done))
        docs = done
    return {name: (a, b) for name, a, b in out}


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_filters_keep_columns_and_drop_what_the_models_reject(spark, stages):
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns and ids(after) < ids(before)
    before, after = stages["quality"]
    learned = crc_remainder("doc_id", 4) != 2
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = pu_quality.score(before, pu_quality.fit(before.where(learned), labels.where(learned)))
    assert ids(after) == ids(scored.where("predicted = 1"))
    before, after = stages["toxicity"]
    learned = crc_remainder("doc_id", 5) != 0
    scored = toxicity.score(before, toxicity.fit(before.where(learned), labels.where(learned)))
    assert ids(after) == ids(scored.where("predicted = 0"))


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    found = helpers.jaccard_components([(r.doc_id, r.text) for r in before.collect()])
    assert ids(after) == {i for i, (_, c) in found.items() if i == c}


def test_no_benchmark_item_is_left(spark, stages):
    before, after = stages["decontamination"]
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert ids(before) - ids(after) == ids(decontam.contaminated(before, items))
    assert decontam.contaminated(after, items).count() == 0


def test_every_token_is_packed_once(stages):
    before, after = stages["packing"]
    assert ids(after) == ids(before)
    rows = after.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in rows)


@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_odd_documents_pass_every_stage(spark, request, rows):
    docs = request.getfixturevalue(rows)
    for name, stage in cp.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        if name != "packing":
            assert out.columns == docs.columns
        out.collect()
