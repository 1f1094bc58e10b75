"""The pipeline's stages, each held against brute force on its own input."""

from __future__ import annotations

import pytest
from test_line_templates import prose
from test_minhash import brute_force
from test_packing import check as check_batches
from test_quality import brute_judge

import corpus_pipeline
from feedloom.workspace import settle

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def inputs(spark):
    """The input of each stage by its name, and the last stage's rows under `end`."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        found[name] = docs
        docs = settle(stage(spark, docs, FOLDER), name)
    return found | {"end": docs}


def texts(docs):
    return {row["doc_id"]: row["text"] for row in docs.collect()}


def test_the_stages_are_the_five_in_order():
    names = ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert [name for name, _ in corpus_pipeline.STAGES] == names


def test_rejected_documents_go_and_clean_ones_stay(inputs):
    rows = [(row["doc_id"], row["text"], row["source"]) for row in inputs["quality_rules"].collect()]
    kept = {doc_id for doc_id, (_, _, kept) in brute_judge(rows, 10, 5, 50).items() if kept}
    assert set(texts(inputs["line_dedup"])) == kept and 0 < len(kept) < len(rows)


def test_line_dedup_only_takes_lines_away(inputs):
    before, after = texts(inputs["line_dedup"]), texts(inputs["near_dedup"])
    assert set(after) <= set(before)
    for doc_id, text in after.items():
        lines = iter(before[doc_id].split("\n"))
        assert all(line in lines for line in text.split("\n"))


def test_one_document_of_each_group_stays(inputs):
    rows = list(texts(inputs["near_dedup"]).items())
    components, _ = brute_force(rows, 5, 80)
    assert set(texts(inputs["decontamination"])) == {doc_id for doc_id, root in components.items() if doc_id == root}


def test_no_benchmark_item_is_left(spark, inputs):
    items = [row["text"] for row in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before, after = texts(inputs["decontamination"]), texts(inputs["packing"])
    holders = {doc_id for doc_id, text in before.items() if any(item in text for item in items)}
    assert holders and not holders & set(after)
    assert len(after) >= len(before) - len(holders) - 2  # parts of items, at most


def test_everything_left_is_packed(inputs):
    check_batches(inputs["packing"], inputs["end"].collect())


def test_run_gives_the_rows_of_its_stages(spark, inputs):
    assert sorted(corpus_pipeline.run(spark, FOLDER).collect()) == sorted(inputs["end"].collect())


def test_a_hot_passage_and_a_hot_group(spark, make_docs, tmp_path):
    """A third of all documents copies of one, another third with one passage of over 50 words."""
    import random

    rng = random.Random(9)
    passage, copy = prose(rng, 60), prose(rng, 90)
    rows = [copy] * 60 + [f"{prose(rng, 80)}\n{passage}" for _ in range(60)] + [prose(rng, 80) for _ in range(60)]
    docs = make_docs(*rows)
    spark.createDataFrame([(1, prose(rng, 30))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = settle(stage(spark, docs, str(tmp_path)), "stage")
    left = texts(docs)
    assert set(left) == {0, *range(60, 180)}
    assert [doc_id for doc_id, text in left.items() if passage in text] == [60]
