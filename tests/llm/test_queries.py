"""Every registered query of the operators: its SQL, its schema, an input that is empty or odd."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedloom.llm.queries import ORACLES, QUERIES

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PAGES = "page_id bigint, url string, html string"
BENCHMARK = "item_id bigint, text string"
EMBEDDINGS = "vec_id bigint, embedding array<float>, label int"


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    order = frame.astype(str).sort_values(list(frame.columns)).index
    return frame.loc[order].reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, sql, name, size):
    folder = f"/root/testdata/{size}"
    got = canonical(QUERIES[name](spark, folder).toPandas())
    want = canonical(sql(folder, ORACLES[name]))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for table, schema in (
        ("documents", DOCUMENTS),
        ("pages", PAGES),
        ("benchmark", BENCHMARK),
        ("embeddings", EMBEDDINGS),
    ):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{table}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and clashing columns."""
    folder = str(tmp_path_factory.mktemp("odd"))
    long = " ".join(f"w{n % 5000}" for n in range(60_000))
    solid = "x" * 50_000
    docs = [
        (None, None, None, None, None),
        (None, "a text without an id, long enough to have shingles", "en", "s", 1),
        (1, None, "en", "s", 0),
        (2, "", "en", None, 0),
        (3, " \n\t ", None, "s", 3),
        (4, long, "en", "s", len(long)),
        (5, solid, "en", "s", len(solid)),
        (6, "one two three", "en", "s", 13),
        (6, "one two three", "en", "s", 13),
        (7, "one two three", "de", "s", 13),
        (8, "1234 éè 漢字 <|endoftext|> \U0001f600", "fr", "s", 9),
        (2**61, "one", "en", "s", 3),
        (-5, "one two", "en", "s", 7),
    ]
    clash = {name: F.lit(f"clash-{name}") for name in ("row", "text_hash", "hash", "slot", "shard", "n_tokens", "doc")}
    clash |= {name: F.lit(7) for name in ("kept", "size", "tokens", "lines", "host", "node", "found", "item_id", "page")}
    spark.createDataFrame(docs, DOCUMENTS).withColumns(clash).write.parquet(f"{folder}/documents.parquet")
    pages = [
        (None, None, None),
        (1, None, "<p>x"),
        (2, "http://a b\r\nc", ""),
        (3, "u", "<div>" * 2000 + "deep"),
        (3, "u", "<div>" * 2000 + "deep"),
        (None, "u", "<article><p>same</p></article>"),
        (4, "u", "<article><p>same</p></article>"),
        (5, "", "<article><p>" + "long " * 100_000),
        (6, "u", "<p title='never closed"),
    ]
    clash = {name: F.lit("clash") for name in ("payload", "digest", "record_type", "text", "response", "row")}
    spark.createDataFrame(pages, PAGES).withColumns(clash).write.parquet(f"{folder}/pages.parquet")
    items = [(None, None), (1, ""), (2, "too short"), (3, " ".join(f"Ask {n} of it" for n in range(4))), (3, None)]
    spark.createDataFrame(items, BENCHMARK).write.parquet(f"{folder}/benchmark.parquet")
    vectors = [(n % 7 or None, [float((n * at) % 5) for at in range(64)], None) for n in range(20)]
    spark.createDataFrame(vectors, EMBEDDINGS).write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pipeline", "op2_packing", "op7_decontamination"}))
def test_odd_rows_each_give_a_row(spark, odd_dir, name):
    table = {"op5_warc": "pages", "op10_html_extract": "pages", "op12_centroids": "embeddings"}.get(name, "documents")
    expected = spark.read.parquet(f"{odd_dir}/{table}.parquet").count()
    assert len(QUERIES[name](spark, odd_dir).collect()) == expected


@pytest.mark.parametrize("name", ["pipeline", "op2_packing", "op7_decontamination"])
def test_odd_rows_do_not_stop_a_query(spark, odd_dir, name):
    QUERIES[name](spark, odd_dir).collect()


def test_stages_keep_the_columns_of_documents(spark, odd_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, odd_dir).columns == docs.columns
