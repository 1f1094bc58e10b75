"""Plans stay the ones wanted: what is scanned, shuffled, broadcast and run in Python."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from feedloom.operators import classify, lookup_join, project_documents, resolve_batches, type_audit
from feedloom.plans.feeds import INCIDENTS, arrivals, incidents, passenger_volume
from feedloom.plans.packing import archives, single_records
from feedloom.sources import LANDED, read_landed
from feedloom.workspace import new_path, settle


def plan(df):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain("formatted")
    return shown.getvalue()


def nodes(text, name):
    return len(re.findall(rf"^\(\d+\) {name}\b", text, re.MULTILINE))


@pytest.fixture(scope="module")
def landed(spark):
    path = new_path(spark, "landed")
    pages = [("f", 0, 200, '{"value":[{"Type":"a"}]}'), ("f", 500, 200, '{"value":[]}')]
    spark.createDataFrame(pages, LANDED).write.parquet(path)
    return read_landed(spark, path)


@pytest.mark.parametrize("load", [arrivals, incidents])
def test_single_documents_are_one_narrow_jvm_pass(landed, load):
    text = plan(load(landed))
    assert nodes(text, "Exchange") == 0 and "Python" not in text
    assert "ReadSchema: struct<feed:string,status:int,body:string>" in text


def test_one_parse_per_document(landed):
    """The second from_json sits in the branch for unreadable bodies only."""
    text = plan(project_documents(landed, INCIDENTS, strict=False))
    assert text.count("from_json(") == 2


def test_classification_parses_once(landed):
    assert plan(classify(landed).select("feed", "skip", "outcome")).count("from_json(") == 1


def test_classified_pages_are_read_without_their_bodies(spark, landed):
    pages = settle(classify(landed), "pages")
    assert "body" not in plan(pages.select("feed", "skip", "outcome", "reason"))


def test_beyond_the_limit_rows_are_merged_not_broadcast(spark):
    rows = settle(spark.range(1000).select(F.col("id").cast("string").alias("feed"), "id"), "rows")
    feeds = settle(rows.select("feed"), "feeds")
    for spread in (None, F.col("id")):
        text = plan(lookup_join(rows, feeds, "feed", spread=spread, broadcast_bytes=0))
        assert nodes(text, "SortMergeJoin") == 1
    assert nodes(plan(lookup_join(rows, feeds, "feed")), "BroadcastHashJoin") == 1


def test_bodies_are_not_shuffled_and_pages_past_the_end_not_parsed(landed):
    text = plan(project_documents(resolve_batches(landed), INCIDENTS, on_failure="raise", strict=False))
    assert nodes(text, "BroadcastHashJoin") == 1 and nodes(text, "Exchange") == 0
    sections = re.split(r"^\((\d+)\) ", text, flags=re.MULTILINE)[1:]
    steps = {int(at): step for at, step in zip(sections[::2], sections[1::2])}
    [join] = [at for at, step in steps.items() if step.startswith("BroadcastHashJoin")]
    assert join < min(at for at, step in steps.items() if "from_json(" in step)


def test_type_audit_shuffles_counts_only(landed):
    text = plan(type_audit(landed, INCIDENTS))
    assert "partial_count" in text and nodes(text, "Exchange") == 2


def test_archives_are_joined_without_shuffling_their_bytes(spark, landed):
    rows = spark.range(10).select(F.col("id").cast("string").alias("a"))
    zips = settle(archives(rows, F.lit("0.zip"), ["a"]), "zips")
    links = single_records(spark.range(1), F.lit("m"), F.lit('{"Link":"0.zip"}'))
    text = plan(passenger_volume(links, zips, "a string"))
    assert nodes(text, "Exchange") == 0 and nodes(text, "BroadcastHashJoin") == 2
    assert nodes(text, "MapInArrow") == 1
