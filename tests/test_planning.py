"""Snapshots as of a run, and the pages that are still to be requested."""

from __future__ import annotations

import random

import pytest

from feedloom.operators.paging import snapshots_as_of
from feedloom.sources import missing_pages


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_the_newest_snapshot_that_is_not_newer(spark, limit):
    rng = random.Random(41)
    rows = [(feed, taken, f"{feed}{taken}-{part}") for feed in "abcdef" for taken in rng.sample(range(20), 4) for part in range(2)]
    rows += [("hot", taken, f"hot{taken}") for taken in range(3000)] + [("a", None, "untimed")]
    snapshots = spark.createDataFrame([(f, 0, 200, b, t) for f, t, b in rows], "feed string, skip bigint, status int, body string, taken bigint")
    runs = {"a": 10, "b": 0, "c": 19, "d": None, "hot": 1234, "gone": 5}
    feeds = spark.createDataFrame(list(runs.items()), "feed string, last_run bigint")
    want = []
    for feed, run in runs.items():
        times = [t for f, t, _ in rows if f == feed and t is not None and (run is None or t <= run)]
        want += [body for f, t, body in rows if times and f == feed and t == max(times)]
    got = snapshots_as_of(snapshots, feeds, broadcast_bytes=limit)
    assert sorted(row["body"] for row in got.collect()) == sorted(want)


@pytest.mark.parametrize("block", [1, 4, 1000])
def test_missing_pages_of_random_landings(spark, block):
    rng = random.Random(block)
    pages = {"a": 23, "b": 1, "none": 7, "whole": 9, "empty": 0, "long": 2500}
    there = {feed: {page for page in range(n) if rng.random() < 0.6} for feed, n in pages.items()}
    there["none"], there["whole"] = set(), set(range(9))
    rows = [(feed, page * 500) for feed, found in there.items() for page in found for _ in range(rng.randint(1, 2))]
    rows += [("a", 250), ("a", -500), ("a", None), ("a", 500 * 100), ("other", 0), (None, 0)]
    rng.shuffle(rows)
    landed = spark.createDataFrame(rows, "feed string, skip bigint")
    feeds = spark.createDataFrame(list(pages.items()), "feed string, pages bigint")
    want = set()
    for feed, n in pages.items():
        low = None
        for page in range(n + 1):
            missing = page < n and page not in there[feed]
            if missing and low is None:
                low = page
            if not missing and low is not None:
                want.add((feed, low * 500, page - low))
                low = None
    got = missing_pages(landed, feeds, 500, block)
    assert {tuple(row) for row in got.collect()} == want and got.count() == len(want)
