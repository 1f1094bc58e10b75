"""Loads of paged feeds that remember outcomes."""

from __future__ import annotations

import json
import random

import pytest

from feedloom.operators import resolve_batches
from feedloom.sinks import ledger, read_version, versions
from feedloom.sources import LANDED, RUNS
from feedloom.streaming import load_paged

SCHEMA = f"{LANDED}, {RUNS}"


def body(*codes):
    return json.dumps({"value": [{"BusStopCode": str(code)} for code in codes]})


class Lake:
    def __init__(self, spark, path):
        self.spark = spark
        self.landing, self.target, self.state = (str(path / name) for name in ("landing", "target", "state"))

    def land(self, *pages):
        """(feed, skip, status, body, run, attempt) rows as one more file; returns its name."""
        before = set(self.files())
        self.spark.createDataFrame(pages, SCHEMA).coalesce(1).write.mode("append").parquet(self.landing)
        [new] = set(self.files()) - before
        return new

    def files(self):
        try:
            files = self.spark.read.schema(SCHEMA).parquet(self.landing).select("_metadata.file_path").distinct()
            return [row["file_path"] for row in files.collect()]
        except Exception:
            return []

    def run(self, feed, run, *pages, attempt=1):
        rows = [(feed, at * 500, 200, body(*codes), run, attempt) for at, codes in enumerate(pages)]
        return [*rows, (feed, len(pages) * 500, 200, body(), run, attempt)]

    def load(self, **options):
        def transform(pages):
            return stops_of(pages)

        return load_paged(self.spark, self.landing, self.target, self.state, transform, SCHEMA, **options)

    def rows(self):
        return sorted(row["BusStopCode"] for row in read_version(self.spark, self.target).collect())

    def scanned(self, **options):
        """The same rows by a scan of all that ever landed."""
        landed = self.spark.read.schema(SCHEMA).parquet(self.landing)
        return sorted(row["BusStopCode"] for row in stops_of(resolve_batches(landed, **options)).collect())


def stops_of(pages):
    from feedloom.operators import project_documents
    from feedloom.plans.feeds import STOPS

    return project_documents(pages, STOPS, on_failure="raise")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_the_third_call_reads_the_third_days_bodies_only(lake):
    days = []
    for day in (1, 2, 3):
        days.append(lake.land(*lake.run("a", day, [day, 10], [20]), *lake.run("b", day, [day + 100])))
        loaded = lake.load()
        assert loaded.version == day
        assert loaded.new_rows == 5
        assert loaded.files == (days[-1],)
        assert lake.rows() == lake.scanned() == sorted([str(day), "10", "20", str(day + 100)])
    again = lake.load()
    assert (again.version, again.new_rows, again.files) == (None, 0, ())


def test_a_run_that_lands_in_parts_is_read_from_its_own_files(lake):
    first = lake.run("a", 1, [1], [2])
    one = lake.land(*first[:2])
    with pytest.raises(RuntimeError, match="open_end"):
        lake.load()
    lake.land(first[2])  # the closing page, which has no rows
    assert lake.load().files == (one,) and lake.rows() == lake.scanned() == ["1", "2"]
    second = lake.run("a", 2, [3], [4])
    lake.land(second[0])
    assert lake.load().files == (one,) and lake.rows() == lake.scanned() == ["1", "2"]
    lake.land(second[2])
    assert lake.load().version == 3 and lake.rows() == lake.scanned() == ["1", "2"]
    lake.land(second[1])
    loaded = lake.load()
    assert len(loaded.files) == 2 and one not in loaded.files
    assert lake.rows() == lake.scanned() == ["3", "4"]


def test_a_later_attempt_may_undo_a_run(lake):
    lake.land(*lake.run("a", 1, [1]))
    lake.land(*lake.run("a", 2, [2]))
    lake.load()
    assert lake.rows() == ["2"]
    lake.land(("a", 0, 500, None, 2, 2))
    lake.load()
    assert lake.rows() == lake.scanned() == ["1"]
    lake.land(("a", 0, 200, body(5), 2, 3))
    lake.load()
    assert lake.rows() == lake.scanned() == ["5"]


def test_a_failed_feed_keeps_the_target_and_its_outcomes(lake):
    lake.land(*lake.run("a", 1, [1]))
    lake.load()
    lake.land(("b", 0, 500, None, 1, 1))
    with pytest.raises(RuntimeError, match="failed_page"):
        lake.load()
    with pytest.raises(RuntimeError, match="failed_page"):
        lake.load()
    assert lake.rows() == ["1"] and versions(lake.spark, lake.target).count() == 1
    assert ledger(lake.spark, f"{lake.state}/pages").count() == 2
    lake.land(*lake.run("b", 2, [2]))
    assert lake.load().version == 2 and lake.rows() == ["1", "2"]


def test_policies_and_expected_feeds(lake, spark):
    lake.land(*lake.run("a", 1, [1]), ("b", 0, 500, None, 1, 1))
    lake.load(on_failure="empty")
    assert lake.rows() == lake.scanned(on_failure="empty") == ["1"]
    snapshot = spark.createDataFrame([("b", 0, 200, body(7)), ("c", 0, 200, body(8))], LANDED)
    lake.land(*lake.run("a", 2, [2]))
    lake.load(on_failure="fallback", fallback=snapshot)
    assert lake.rows() == lake.scanned(on_failure="fallback", fallback=snapshot) == ["2", "7", "8"]
    lake.land(*lake.run("b", 3, [3]))
    with pytest.raises(RuntimeError, match="never_landed"):
        lake.load(expected=spark.createDataFrame([("zz",)], "feed string"))


def test_a_call_that_dies_after_its_outcomes_changes_nothing(lake, monkeypatch):
    """The stream sees its batch again, as it never learned that it was done; the outcomes are there once."""
    from feedloom.streaming import paged

    lake.land(*lake.run("a", 1, [1]))
    real = paged.append_once

    def die(*args):
        real(*args)
        raise OSError("died")

    monkeypatch.setattr(paged, "append_once", die)
    with pytest.raises(Exception, match="died"):
        lake.load()
    monkeypatch.undo()
    lake.land(*lake.run("a", 2, [2]))
    lake.load()
    assert lake.rows() == lake.scanned() == ["2"]
    assert sum(row["n_rows"] for row in ledger(lake.spark, f"{lake.state}/pages").collect()) == 4


def test_nothing_landed_and_nothing_chosen(lake, spark):
    spark.createDataFrame([], SCHEMA).write.parquet(lake.landing)
    assert lake.load().files == () and lake.rows() == []
    lake.land(("a", 0, 500, None, 1, 1))
    assert lake.load(on_failure="empty").files == () and lake.rows() == []


def test_random_landings_are_as_a_full_scan(lake):
    rng = random.Random(31)
    for _ in range(4):
        rows = []
        for _ in range(12):
            feed, run, attempt = rng.choice("ab"), rng.randint(1, 3), rng.randint(1, 3)
            pages = lake.run(feed, run, [f"{feed}{run}{attempt}x"], [f"{feed}{run}{attempt}y"], attempt=attempt)
            rows += rng.sample(pages, rng.randint(1, 3))
            if rng.random() < 0.2:
                rows.append((feed, rng.choice([0, 500]), 503, None, run, attempt))
        # One landing of a page and attempt, as equal ones are chosen by their text.
        lake.land(*{row[:2] + row[4:]: row for row in rows}.values())
        lake.load(on_failure="empty")
        assert lake.rows() == lake.scanned(on_failure="empty")


def test_classified_landings_are_not_parsed_for_their_outcome(spark, tmp_path):
    landing, target, state = (str(tmp_path / name) for name in ("landing", "target", "state"))
    schema = f"{SCHEMA}, outcome string, reason string"
    rows = [("a", 0, 200, body(1), 1, 1, "data", None), ("a", 500, 200, "not read", 1, 1, "empty", None)]
    spark.createDataFrame(rows, schema).write.parquet(landing)
    load_paged(spark, landing, target, state, stops_of, schema)
    assert [row["BusStopCode"] for row in read_version(spark, target).collect()] == ["1"]


def test_folders_with_odd_names(spark, tmp_path):
    lake = Lake(spark, tmp_path / "a b 1%20 é")
    lake.land(*lake.run("a", 1, [1]))
    lake.load()
    lake.land(*lake.run("a", 2, [2]))
    assert len(lake.load().files) == 1 and lake.rows() == ["2"]
