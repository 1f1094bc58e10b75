"""Loads that are added once, and versions of a table."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, ShortType, StringType

from feedloom.sinks import (
    append_once,
    commits,
    ledger,
    publish_version,
    read_loads,
    read_version,
    remove_attempts,
    remove_versions,
    versions,
)
from feedloom.sinks.loads import wider


def ids(df):
    return sorted(row["id"] for row in df.collect())


def failing(spark, rows=10):
    return spark.range(rows).withColumn("id", F.when(F.col("id") == rows - 1, F.raise_error(F.lit("oops"))).otherwise(F.col("id")))


def test_a_load_is_added_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert append_once(spark.range(5), path, "2025-07")
    assert not append_once(spark.range(5), path, "2025-07")
    assert append_once(spark.range(5, 8), path, "volume?Date=2025/08 x")
    assert ids(read_loads(spark, path)) == list(range(8))
    assert ids(read_loads(spark, path, "2025-07")) == list(range(5))
    found = {row["load_id"]: row["n_rows"] for row in ledger(spark, path).collect()}
    assert found == {"2025-07": 5, "volume?Date=2025/08 x": 3}


def test_a_load_that_failed_half_way_is_added_by_its_next_run(spark, tmp_path):
    path = str(tmp_path / "t")
    append_once(spark.range(3), path, "a")
    with pytest.raises(PySparkException, match="oops"):
        append_once(failing(spark), path, "b")
    assert ids(read_loads(spark, path)) == [0, 1, 2]
    assert append_once(spark.range(10, 12), path, "b")
    assert ids(read_loads(spark, path)) == [0, 1, 2, 10, 11]


def test_a_load_that_died_before_its_entry_leaves_no_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")

    def died(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr("feedloom.sinks.loads.put_once", died)
    with pytest.raises(KeyboardInterrupt):
        append_once(spark.range(3), path, "a")
    monkeypatch.undo()
    with pytest.raises(FileNotFoundError):
        read_loads(spark, path)
    assert append_once(spark.range(3), path, "a")
    assert ids(read_loads(spark, path)) == [0, 1, 2]
    assert remove_attempts(spark, path) == []
    assert len(remove_attempts(spark, path, older_than=0)) == 1
    assert ids(read_loads(spark, path)) == [0, 1, 2]


def test_of_two_attempts_at_once_one_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    inner = []

    def slow(batch):
        # While the first attempt still writes, another one is done.
        inner.append(append_once(spark.range(100, 102), path, "a"))
        return batch

    class Between:
        sparkSession, schema, columns = spark, spark.range(1).schema, ["id"]

        def observe(self, *args):
            return slow(spark.range(5)).observe(*args)

    assert not append_once(Between(), path, "a") and inner == [True]
    assert ids(read_loads(spark, path)) == [100, 101]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1


def test_types_may_change_from_load_to_load(spark, tmp_path):
    path = str(tmp_path / "t")
    append_once(spark.createDataFrame([(1012, 5)], "stop int, n int"), path, "1")
    append_once(spark.createDataFrame([("01012", 2**40, "x")], "stop string, n bigint, note string"), path, "2")
    append_once(spark.createDataFrame([(7,)], "n smallint"), path, "3")
    rows = read_loads(spark, path)
    assert rows.drop("load_id").schema.simpleString() == "struct<stop:string,n:bigint,note:string>"
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [("1012", 5, None, "1"), ("01012", 2**40, "x", "2"), (None, 7, None, "3")], key=str
    )


def test_columns_without_values_take_the_type_of_other_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    append_once(spark.sql("SELECT 1 AS a, NULL AS b, NULL AS c"), path, "1")
    append_once(spark.sql("SELECT NULL AS a, 2 AS b, NULL AS c"), path, "2")
    append_once(spark.sql("SELECT NULL AS a, NULL AS b"), path, "3")
    rows = read_loads(spark, path)
    assert rows.schema.simpleString() == "struct<a:int,b:int,c:string,load_id:string>"
    assert sorted(map(tuple, rows.collect()), key=str) == [
        (1, None, None, "1"),
        (None, 2, None, "2"),
        (None, None, None, "3"),
    ]


def test_wider_types_hold_all_values():
    assert wider(ShortType(), LongType()) == LongType()
    assert wider(IntegerType(), DoubleType()) == DoubleType()
    assert wider(LongType(), DoubleType()) == StringType()
    assert wider(IntegerType(), StringType()) == StringType()


def test_a_pruned_read_opens_only_the_loads_it_names(spark, tmp_path):
    path = str(tmp_path / "t")
    for name in "abc":
        append_once(spark.range(3), path, name)
    [attempt] = [row["attempt"] for row in ledger(spark, path).where("load_id = 'b'").collect()]
    assert all(f"/{attempt}/" in file for file in read_loads(spark, path, "b").inputFiles())


def test_versions_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_version(spark, path)
    assert publish_version(spark.range(3), path) == 1
    before = read_version(spark, path)
    assert publish_version(spark.range(5).withColumn("more", F.lit("x")), path) == 2
    assert ids(before) == [0, 1, 2]
    assert ids(read_version(spark, path)) == list(range(5)) and read_version(spark, path).columns == ["id", "more"]
    assert ids(read_version(spark, path, 1)) == [0, 1, 2]
    assert [row["n_rows"] for row in versions(spark, path).orderBy("number").collect()] == [3, 5]


def test_a_publish_that_fails_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_version(spark.range(3), path)
    with pytest.raises(PySparkException, match="oops"):
        publish_version(failing(spark), path)
    assert ids(read_version(spark, path)) == [0, 1, 2]
    assert publish_version(spark.range(4), path) == 2


def test_a_reader_between_any_two_steps_sees_a_whole_table(spark, tmp_path, monkeypatch):
    """After every call into the file system's commit the table is the old or the new one, and no folder moved."""
    path = str(tmp_path / "t")
    publish_version(spark.range(3), path)
    seen = []
    real = commits.put_once

    def watched(*args):
        seen.append(ids(read_version(spark, path)))
        done = real(*args)
        seen.append(ids(read_version(spark, path)))
        return done

    monkeypatch.setattr("feedloom.sinks.versioned.put_once", watched)
    folders = set((tmp_path / "t" / "data").iterdir())
    publish_version(spark.range(10, 12), path)
    assert seen == [[0, 1, 2], [10, 11]]
    assert folders < set((tmp_path / "t" / "data").iterdir())


def test_publishing_at_once_keeps_both_in_order(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    real, inner = commits.put_once, []

    def late(*args):
        if not inner:
            inner.append(None)
            inner[0] = publish_version(spark.range(2), path)
        return real(*args)

    monkeypatch.setattr("feedloom.sinks.versioned.put_once", late)
    assert publish_version(spark.range(7), path) == 2 and inner == [1]
    assert len(ids(read_version(spark, path))) == 7


def test_old_versions_go_when_nobody_can_be_reading_them(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in (1, 2, 3):
        publish_version(spark.range(rows), path)
    with pytest.raises(PySparkException):
        publish_version(failing(spark), path)
    assert remove_versions(spark, path, keep=1) == []
    assert len(remove_versions(spark, path, keep=2, older_than=0)) == 2
    assert len(ids(read_version(spark, path))) == 3 and len(ids(read_version(spark, path, 2))) == 2
    with pytest.raises(ValueError):
        remove_versions(spark, path, keep=0)
