"""Checks, sinks, incremental loads and the workspace."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter
from pyspark.sql.types import StringType, StructType

from feedloom import workspace
from feedloom.operators import (
    classify,
    preview,
    project_documents,
    require_rows,
    require_settings,
    resolve_batches,
    row_counter,
)
from feedloom.plans.feeds import arrivals, stops
from feedloom.sinks import align, append_table, jdbc_options, month_replace, replace_table
from feedloom.sources import LANDED, RUNS, read_landed
from feedloom.streaming import load_available, replace_when_landed

SETTINGS = {"DB_USER": "u", "DB_PASSWORD": "p"}


def test_settings_are_checked_without_showing_them():
    assert require_settings({"A": "1", "B": "2"}, "A") == {"A": "1"}
    with pytest.raises(ValueError, match="missing settings: B, C") as error:
        require_settings({"A": "secret", "B": ""}, "A", "B", "C")
    assert "secret" not in str(error.value)


def test_empty_batch_is_an_error(spark):
    df = spark.range(3)
    assert require_rows(df) is df
    with pytest.raises(ValueError, match="no data for the month"):
        require_rows(df.where("id > 5"), "the month")


def test_rows_are_counted_on_the_way(spark, tmp_path):
    counted, seen = row_counter(spark.range(10), even=F.col("id") % 2 == 0)
    counted.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"rows": 10, "even": 5}


def test_empty_batches_are_counted_too(spark, tmp_path):
    counted, seen = row_counter(spark.range(10).where("id > 20"))
    counted.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"rows": 0}


def test_preview(spark):
    assert [r.id for r in preview(spark.range(100), 3, F.desc("id")).collect()] == [99, 98, 97]
    assert preview(spark.range(100)).count() == 10


@pytest.fixture
def saved(monkeypatch):
    """What the writer was asked to do, instead of a database."""
    calls = []
    real = {name: getattr(DataFrameWriter, name) for name in ("format", "options", "mode")}

    def spy(name):
        def call(self, *args, **kwargs):
            calls.append((name, args, kwargs))
            return real[name](self, *args, **kwargs)

        return call

    for name in real:
        monkeypatch.setattr(DataFrameWriter, name, spy(name))
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: calls.append(("save", self._df.columns, {})))
    return calls


def test_jdbc_replace_asks_for_an_overwrite(spark, saved):
    options = jdbc_options("jdbc:postgresql://db/x", "bus_stops", SETTINGS, stringtype="unspecified")
    replace_table(spark.range(3), options, connections=4)
    assert saved == [
        ("format", ("jdbc",), {}),
        ("options", (), options),
        ("mode", ("overwrite",), {}),
        ("save", ["id"], {}),
    ]
    assert options["dbtable"] == "bus_stops" and options["user"] == "u"


def test_jdbc_append_matches_columns_by_name(spark, saved):
    target = spark.createDataFrame([], "a bigint, b string").schema
    append_table(spark.createDataFrame([("x", 1)], "b string, a int"), {"url": "u"}, schema=target)
    assert saved[2:] == [("mode", ("append",), {}), ("save", ["a", "b"], {})]


def test_jdbc_needs_credentials():
    with pytest.raises(ValueError, match="DB_PASSWORD"):
        jdbc_options("jdbc:postgresql://db/x", "t", {"DB_USER": "u"})


def test_align_refuses_unknown_columns_and_fills_absent_ones(spark):
    schema = spark.createDataFrame([], "a bigint, b string").schema
    with pytest.raises(ValueError, match="c"):
        align(spark.createDataFrame([(1, 2)], "a int, c int"), schema)
    aligned = align(spark.createDataFrame([(1,)], "a int"), schema)
    assert aligned.schema.simpleString() == schema.simpleString() and tuple(aligned.first()) == (1, None)


def test_append_creates_the_table_and_then_adds_to_it(spark, tmp_path):
    target = {"path": str(tmp_path / "t")}
    rows = spark.createDataFrame([(1, "x")], "a bigint, b string")
    append_table(rows, target, fmt="parquet")
    append_table(spark.createDataFrame([("y", 2)], "b string, a int"), target, fmt="parquet", schema=rows.schema)
    assert sorted(map(tuple, spark.read.parquet(target["path"]).collect())) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        append_table(spark.range(1), target, fmt="parquet", schema=rows.schema)


def test_a_replace_that_fails_leaves_the_old_table(spark, tmp_path):
    target = {"path": str(tmp_path / "t")}
    replace_table(spark.range(3), target, fmt="parquet")
    with pytest.raises(PySparkException, match="oops"):
        replace_table(spark.range(5).select(F.raise_error(F.lit("oops")).cast("bigint").alias("id")), target, fmt="parquet")
    assert spark.read.parquet(target["path"]).count() == 3
    replace_table(spark.range(4), target, fmt="parquet")
    assert [p.name for p in tmp_path.iterdir() if "replaced" in p.name] == []
    assert spark.read.parquet(target["path"]).count() == 4


def test_append_refuses_values_the_table_cannot_hold(spark, tmp_path):
    target = {"path": str(tmp_path / "t")}
    append_table(spark.createDataFrame([(1, "x")], "a int, b string"), target, fmt="parquet")
    for value, kind in ((1.5, "double"), (2**40, "bigint"), ("z", "string")):
        with pytest.raises(PySparkException, match="column a: no int"):
            append_table(spark.createDataFrame([(value,)], f"a {kind}"), target, fmt="parquet")
    append_table(spark.createDataFrame([(2.0, 7)], "a double, b int"), target, fmt="parquet")
    assert sorted(map(tuple, spark.read.parquet(target["path"]).collect())) == [(1, "x"), (2, "7")]


def test_stops_are_replaced_only_by_a_whole_run(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / name) for name in ("landing", "target", "checkpoint"))

    def land(run, *pages):
        rows = [("s", skip, 200, body, run, 1) for skip, body in pages]
        spark.createDataFrame(rows, f"{LANDED}, {RUNS}").write.mode("append").parquet(landing)

    def load():
        replace_when_landed(spark, landing, target, checkpoint, stops, f"{LANDED}, {RUNS}")
        return [r.BusStopCode for r in spark.read.parquet(target).collect()]

    end = '{"value":[]}'
    land(1, (0, '{"value":[{"BusStopCode":"a"}]}'), (500, end))
    assert load() == ["a"]
    land(2, (0, '{"value":[{"BusStopCode":"b"}]}'))
    assert load() == ["a"]
    land(2, (500, end))
    assert load() == ["b"]
    assert load() == ["b"]


def test_replace_with_nothing_leaves_nothing(spark, tmp_path):
    target = {"path": str(tmp_path / "t")}
    replace_table(spark.range(3), target, fmt="parquet")
    replace_table(spark.range(3).where("id > 5"), target, fmt="parquet")
    assert spark.read.parquet(target["path"]).count() == 0


def test_month_replace_can_run_again(spark, tmp_path):
    path = str(tmp_path / "t")
    month_replace(spark.createDataFrame([(1, "202501"), (2, "202502")], "a int, ym string"), path)
    again = spark.createDataFrame([(3, "202502"), (4, "202503")], "a int, ym string")
    for _ in range(2):
        month_replace(again, path)
    got = spark.read.schema("a int, ym string").parquet(path)
    assert sorted(map(tuple, got.collect())) == [(1, "202501"), (3, "202502"), (4, "202503")]


def test_a_large_month_is_split_over_files(spark, tmp_path):
    path = tmp_path / "t"
    month = F.when(F.col("id") % 3 == 0, "202501").otherwise(F.concat(F.lit("2024"), F.lpad(F.col("id") % 12 + 1, 2, "0")))
    rows = spark.range(300_000).select(F.md5(F.col("id").cast("string")).alias("v"), month.alias("ym"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512KB")
    try:
        month_replace(rows, str(path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {folder.name: len(list(folder.glob("*.parquet"))) for folder in path.glob("ym=*")}
    assert files["ym=202501"] > 3
    assert spark.read.parquet(str(path)).count() == 300_000


def test_incremental_load_takes_each_file_once(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / name) for name in ("landing", "target", "checkpoint"))

    def run():
        load_available(spark, landing, target, checkpoint, lambda df: df.select("feed", "skip"), max_files_per_batch=1)
        return sorted(r.skip for r in spark.read.parquet(target).collect())

    def land(*skips):
        rows = [("f", skip, 200, "{}") for skip in skips]
        spark.createDataFrame(rows, LANDED).repartition(2).write.mode("append").parquet(landing)

    land(0, 1, 2)
    assert run() == [0, 1, 2]
    assert run() == [0, 1, 2]
    land(3, 4)
    assert run() == [0, 1, 2, 3, 4]


def test_arrivals_load_incrementally(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / name) for name in ("landing", "target", "checkpoint"))
    body = '{"Services":[{"ServiceNo":"7","NextBus":{"Load":"x"},"NextBus2":{}}]}'
    for stops in (["83"], ["84", "85"]):
        spark.createDataFrame([(s, 0, 200, body) for s in stops], LANDED).write.mode("append").parquet(landing)
        load_available(spark, landing, target, checkpoint, arrivals)
    assert sorted(r.BusStopCode for r in spark.read.parquet(target).collect()) == ["83", "84", "85"]


def test_pages_classified_as_they_land(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / name) for name in ("landing", "target", "checkpoint"))
    pages = [("s", 0, '{"value":[{"id":"a"}]}'), ("s", 500, '{"value":[]}'), ("s", 1000, '{"value":[{"id":"late"}]}')]
    for feed, skip, body in pages:
        spark.createDataFrame([(feed, skip, 200, body)], LANDED).write.mode("append").parquet(landing)
        load_available(spark, landing, target, checkpoint, classify)
    landed = read_landed(spark, target, classified=True)
    assert sorted(r.outcome for r in landed.collect()) == ["data", "data", "empty"]
    kept = project_documents(resolve_batches(landed), StructType().add("id", StringType()), on_failure="raise")
    assert [r.id for r in kept.collect()] == ["a"]


class Conf:
    def __init__(self, **values):
        self.conf = self
        self.values = {key.replace("_", "."): value for key, value in values.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_work_goes_to_the_folder_the_session_names():
    assert workspace.shared_folder(Conf(spark_checkpoint_dir="hdfs://n/c/", spark_master="yarn")) == "hdfs://n/c"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Conf(spark_master="yarn"))
    assert workspace.shared_folder(Conf(spark_master="local[2]")).startswith("file:///")


def test_settled_tables_keep_schema_and_never_collide(spark):
    df = spark.createDataFrame([(1, ["a"], None)], "a int, b array<string>, c double")
    assert [tuple(r) for r in workspace.settle(df, "t").collect()] == [(1, ["a"], None)]
    assert workspace.new_path(spark, "t") != workspace.new_path(spark, "t")


def test_settled_tables_go_but_the_last(spark):
    before = workspace.mark()
    frames = [workspace.settle(spark.range(n), "t") for n in (1, 2, 3)]
    begun = before + 1
    workspace.clear(spark, begun, but_last=True)
    assert frames[0].count() == 1 and frames[2].count() == 3 and workspace.mark() == before + 2
    with pytest.raises(Exception, match="does not exist"):
        frames[1].collect()
    workspace.clear(spark, before)
    assert workspace.mark() == before
    workspace.clear(spark, workspace.mark(), but_last=True)
    assert workspace.mark() == before
