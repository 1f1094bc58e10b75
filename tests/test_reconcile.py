"""What loads held, against the loads before them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedloom.sinks import append_once, column_measures, ledger, load_verdicts, read_loads


@pytest.fixture
def loaded(spark, tmp_path):
    """Four loads: two alike, one of a tenth of the rows, one of other values and some NULLs."""
    path = str(tmp_path / "t")
    for at, (start, end) in enumerate([(0, 20_000), (10_000, 30_000), (0, 2_000), (500_000, 520_000)]):
        rows = spark.range(start, end, 1, 4).withColumn("name", F.concat(F.lit("n"), F.col("id") % 5_000))
        if at == 3:
            rows = rows.withColumn("id", F.when(F.col("id") % 4 != 0, F.col("id")))
        assert append_once(rows, path, f"load {at}", measured=("id", "name"))
    return path


def test_a_load_with_a_tenth_of_the_rows_is_thin(spark, loaded):
    found = [(r["load_id"], r["n_rows"], r["usual_rows"], r["verdict"]) for r in load_verdicts(spark, loaded).orderBy("load_id").collect()]
    assert found == [
        ("load 0", 20_000, None, "first"),
        ("load 1", 20_000, 20_000.0, "usual"),
        ("load 2", 2_000, 20_000.0, "thin"),
        ("load 3", 20_000, 20_000.0, "usual"),
    ]
    latest = load_verdicts(spark, loaded, history=1).where("load_id = 'load 3'").first()
    assert (latest["usual_rows"], latest["verdict"]) == (2_000.0, "thick")


def test_sketches_are_within_their_errors(spark, loaded):
    rows = read_loads(spark, loaded)
    for row in column_measures(spark, loaded).collect():
        own = rows.where(F.col("load_id") == row["load_id"])
        exact = own.agg(F.count_distinct(row["column"]).alias("n"), F.count_if(F.col(row["column"]).isNull()).alias("nulls")).first()
        assert abs(row["n_distinct"] - exact["n"]) <= 0.065 * exact["n"] and row["n_null"] == exact["nulls"]
        if row["column"] == "id":
            below = own.where("id IS NOT NULL").agg(F.avg((F.col("id") <= row["median"]).cast("int"))).first()[0]
            assert abs(below - 0.5) <= 0.04
        else:
            assert row["median"] is None and row["shifted"] is None


def test_loads_are_held_against_all_before_them(spark, loaded):
    found = {(r["load_id"], r["column"]): r for r in column_measures(spark, loaded).collect()}
    first, second, third, last = (found[f"load {n}", "id"] for n in range(4))
    assert (first["seen_before"], first["shifted"]) == (0, None)
    assert abs(second["fresh"] - 10_000) < 2_000 and third["fresh"] < 1_000
    assert abs(last["seen_before"] - 30_000) < 2_000 and abs(last["fresh"] - 15_000) < 3_000
    assert last["shifted"] and second["shifted"] and abs(second["usual_low"] - 5_000) < 800 and abs(second["usual_high"] - 15_000) < 800
    again = {(r["load_id"], r["column"]): r for r in column_measures(spark, loaded, shift=0.5).collect()}
    assert last["usual_high"] < 25_000 and not again["load 2", "id"]["shifted"]
    assert found["load 1", "name"]["fresh"] < 350


def test_loads_without_rows_values_or_measures(spark, tmp_path):
    path = str(tmp_path / "t")
    nothing = spark.createDataFrame([], "a double, `b.c` string, `column` int")
    append_once(nothing, path, "empty", measured=("a", "b.c", "column"))
    append_once(spark.createDataFrame([(None, "x", 1), (None, None, 1)], nothing.schema), path, "nulls", measured=("a", "b.c", "column"))
    append_once(nothing, path, "plain")
    append_once(spark.createDataFrame([(2.0, "x", 3)], nothing.schema), path, "full", measured=("a", "b.c", "column"))
    found = {(r["load_id"], r["column"]): r for r in column_measures(spark, path).collect()}
    assert len(found) == 9 and {key[0] for key in found} == {"empty", "nulls", "full"}
    assert [found["nulls", c]["n_null"] for c in ("a", "b.c", "column")] == [2, 1, 0]
    assert (found["nulls", "a"]["median"], found["full", "a"]["median"], found["full", "a"]["shifted"]) == (None, 2.0, None)
    assert (found["full", "column"]["usual_high"], found["full", "column"]["fresh"]) == (1.0, 1)
    assert found["full", "column"]["shifted"] and found["nulls", "column"]["shifted"] is None
    assert [r["verdict"] for r in load_verdicts(spark, path).orderBy("usual_rows").collect()].count("first") == 1
    assert load_verdicts(spark, str(tmp_path / "none")).isEmpty() and column_measures(spark, str(tmp_path / "none")).isEmpty()


def test_a_load_added_twice_is_measured_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert append_once(spark.range(10), path, "one", measured=("id",))
    assert not append_once(spark.range(99), path, "one", measured=("id",))
    assert ledger(spark, path).count() == 1
    row = column_measures(spark, path).first()
    assert (row["n_rows"], row["n_distinct"], row["n_null"]) == (10, 10, 0)
