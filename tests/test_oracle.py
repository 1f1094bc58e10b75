"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from feedloom.plans.queries import QUERIES


def views(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        source = f"{file}/*.parquet" if file.is_dir() else str(file)
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{source}')")
    return connection


@pytest.fixture(scope="module")
def skewed_dir(spark, sf_dir, tmp_path_factory):
    """The same tables with a third of the rows on one user, type, month, brand, segment or conversation."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    hot = {
        "events": ("event_id", {"user_id": F.lit(7), "event_type": F.lit("error")}),
        "orders": ("o_orderkey", {"o_orderdate": F.lit("1997-01-15 00:00:00").cast("timestamp_ntz")}),
        "lineitem": ("l_orderkey", {"l_orderkey": F.lit(1)}),
        "part": ("p_partkey", {"p_brand": F.lit("Brand#1")}),
        "customer": ("c_custkey", {"c_mktsegment": F.lit("BUILDING")}),
        "conversations": ("turn", {"conv_id": F.lit(0)}),
        "pages": ("page_id", {"url": F.lit("http://hot.example.com/")}),
    }
    for name, (key, columns) in hot.items():
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        third = F.pmod(key, F.lit(3)) == 0
        changed = {c: F.when(third, v.cast(table.schema[c].dataType)).otherwise(F.col(c)) for c, v in columns.items()}
        table.withColumns(changed).repartition(4).write.parquet(f"{folder}/{name}.parquet")
    return folder


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    order = frame.astype(str).sort_values(list(frame.columns)).index
    return frame.loc[order].reset_index(drop=True)


def check(spark, name, sf_dir):
    got = canonical(queries()[name](spark, sf_dir).toPandas())
    want = canonical(views(sf_dir).execute(oracle_sql()[name]).df())
    assert len(got) > 0
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, name):
    check(spark, name, sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql_on_skewed_tables(spark, skewed_dir, name):
    check(spark, name, skewed_dir)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
