from __future__ import annotations

import duckdb
import pandas as pd
import pytest
from pathlib import Path

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PAGES = "page_id bigint, url string, html string"


@pytest.fixture(scope="session")
def small_dir(sf_dir):
    return sf_dir


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture
def make_docs(spark):
    """Documents from texts, or from (doc_id, text) or (doc_id, text, source) tuples."""

    def make(*rows):
        full = []
        for at, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (at, row)
            full.append((row[0], row[1], "en", row[2] if len(row) > 2 else "s", None))
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def sql():
    """DuckDB over the tables of a folder."""

    def query(sf_dir: str, text: str) -> pd.DataFrame:
        connection = duckdb.connect()
        for file in Path(sf_dir).glob("*.parquet"):
            source = f"{file}/*.parquet" if file.is_dir() else str(file)
            connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{source}')")
        return connection.execute(text).df()

    return query
