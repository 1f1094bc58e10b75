"""Tables that are replaced whole, version by version, while others read them.

    path/data/<name>/               a version's rows
    path/versions/<number>.json     the versions that were published, in order

A version counts once its small file is there; no folder is renamed and nothing a reader
has begun to read goes away, until old versions are removed.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedloom.operators.checks import row_counter
from feedloom.sinks.commits import children, put_once, records, remove

ENTRY = "number bigint, folder string, n_rows bigint, schema string, note string, published_at double"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """One row per published version: number, folder, n_rows, schema (DDL), note, published_at (seconds)."""
    return records(spark, f"{path}/versions", ENTRY)


def publish_version(df: DataFrame, path: str, note: str | None = None) -> int:
    """Write the whole table as a new version and publish it, with a note for its writers; the version's number.

    A run that fails leaves the version before it. Of two runs at the same time both are
    published, one after the other, and the later number is the table.
    """
    spark = df.sparkSession
    folder = uuid.uuid4().hex
    counted, seen = row_counter(df)
    counted.write.parquet(f"{path}/data/{folder}")
    while True:
        last = versions(spark, path).agg(F.max("number")).first()[0] or 0
        found = {
            "number": last + 1,
            "folder": folder,
            "n_rows": seen.get["rows"],
            "schema": df.schema.toDDL(),
            "note": note,
            "published_at": time.time(),
        }
        if put_once(spark, f"{path}/versions/{last + 1:012d}.json", found):
            return last + 1


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as its latest version has it, or as version `number` did, while that is kept.

    The version is settled when this is called: a later publish does not change the frame.
    """
    found = versions(spark, path)
    if number is not None:
        found = found.where(F.col("number") == number)
    entry = found.orderBy(F.desc("number")).first()
    if entry is None:
        raise FileNotFoundError(f"no version {number or ''} in {path}")
    return spark.read.schema(StructType.fromDDL(entry["schema"])).parquet(f"{path}/data/{entry['folder']}")


def remove_versions(spark: SparkSession, path: str, keep: int = 3, older_than: float = 86_400.0) -> list[str]:
    """Remove the rows of all but the last `keep` versions, and of writes that never became one.

    Neither goes before it is `older_than` seconds old, so that readers and writers under way
    can end. The published numbers stay known.
    """
    if keep < 1:
        raise ValueError("the latest version cannot be removed")
    rows = versions(spark, path).orderBy(F.desc("number")).collect()  # one row a version
    data = f"{path.rstrip('/')}/data"
    now = time.time()
    held = {f"{data}/{row['folder']}" for row in rows[:keep]}
    # A version was the table until the next one was published.
    held |= {f"{data}/{row['folder']}" for row, after in zip(rows[1:], rows) if after["published_at"] > now - older_than}
    found = children(spark, data)
    gone = [at for at, changed in found.items() if at not in held and changed <= (now - older_than) * 1000]
    for folder in gone:
        remove(spark, folder)
    return sorted(gone)
