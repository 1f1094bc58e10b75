"""Tables that loads are added to, each exactly once.

    path/data/<attempt>/   a load's rows as one attempt wrote them
    path/loads/<id>.json   the ledger: which attempt of a load counts

A load is added by its ledger entry alone. An attempt that failed before it has none, so
its rows are never read, and a load whose id is in the ledger adds nothing again.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from feedloom.sinks.commits import children, put_once, records, remove
from feedloom.sinks.reconcile import measures, measuring

ENTRY = "load_id string, attempt string, n_rows bigint, schema string, added_at double"
#: The types that hold every value of a type, nearest first; text holds all.
WIDER = {
    ByteType: (ShortType, IntegerType, LongType, FloatType, DoubleType),
    ShortType: (IntegerType, LongType, FloatType, DoubleType),
    IntegerType: (LongType, DoubleType),
    FloatType: (DoubleType,),
}


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per load of the table: load_id, attempt, n_rows, schema, added_at (seconds)."""
    return records(spark, f"{path}/loads", ENTRY)


def append_once(df: DataFrame, path: str, load_id: str, measured: tuple[str, ...] = ()) -> bool:
    """Add the rows of the load `load_id` to the table at `path`; whether this call added them.

    Run again, after success or a failure at any point, it gives the rows once: a load the
    ledger has is not even computed, and of two attempts at the same time one counts. The
    load keeps its own types, none (void) where it has no value; `read_loads` brings those of all loads together. Rows are
    written as they come, so give a frame whose partitions are of a size for files. Columns to
    be `measured` are sketched by the same pass (`sinks/reconcile.py`).
    """
    spark = df.sparkSession
    entry = f"{path}/loads/{quote(load_id, safe='')}.json"
    if not ledger(spark, path).where(F.col("load_id") == load_id).isEmpty():
        return False
    attempt = uuid.uuid4().hex
    seen = Observation()
    sketched = [column.alias(name) for name, column in measuring(df.schema, measured).items()]
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *sketched)
    held = _held(df.schema)
    own = [F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("boolean").alias(name) for name in held.names]
    counted.select(*own).write.parquet(f"{path}/data/{attempt}")
    found = {
        "load_id": load_id,
        "attempt": attempt,
        "n_rows": seen.get["rows"],
        "schema": df.schema.json(),
        "added_at": time.time(),
        "measures": measures(df.schema, measured, seen.get),
    }
    added = put_once(spark, entry, found)
    if not added:
        remove(spark, f"{path}/data/{attempt}")
    return added


def _held(schema: StructType) -> StructType:
    """The columns of a load's files: those of a type, as one without it has no values; or a mark for each row."""
    typed = [field for field in schema.fields if not isinstance(field.dataType, NullType)]
    return StructType(typed or [StructField("_row", BooleanType())])


def wider(left: DataType, right: DataType) -> DataType:
    """The nearest type that holds all values of both unchanged."""
    if left == right or isinstance(right, NullType):
        return left
    if isinstance(left, NullType):
        return right
    for one, other in ((left, right), (right, left)):
        if type(other) in WIDER.get(type(one), ()):
            return other
    both = [kind for kind in WIDER.get(type(left), ()) if kind in WIDER.get(type(right), ())]
    return both[0]() if both else StringType()


def merged_schema(schemas: list[StructType]) -> StructType:
    """Every column of the schemas, in order of first sight, of the nearest type that holds all of its values."""
    found: dict[str, DataType] = {}
    for field in (field for schema in schemas for field in schema.fields):
        found[field.name] = wider(found[field.name], field.dataType) if field.name in found else field.dataType
    merged = StructType()
    for name, kind in found.items():
        merged = merged.add(name, StringType() if isinstance(kind, NullType) else kind)
    return merged


def read_loads(spark: SparkSession, path: str, *loads: str) -> DataFrame:
    """The rows of the table's loads, or of those named, with `load_id`.

    Types that changed from load to load are read through the nearest type that holds them
    all: an int column whose later loads are text is text, and absent columns are NULL. Files
    of loads with the same types are read as one scan; only the ledger reaches the driver.
    """
    entries = ledger(spark, path)
    if loads:
        entries = entries.where(F.col("load_id").isin(*loads))
    found = entries.orderBy("added_at", "load_id").collect()  # one row a load
    if not found:
        raise FileNotFoundError(f"no loads in {path}")
    schemas = {row["schema"]: StructType.fromJson(json.loads(row["schema"])) for row in found}
    merged = merged_schema(list(schemas.values()))
    if "load_id" in merged.names:
        raise ValueError("a load has a column load_id")
    ids = spark.createDataFrame([(row["attempt"], row["load_id"]) for row in found], "_attempt string, load_id string")
    parts = []
    for text, schema in schemas.items():
        folders = [f"{path}/data/{row['attempt']}" for row in found if row["schema"] == text]
        held = _held(schema)
        rows = spark.read.schema(held).parquet(*folders)
        attempt = F.element_at(F.split("_metadata.file_path", "/"), -2)
        own = [
            (F.col(f"`{f.name}`") if f.name in held.names else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in merged.fields
        ]
        parts.append(rows.select(*own, attempt.alias("_attempt")))
    rows = reduce(DataFrame.unionByName, parts)
    # The ledger has a row a load, and was just collected.
    return rows.join(F.broadcast(ids), "_attempt").drop("_attempt")


def remove_attempts(spark: SparkSession, path: str, older_than: float = 86_400.0) -> list[str]:
    """Remove attempts that no ledger entry names and that nothing was added to for `older_than` seconds."""
    named = {f"{path.rstrip('/')}/data/{row['attempt']}" for row in ledger(spark, path).select("attempt").collect()}
    before = (time.time() - older_than) * 1000
    gone = [at for at, changed in children(spark, f"{path.rstrip('/')}/data").items() if at not in named and changed <= before]
    for folder in gone:
        remove(spark, folder)
    return sorted(gone)
