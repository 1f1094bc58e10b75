"""Small committed files beside a table: which of the folders under it count."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def put_once(spark: SparkSession, path: str, record: dict) -> bool:
    """Put a JSON file in its place in one step, if none is there; whether this call did.

    It is written under another name first, so nobody sees half of it and a run that dies
    leaves nothing in the place. Only this small file is ever renamed.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    target = fs.makeQualified(target)
    written = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(written, False)
    out.write(json.dumps(record).encode())
    out.close()
    # No option: an existing file stays.
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(written, target, options)
    except Py4JJavaError as error:
        fs.delete(written, False)
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def records(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The committed records of a folder, none where there is no folder yet."""
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folder)


def exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def remove(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def children(spark: SparkSession, folder: str) -> dict[str, int]:
    """The folder's entries by path, with the time each was changed (milliseconds)."""
    if not exists(spark, folder):
        return {}
    found = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = found.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(found)
    return {f"{folder.rstrip('/')}/{one.getPath().getName()}": one.getModificationTime() for one in listed}
