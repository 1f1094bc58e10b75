"""Where intermediate tables go, how they are written there, and how the package reaches the executors."""

from __future__ import annotations

import functools
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


@functools.cache
def _local_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="feedloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can see: the session's spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


def new_path(spark: SparkSession, name: str) -> str:
    """A path nothing has written to yet, so that a re-run never meets old files."""
    path = f"{shared_folder(spark)}/feedloom/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def mark() -> int:
    """How much this driver has settled so far, for a later `clear` of what came after."""
    return len(_made)


def clear(spark: SparkSession, since: int = 0, but_last: bool = False) -> None:
    """Delete what this driver has settled, since a `mark` if given, once no result that reads it is needed any more.

    `but_last` keeps the last table: what came of those before it.
    """
    kept = _made[-1:] if but_last and len(_made) > since else []
    gone = _made[since : len(_made) - len(kept)]
    _made[since:] = kept
    for name in reversed(gone):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, wherever the driver found it."""
    if spark.sparkContext.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    packed = Path(tempfile.mkdtemp(prefix="feedloom-")) / "feedloom.zip"
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(packed))
    _shipped.add(spark.sparkContext.applicationId)
