"""Writing tables: replace, append, and the re-runnable replace of whole months."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructField, StructType

from feedloom.operators.checks import require_settings


def jdbc_options(
    url: str,
    table: str,
    settings: Mapping[str, str | None],
    driver: str = "org.postgresql.Driver",
    **options: str,
) -> dict[str, str]:
    """Options of a JDBC table; the credentials come from DB_USER and DB_PASSWORD.

    A replace drops and creates the table. With truncate="true" it keeps the table's
    own column types and grants, but then fails on a column the table does not have.
    """
    found = require_settings(settings, "DB_USER", "DB_PASSWORD")
    return {
        "url": url,
        "dbtable": table,
        "user": found["DB_USER"],
        "password": found["DB_PASSWORD"],
        "driver": driver,
        "batchsize": "10000",
        **options,
    }


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in the target's order and types, matched by name; an unknown one is an error.

    A value that the target's type cannot hold, also a number that would be rounded or
    cut, stops the write.
    """
    unknown = sorted(set(df.columns) - set(schema.names))
    if unknown:
        raise ValueError(f"columns not in the target: {unknown}")

    def fitted(field: StructField) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType)
        value, own = F.col(f"`{field.name}`"), df.schema[field.name].dataType
        if own == field.dataType:
            return value
        cast = value.try_cast(field.dataType)
        fits = cast.isNotNull()
        if isinstance(own, NumericType) and isinstance(field.dataType, NumericType):
            fits = fits & cast.try_cast(own).eqNullSafe(value)
        text = F.coalesce(value.cast("string"), F.lit(""))
        stop = F.raise_error(F.concat(F.lit(f"column {field.name}: no {field.dataType.simpleString()}: "), text))
        return F.when(value.isNull() | fits, cast).otherwise(stop)

    return df.select(*[fitted(field).alias(field.name) for field in schema.fields])


def _write(df: DataFrame, fmt: str, options: Mapping[str, str], mode: str, connections: int | None) -> None:
    # A shuffle into `connections` partitions keeps the stages before it parallel;
    # the JDBC writer's own numPartitions would coalesce them as well.
    if connections is not None:
        df = df.repartition(connections)
    df.write.format(fmt).options(**options).mode(mode).save()


def replace_table(
    df: DataFrame, options: Mapping[str, str], fmt: str = "jdbc", connections: int | None = None
) -> None:
    """Replace the whole table.

    Files are written to a new folder beside the target first, which takes the target's
    place by two renames when it is whole; a run that fails leaves the old table as it
    was. A JDBC replace is not atomic: a reader can see it half written, and a run that
    failed is put right by running it again.
    """
    if "path" not in options:
        _write(df, fmt, options, "overwrite", connections)
        return
    target = options["path"].rstrip("/")
    staged = f"{target}.staged-{uuid.uuid4().hex}"
    _write(df, fmt, {**options, "path": staged}, "errorifexists", connections)
    publish(df.sparkSession, staged, target)


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Put the staged folder in the target's place."""
    jvm = spark._jvm
    new, old, gone = (jvm.org.apache.hadoop.fs.Path(p) for p in (staged, target, f"{staged}-replaced"))
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    replaced = fs.exists(old)
    if replaced and not fs.rename(old, gone):
        raise OSError(f"cannot move {target} away")
    if not fs.rename(new, old):
        raise OSError(f"cannot publish {staged} as {target}")
    if replaced:
        fs.delete(gone, True)
    spark.catalog.refreshByPath(target)


def append_table(
    df: DataFrame,
    options: Mapping[str, str],
    fmt: str = "jdbc",
    connections: int | None = None,
    schema: StructType | None = None,
) -> None:
    """Add rows to the table, creating it if need be; columns are matched by name.

    A JDBC table refuses unknown columns by itself. Files do not, so give their
    `schema`, or the one an existing file table has is taken: absent columns are then
    NULL, unknown ones an error, and so is a value that does not fit. Running an append
    twice adds the rows twice; use `month_replace` where a run may be repeated.
    """
    if schema is None and "path" in options:
        schema = table_schema(df.sparkSession, options["path"], fmt)
    _write(df if schema is None else align(df, schema), fmt, options, "append", connections)


def table_schema(spark: SparkSession, path: str, fmt: str) -> StructType | None:
    """The schema of a file table; None where there is none yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.format(fmt).load(path).schema


def month_replace(df: DataFrame, path: str, partition: str = "ym", fmt: str = "parquet") -> None:
    """Replace the months present in `df`, leave all others; a re-run changes nothing.

    The rebalance writes few files per month and splits a month that is large.
    """
    (
        df.hint("rebalance", partition)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .save(path)
    )
