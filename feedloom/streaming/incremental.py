"""Scheduled loads as an incremental stream over the landing folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom.sinks.tables import replace_table
from feedloom.sources.landed import LANDED


def load_available(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    schema: str = LANDED,
    max_files_per_batch: int = 10_000,
) -> None:
    """Load the landed files no earlier run has loaded, then stop.

    Each file reaches the target exactly once, also when a run is repeated or dies
    half way, as long as `checkpoint` and `target` stay together.
    """
    (
        transform(
            spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", max_files_per_batch)
            .parquet(landing)
        )
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def replace_when_landed(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    schema: str = LANDED,
) -> None:
    """Replace the target table from all that has landed, if anything has since the last time.

    For loads that need whole runs, such as stops: `transform` resolves the landed rows
    and stops where no run is whole. The target then stays as it was, and the next call
    tries again with what has landed by then.
    """

    def replace(_: DataFrame, batch: int) -> None:
        rows = transform(spark.read.schema(schema).parquet(landing))
        replace_table(rows, {"path": target}, fmt="parquet")

    (
        spark.readStream.schema(schema)
        .parquet(landing)
        .writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
