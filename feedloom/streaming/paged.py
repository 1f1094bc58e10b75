"""Scheduled loads of paged feeds that read what has newly landed, not all that ever did."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.envelope import classify
from feedloom.operators.lookup import lookup_join
from feedloom.operators.paging import best_landings, merged_landings, resolve_pages, with_runs
from feedloom.sinks.loads import append_once, ledger, read_loads
from feedloom.sinks.versioned import publish_version, versions
from feedloom.sources.landed import LANDED


@dataclass(frozen=True)
class Loaded:
    """What a call did: the version it published, if any, the rows it read as new, and the files it read bodies of."""

    version: int | None
    new_rows: int
    files: tuple[str, ...] = ()


def remember_outcomes(spark: SparkSession, landing: str, state: str, schema: str, max_files_per_batch: int) -> int:
    """Add the outcomes of the pages that newly landed to the state; the rows that were read.

    state/pages has a row per feed, run, page and file: what became of the page, without its
    body. Each landed file is read once for it, and its outcomes are added once, also when a
    call is repeated or dies half way.
    """

    def remember(batch: DataFrame, number: int) -> None:
        judged = with_runs(classify(batch)).select("feed", "run", "attempt", "skip", "outcome", "reason", "file")
        append_once(best_landings(judged, "file"), f"{state}/pages", str(number))

    landed = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_batch).parquet(landing)
    query = (
        landed.withColumn("file", F.col("_metadata.file_path"))
        .writeStream.foreachBatch(remember)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(progress["numInputRows"] for progress in query.recentProgress)


def load_paged(
    spark: SparkSession,
    landing: str,
    target: str,
    state: str,
    transform: Callable[[DataFrame], DataFrame],
    schema: str = LANDED,
    on_failure: str = "raise",
    fallback: DataFrame | None = None,
    expected: DataFrame | None = None,
    max_files_per_batch: int = 10_000,
) -> Loaded:
    """Replace the target by the rows of each feed's latest whole run, if anything landed since the last time.

    Gives the rows that `resolve_batches` would give over all that ever landed, and takes its
    policies; `transform` makes rows of the responses. But a call reads the bodies of new files
    only, to learn their pages' outcomes, and then of the files that hold the chosen runs: a
    run that landed since the last call costs its own files, however long the history is, and
    a feed whose latest whole run is an older one costs that run's files. What a call reads of
    the past are outcomes: a narrow row per page and file.

    The target is a table of versions (`read_version`). Where a feed has no whole run and the
    policy is "raise", the target stays as it was, the outcomes are kept, and the next call
    resolves again with what has landed by then. `state` holds the outcomes and the stream's
    checkpoint, which belong together; nothing else may write there.
    """
    new_rows = remember_outcomes(spark, landing, state, schema, max_files_per_batch)
    last = ledger(spark, f"{state}/pages").agg(F.max(F.col("load_id").cast("bigint")).alias("last")).first()["last"]
    if last is None:
        return Loaded(None, new_rows)
    note = f"outcomes {last}"
    published = versions(spark, target).orderBy(F.desc("number")).first()
    if published is not None and published["note"] == note:
        return Loaded(None, new_rows)
    known = read_loads(spark, f"{state}/pages")
    files: list[str] = []

    def landed_of(whole: DataFrame) -> DataFrame:
        in_scan = (F.col("run") == F.col("use_run")) & (F.col("skip") < F.col("end"))
        held = lookup_join(known, whole, "feed", "left_semi", in_scan, F.col("skip"))
        # One row a file that is read next; a reader lists its files on the driver as well.
        files.extend(sorted(row["file"] for row in held.select("file").distinct().collect()))
        reader = spark.read.schema(schema)
        return reader.parquet(*map(unquote, files)) if files else spark.createDataFrame([], reader.parquet(landing).schema)

    pages = resolve_pages(merged_landings(known), landed_of, on_failure, fallback, expected)
    number = publish_version(transform(pages), target, note)
    return Loaded(number, new_rows, tuple(files))
