"""Test tables packed into the landed shape, so that queries start from documents.

Every document covers a fixed span of a unique id, so its size is bounded however
the other columns are skewed.
"""

from __future__ import annotations

import io
import itertools
import uuid
import zipfile
from collections.abc import Callable, Iterator
from operator import itemgetter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.plans.feeds import SLOT_FIELDS, SLOT_KEYS
from feedloom.sources.streams import opened
from feedloom.workspace import new_path, settle

PAGE_STEP = 500


#: Whether inputs packed for a folder are packed once and used again; the bench does, to time the operators alone.
KEEP = False
_kept: dict[tuple[str, str, str], DataFrame] = {}
_paths: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(spark: SparkSession, sf_dir: str, name: str, pack: Callable[[], DataFrame]) -> DataFrame:
    """What `pack` makes of the folder's tables, written as it would have landed."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if KEEP and key in _kept:
        return _kept[key]
    _kept[key] = settle(pack(), name)
    return _kept[key]


def landed_path(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The folder of files that `write` makes, as `landed`."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if not KEEP or key not in _paths:
        _paths[key] = new_path(spark, name)
        write(_paths[key])
    return _paths[key]


def div(column: Column | str, by: int) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.call_function("div", column, F.lit(by))


def arrival_responses(events: DataFrame) -> DataFrame:
    """One document per 30 events: ten services of three slots each, one slot per event.

    The event's value decides the slot's kind: {}, all blank, null, absent key, a null
    field, unknown keys only, or full. Documents with a value over 400 come with an
    error status, those with a value under 0.05 are cut short.
    """
    value = F.col("value")
    number = F.regexp_extract("props", r"\d+", 0)
    blank = ",".join(f'"{field}":""' for field in SLOT_FIELDS)
    full = F.concat(
        F.lit('{"OriginCode":"1","Monitored":1,"EstimatedArrival":"'),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit('+00:00","Latitude":"'),
        value.cast("string"),
        F.lit('","Longitude":"'),
        F.col("user_id").cast("string"),
        F.lit('","VisitNumber":'),
        number,
        F.lit(',"Load":"'),
        F.col("event_type"),
        F.lit('","Feature":"","Type":true}'),
    )
    slot = (
        F.when(value < 2, "{}")
        .when(value < 4, "{" + blank + ',"Monitored":0}')
        .when(value < 5, "null")
        .when(value < 6, None)
        .when(value < 7, '{"EstimatedArrival":null}')
        .when(value < 8, '{"Other":1}')
        .otherwise(full)
    )
    position = F.pmod("event_id", F.lit(3))
    keyed = F.element_at(F.array(*map(F.lit, SLOT_KEYS)), (position + 1).cast("int"))
    item = F.struct(
        div("event_id", 3).alias("number"),
        F.col("event_type").alias("operator"),
        F.concat(F.lit('"'), keyed, F.lit('":'), slot).alias("member"),
    )
    by_stop = events.withColumn("stop", div("event_id", 30)).repartition("stop")
    documents = by_stop.groupBy("stop").agg(
        F.collect_list(item).alias("items"), F.min("value").alias("low"), F.max("value").alias("high")
    )

    def service(number: Column) -> Column:
        own = F.filter("items", lambda item: item["number"] == number)
        return F.concat(
            F.lit('{"ServiceNo":"'),
            number.cast("string"),
            F.lit('","Operator":"'),
            F.array_min(own["operator"]),
            F.lit('"'),
            F.concat_ws("", F.transform(own["member"], lambda member: F.concat(F.lit(","), member))),
            F.lit("}"),
        )

    body = F.concat(
        F.format_string('{"metadata":"packed","BusStopCode":"%d","Services":[', "stop"),
        F.concat_ws(",", F.transform(F.array_distinct(F.col("items")["number"]), service)),
        F.lit("]}"),
    )
    documents = documents.select("stop", "low", "high", body.alias("whole"))
    return documents.select(
        F.format_string("%05d", "stop").alias("feed"),
        F.lit(0).cast("bigint").alias("skip"),
        F.when(F.col("high") > 400, 500).otherwise(200).alias("status"),
        F.when(F.col("low") < 0.05, F.expr("left(whole, length(whole) - 3)")).otherwise(F.col("whole")).alias("body"),
    )


def paged_responses(
    events: DataFrame,
    feed: Column,
    page: Column,
    kept: Column,
    error_above: float | None = None,
    broken_above: float | None = None,
    silent_below: float | None = None,
) -> DataFrame:
    """One response per (feed, page) with the kept events as its records, and an empty page after each feed's last.

    A page whose highest value is above `error_above` has an error status, one above
    `broken_above` is cut short, and one whose lowest is below `silent_below` got no answer.
    """
    record = F.struct("event_id", "event_type", "value")
    pages = (
        events.withColumns({"feed": feed, "skip": page * PAGE_STEP})
        .repartition("feed", "skip")
        .groupBy("feed", "skip")
        .agg(
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.collect_list(F.when(kept, record)).alias("value"),
        )
    )
    body = F.to_json(F.struct("value"))
    status = F.lit(200)
    if broken_above is not None:
        body = F.when(F.col("high") > broken_above, F.substring(body, F.lit(1), F.length(body) - 1)).otherwise(body)
    if error_above is not None:
        status = F.when(F.col("high") > error_above, 500).otherwise(status)
    if silent_below is not None:
        silent = F.col("low") < silent_below
        status, body = F.when(~silent, status), F.when(~silent, body)
    landed = pages.select("feed", "skip", status.alias("status"), body.alias("body"))
    return landed.unionByName(closing_pages(events.select(feed.alias("feed"), page.alias("page"))))


def closing_pages(placed: DataFrame) -> DataFrame:
    """An empty page after the last one of each feed of (feed, page)."""
    return (
        placed.groupBy("feed")
        .agg((F.max("page") + 1).alias("page"))
        .select(
            "feed",
            (F.col("page") * PAGE_STEP).cast("bigint").alias("skip"),
            F.lit(200).alias("status"),
            F.lit('{"value":[]}').alias("body"),
        )
    )


def stop_pages(customer: DataFrame, feed: Column, page: Column) -> DataFrame:
    """Pages of customers as stops; each feed gets an empty page after its last and a stray one after that."""
    record = F.struct(
        F.col("c_custkey").cast("string").alias("BusStopCode"),
        F.col("c_name").alias("RoadName"),
        F.col("c_mktsegment").alias("Description"),
        F.col("c_acctbal").alias("Latitude"),
        (F.col("c_nationkey") / 2).alias("Longitude"),
    )
    pages = (
        customer.withColumns({"feed": feed, "skip": page * PAGE_STEP})
        .repartition("feed", "skip")
        .groupBy("feed", "skip")
        .agg(F.min("c_acctbal").alias("low"), F.collect_list(record).alias("value"))
        .select(
            "feed",
            "skip",
            F.when(F.col("low") < -980, 503).otherwise(200).alias("status"),
            F.to_json(F.struct("value")).alias("body"),
        )
    )
    ends = closing_pages(customer.select(feed.alias("feed"), page.alias("page")))
    stray = ends.withColumn("skip", F.col("skip") + PAGE_STEP).withColumn(
        "body", F.lit('{"value":[{"BusStopCode":"stray"}]}')
    )
    return pages.unionByName(ends).unionByName(stray)


def single_records(df: DataFrame, feed: Column, record: Column) -> DataFrame:
    """One response per row, holding that row's one record; no shuffle."""
    return df.select(
        feed.alias("feed"),
        F.lit(0).cast("bigint").alias("skip"),
        F.lit(200).alias("status"),
        F.concat(F.lit('{"value":['), record, F.lit("]}")).alias("body"),
    )


def archives(df: DataFrame, path: Column, columns: list[str], line: Column | None = None) -> DataFrame:
    """One zip per path: a CSV of the path's rows first, or of the lines given instead, another member after it.

    Lines come to a task sorted by path and go into the zip as they come: the task holds one
    Arrow batch of them and one zip, however many paths it has and however long they are.
    """
    header = ",".join(columns)
    schema = pa.schema([("path", pa.string()), ("content", pa.binary())])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
        """(path, text) of the rows of a batch that have the same path."""
        for batch in batches:
            found = pc.run_end_encode(batch.column("path"))
            starts = pa.concat_arrays([pa.array([0], pa.int32()), found.run_ends])
            texts = pc.binary_join(pa.ListArray.from_arrays(starts, batch.column("text")), "")
            yield from zip(found.values.to_pylist(), texts.to_pylist())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, own in itertools.groupby(runs(batches), itemgetter(0)):
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                with archive.open("data.csv", "w", force_zip64=True) as member:
                    member.write(f"{header}\n".encode())
                    for _, text in own:
                        member.write(text.encode())
                archive.writestr("other.csv", "a,b\n1,2\n")
            arrays = [pa.array([path], pa.string()), pa.array([packed.getvalue()], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    line = F.to_csv(F.struct(*columns)) if line is None else line
    return (
        df.select(path.alias("path"), F.coalesce(F.concat(line, F.lit("\n")), F.lit("")).alias("text"))
        .repartition("path")
        .sortWithinPartitions("path")
        .mapInArrow(pack, "path string, content binary")
    )


def archive_files(archives: DataFrame, folder: str) -> None:
    """The archives (path, content) as files in the folder, each put in place once it is whole."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                fs, inner = opened(f"{folder}/{path}")
                parent, _, name = inner.rpartition("/")
                fs.create_dir(parent, recursive=True)
                begun = f"{parent}/_{name}-{uuid.uuid4().hex}"
                with fs.open_output_stream(begun, compression=None) as sink:
                    sink.write(content)
                fs.move(begun, inner)
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    archives.select("path", "content").mapInArrow(write, "n bigint").agg(F.sum("n")).collect()
