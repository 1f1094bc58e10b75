"""The four loads, each a plan from landed input to its table's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType, StructType

from feedloom.functions import base_name, month_key, request_key
from feedloom.operators.envelope import unnest
from feedloom.operators.lookup import BROADCAST_BYTES, lookup_join
from feedloom.operators.paging import resolve_batches
from feedloom.operators.project import project_documents
from feedloom.operators.slots import flatten_slots
from feedloom.sources.archives import first_member_lines, shared_header
from feedloom.sources.delimited import infer_lines, judge_lines, parse_lines
from feedloom.sources.landed import first_link
from feedloom.workspace import settle

# Field names of the feeds, in table order.
SLOT_KEYS = ("NextBus", "NextBus2", "NextBus3")
SLOT_FIELDS = ("EstimatedArrival", "Latitude", "Longitude", "VisitNumber", "Load", "Feature", "Type")
STOPS = (
    StructType()
    .add("BusStopCode", StringType())
    .add("RoadName", StringType())
    .add("Description", StringType())
    .add("Latitude", DoubleType())
    .add("Longitude", DoubleType())
)
INCIDENTS = (
    StructType()
    .add("Type", StringType())
    .add("Latitude", DoubleType())
    .add("Longitude", DoubleType())
    .add("Message", StringType())
)
SERVICE = StructType().add("ServiceNo", StringType()).add("Operator", StringType())
for _key in SLOT_KEYS:
    SERVICE = SERVICE.add(_key, MapType(StringType(), StringType()))


def arrivals(responses: DataFrame, on_failure: str = "raise", seen: Observation | None = None) -> DataFrame:
    """Arrival rows of all stops in one narrow pass; the stop code is the response's feed.

    A failed response stops the job, or with on_failure="empty" gives no rows and is
    counted by `seen`.
    """
    return flatten_slots(
        unnest(responses, SERVICE, "Services", on_failure, seen=seen),
        slots=[f"record.{key}" for key in SLOT_KEYS],
        fields=SLOT_FIELDS,
        label="BusInstance",
        label_prefix="NextBus",
        keep=[F.col("feed").alias("BusStopCode"), "record.ServiceNo", "record.Operator"],
    )


def stops(
    responses: DataFrame,
    fallback: DataFrame | None = None,
    strict: bool = True,
    expected: DataFrame | None = None,
) -> DataFrame:
    """Stop rows of paged collections, from the fallback documents where no run is whole."""
    pages = resolve_batches(responses, "raise" if fallback is None else "fallback", fallback, expected)
    return project_documents(pages, STOPS, on_failure="raise", strict=strict)


def incidents(
    responses: DataFrame, on_failure: str = "raise", strict: bool = True, seen: Observation | None = None
) -> DataFrame:
    """Incident rows of single documents; a failed one stops the job or is counted by `seen`."""
    return project_documents(responses, INCIDENTS, on_failure=on_failure, strict=strict, seen=seen)


def volume_requests(dates: DataFrame, date: str, template: str) -> DataFrame:
    """The distinct request keys for the load months of some run dates."""
    return dates.select(month_key(date).alias("ym")).distinct().withColumn("feed", request_key(template, "ym"))


def archive_links(link_responses: DataFrame, archives: DataFrame, by_name: bool = False) -> DataFrame:
    """(feed, path) of the archives that the link documents' first records name, settled.

    A link is an archive's path, or `by_name` ends in its file's name, whatever query
    follows. One without an archive, or with more than one, stops the job.
    """
    links = first_link(link_responses)
    own = F.col("path")
    if by_name:
        links = links.withColumn("path", base_name("path"))
        own = base_name("path")
    names = archives.select(own.alias("path"), F.col("path").alias("archive"))
    found = links.withColumnRenamed("path", "link").join(names, F.col("link") == F.col("path"), "left")
    found = settle(found.groupBy("feed", "link").agg(F.collect_set("archive").alias("archives")), "links")
    wrong = found.where(F.size("archives") != 1).head()
    if wrong is not None and not wrong["archives"]:
        raise FileNotFoundError(f"{wrong['feed']}: no archive {wrong['link']}")
    if wrong is not None:
        raise ValueError(f"{wrong['feed']}: {wrong['link']} may be any of {sorted(wrong['archives'])}")
    return found.select("feed", F.col("archives")[0].alias("path"))


def linked_archives(archives: DataFrame, links: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The archives (path, content) that some link names, each once however many name it.

    Within the measured limit their bytes are not shuffled.
    """
    paths = settle(links.select("path").distinct(), "linked-paths")
    return lookup_join(archives, paths, "path", "left_semi", broadcast_bytes=broadcast_bytes)


def linked_lines(
    archives: DataFrame,
    links: DataFrame,
    columns: list[str] | None,
    seen: Observation | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(feed, line) of each link's archive; an archive is opened once and its lines then joined to its links."""
    lines = first_member_lines(linked_archives(archives, links, broadcast_bytes), columns, "path", seen=seen)
    joined = lookup_join(
        lines, links, "path", spread=F.col("line"), measure="line", broadcast_bytes=broadcast_bytes
    )
    return joined.select("feed", "line")


def passenger_volume(
    link_responses: DataFrame,
    archives: DataFrame,
    schema: str | None = None,
    by_name: bool = False,
    feed: str = "feed",
    strict: bool = True,
    nothing: str = "string",
) -> DataFrame:
    """The feed, under the name `feed`, and the CSV columns of each link document's archive.

    `schema` is the DDL of the columns in header order; a line that does not fit it stops
    the job, or unless `strict` has NULLs. Without a schema the names come from the header
    and the types from what all cells of a column can be without a change (`infer_lines`),
    which reads the archives once and keeps their cells; a column without a cell is of the
    type `nothing`, and the feed stays as it is.
    """
    links = archive_links(link_responses, archives, by_name)

    def checked(names: list[str]) -> list[str]:
        if feed in names:
            raise ValueError(f"the archives have a column {feed}: give the feed another name")
        return names

    if schema is not None:
        names = checked(StructType.fromDDL(schema).names)
        return parse_lines(linked_lines(archives, links, names), schema, F.col("feed").alias(feed), strict=strict)
    spark, seen = links.sparkSession, Observation()
    lines = settle(linked_lines(archives, links, None, seen).withColumnRenamed("feed", feed), "lines")
    names = checked(shared_header(seen))
    return infer_lines(lines, names, feed, nothing=nothing)


def judged_volume(archives: DataFrame, schema: str) -> DataFrame:
    """(source, position, raw, reason) and the typed columns of every data line of the archives' first members.

    The position is the line's number in its member, the first line being 1. Lines that fit
    have no reason; `set_apart` writes both kinds in one pass.
    """
    names = StructType.fromDDL(schema).names
    lines = first_member_lines(archives, names, "path", number="position")
    place = [F.col("path").alias("source"), "position", F.col("line").alias("raw")]
    judged = judge_lines(lines, schema, *place)
    return judged.select("source", "position", "raw", "reason", *[f"`{name}`" for name in names])
