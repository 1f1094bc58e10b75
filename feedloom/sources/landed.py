"""Landed responses: one row per response, whatever feed and page it came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType
from pyspark.sql.window import Window

from feedloom.functions import request_key
from feedloom.operators.envelope import answered, first_document, parsed_body, sound

LANDED = "feed string, skip bigint, status int, body string"


RUNS = "run bigint, attempt int"


def read_landed(
    spark: SparkSession, path: str, fmt: str = "parquet", classified: bool = False, runs: bool = False
) -> DataFrame:
    """All landed responses of all feeds in one scan, `classified` if they were landed so.

    With `runs` the landed rows number their runs and the attempts at each page.
    """
    schema = ", ".join([LANDED, *[RUNS] * runs, *["outcome string, reason string"] * classified])
    return spark.read.schema(schema).format(fmt).load(path)


def read_documents(spark: SparkSession, path: str, feed: Column | str | None = None) -> DataFrame:
    """JSON document files, one file per response; the feed is the file's base name.

    The text is kept whole, so a multi-line document is one row and a broken one can
    still be classified.
    """
    named = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    if feed is not None:
        named = F.lit(feed) if isinstance(feed, str) else feed
    return spark.read.text(path, wholetext=True).select(
        named.alias("feed"),
        F.lit(0).cast("bigint").alias("skip"),
        F.lit(200).alias("status"),
        F.col("value").alias("body"),
    )


def page_requests(feeds: DataFrame, pages: Column | str, step: int = 500) -> DataFrame:
    """One row per page to land: (feed, skip, request) for `pages` pages of each feed.

    Pages come in runs of up to 1000, spread over the cluster, so that a feed with very
    many pages is neither one array nor one task's work.
    """
    count = F.col(pages) if isinstance(pages, str) else pages
    partitions = int(feeds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = step * 1000
    end = count.cast("bigint") * step
    starts = F.sequence(F.lit(0).cast("bigint"), end - 1, F.lit(run).cast("bigint"))
    runs = feeds.where(count > 0).select("feed", end.alias("end"), F.explode(starts).alias("first"))
    skips = F.sequence("first", F.least(F.col("first") + run, "end") - 1, F.lit(step).cast("bigint"))
    return (
        runs.repartition(partitions, "feed", "first")
        .select("feed", F.explode(skips).alias("skip"))
        .withColumn("request", request_key("%s?$skip=%d", "feed", "skip"))
    )


def missing_pages(landed: DataFrame, feeds: DataFrame, step: int = 500, block: int = 1000) -> DataFrame:
    """(feed, first, n): the runs of pages that are still to be requested, merged, from `first` in steps.

    `feeds` is (feed, pages): how many pages, from 0, each feed should have; `landed` has the
    (feed, skip) that are there, in any order, repeated, or off the step, which do not count.
    Pages are compared in blocks of `block`, each an array of that length at most, and the
    blocks are spread over the cluster however long a feed is; only the runs that are
    missing, at most one for every other page and as a rule few, are merged across blocks.
    A feed that has landed whole gives no row; landed pages of other feeds are not looked at.
    """
    page = F.call_function("div", F.col("skip"), F.lit(step))
    on_step = (F.col("skip") >= 0) & (F.pmod("skip", F.lit(step)) == 0)
    there = (
        landed.where(on_step)
        .select("feed", F.call_function("div", page, F.lit(block)).alias("block"), page.alias("page"))
        .groupBy("feed", "block")
        .agg(F.collect_set("page").alias("there"))
    )
    last = F.call_function("div", F.col("pages").cast("bigint") - 1, F.lit(block))
    wanted = feeds.where("pages > 0").select(
        "feed", F.col("pages").cast("bigint").alias("pages"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("block")
    )
    first = F.col("block") * block
    pages = F.sequence(first, F.least(first + block, F.col("pages")) - 1)
    gaps = wanted.join(there, ["feed", "block"], "left").select(
        "feed", F.array_except(pages, F.coalesce("there", F.array().cast("array<bigint>"))).alias("gaps")
    )
    # Of pages that follow each other the place in the array and the number grow alike.
    numbered = gaps.select("feed", F.posexplode("gaps").alias("at", "page"))
    runs = numbered.groupBy("feed", (F.col("page") - F.col("at")).alias("run"), (F.col("page") / block).cast("bigint").alias("block"))
    runs = runs.agg(F.min("page").alias("low"), F.max("page").alias("high"))
    by_feed = Window.partitionBy("feed").orderBy("low")
    starts = F.coalesce(F.col("low") > F.lag("high").over(by_feed) + 1, F.lit(True))
    merged = runs.withColumn("run", F.sum(starts.cast("int")).over(by_feed)).groupBy("feed", "run")
    merged = merged.agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return merged.select("feed", (F.col("low") * step).alias("first"), (F.col("high") - F.col("low") + 1).alias("n"))


def first_link(responses: DataFrame, field: str = "value", link: str = "Link") -> DataFrame:
    """(feed, path) from the first record of each link document.

    A failed or empty link document stops the job: there is nothing to load for it.
    """
    record = StructType().add(link, StringType())
    parsed = responses.select("feed", F.when(answered(), parsed_body(field, record)).alias("_doc"))
    records = F.when(sound(F.col("_doc")), first_document(F.col("_doc"))[field])
    missing = F.raise_error(F.concat(F.lit("no data for "), F.col("feed")))
    return parsed.select("feed", F.coalesce(F.get(records, F.lit(0))[link], missing).alias("path"))
