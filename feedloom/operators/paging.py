"""Paged collections: which landed run of a feed is whole, where it ends, and what a failed scan becomes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from feedloom.operators.envelope import classify
from feedloom.operators.lookup import BROADCAST_BYTES, lookup_join, width
from feedloom.workspace import settle

POLICIES = ("raise", "empty", "fallback")
STEP = 500
# Of landings of one page with the same attempt, data is taken before empty before failed.
RANKS = {"failed": 0, "empty": 1, "data": 2}


def with_runs(landed: DataFrame) -> DataFrame:
    """The landed rows with `run` and `attempt`; a landing that does not number them is one run."""
    missing = {name: F.lit(0).cast(kind) for name, kind in (("run", "bigint"), ("attempt", "int")) if name not in landed.columns}
    return landed.withColumns(missing) if missing else landed


def best_landings(pages: DataFrame, *keys: str) -> DataFrame:
    """One row per feed, run and page (and `keys`): the outcome of its latest attempt, and how often it landed."""
    rank = F.lit(0)
    for outcome, value in RANKS.items():
        rank = F.when(F.col("outcome") == outcome, value).otherwise(rank)
    keyed = F.coalesce("attempt", F.lit(0)).cast("bigint") * len(RANKS) + rank
    return (
        pages.groupBy("feed", "run", "skip", *keys)
        .agg(
            F.max(keyed).alias("_best"),
            F.count(F.lit(1)).alias("landings"),
            F.max(F.coalesce(F.col("reason") == "over_limit", F.lit(False))).alias("over_limit"),
        )
        .withColumn("rank", F.pmod("_best", F.lit(len(RANKS))))
    )


def merged_landings(pages: DataFrame) -> DataFrame:
    """One row per feed, run and page of what `best_landings` found for parts of the landed rows."""
    return (
        pages.groupBy("feed", "run", "skip")
        .agg(
            F.max("_best").alias("_best"),
            F.sum("landings").alias("landings"),
            F.max("over_limit").alias("over_limit"),
        )
        .withColumn("rank", F.pmod("_best", F.lit(len(RANKS))))
    )


def run_bounds(
    pages: DataFrame, step: int = STEP, size: int | None = None, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """One row per feed and run: (feed, run, stop_at, landings, reason), `reason` null for a whole scan.

    Pages are read in `skip` order until the first empty one. A scan is whole when every
    page from 0 to that one has landed and none of them failed; else its reason is
    over_limit, failed_page, gap (also a lost first page or one off the step) or open_end.
    Pages past the end, of any kind, are never read and do no harm.

    `pages` is a settled table of narrow columns, one row per page, of at most `size`
    bytes if given. Minimums and counts are combined before each shuffle, so a feed with a
    third of all pages costs no more than any other.
    """
    ends = pages.groupBy("feed", "run").agg(
        F.min(F.when(F.col("rank") == RANKS["empty"], F.col("skip"))).alias("stop_at"),
        F.min(F.when(F.col("rank") == RANKS["failed"], F.col("skip"))).alias("failed_at"),
        F.min(F.when((F.col("rank") == RANKS["failed"]) & F.col("over_limit"), F.col("skip"))).alias("over_at"),
        F.max("landings").alias("landings"),
    )
    if size is None or size > broadcast_bytes:  # its own size is to be measured
        ends, size = settle(ends, "scan-ends"), None
    ends = ends.withColumnsRenamed({"run": "end_run"})
    before = lookup_join(
        pages.select("feed", "run", "skip"),
        ends,
        "feed",
        where=(F.col("run") == F.col("end_run")) & (F.col("skip") < F.col("stop_at")),
        spread=F.col("skip"),
        size=size,
        broadcast_bytes=broadcast_bytes,
    )
    on_step = F.count_if((F.col("skip") >= 0) & (F.pmod("skip", F.lit(step)) == 0))
    counts = before.groupBy("feed", "run").agg(on_step.alias("on_step"), F.count(F.lit(1)).alias("n"))
    counted = ends.withColumnsRenamed({"end_run": "run"}).join(counts, ["feed", "run"], "left")
    n = F.coalesce("n", F.lit(0))

    def before_end(place: str) -> Column:
        return F.col(place).isNotNull() & (F.col("stop_at").isNull() | (F.col(place) < F.col("stop_at")))

    reason = (
        F.when(before_end("over_at"), "over_limit")
        .when(before_end("failed_at"), "failed_page")
        .when(F.col("stop_at").isNull(), "open_end")
        .when((n * step != F.col("stop_at")) | (F.coalesce("on_step", F.lit(0)) != n), "gap")
    )
    return counted.select("feed", "run", "stop_at", "landings", reason.alias("reason"))


def latest_runs(bounds: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """One row per feed: its latest whole run and that run's end, or without one the latest run and its reason.

    A feed of `expected` that never landed has the reason never_landed.
    """
    whole = F.col("reason").isNull()
    latest = bounds.groupBy("feed").agg(
        F.max(F.when(whole, F.col("run"))).alias("use_run"),
        F.max_by("stop_at", F.when(whole, F.col("run"))).alias("stop_at"),
        F.max_by("reason", "run").alias("last_reason"),
        F.max("run").alias("last_run"),
        F.max("landings").alias("landings"),
    )
    latest = latest.withColumn("reason", F.when(F.col("use_run").isNull(), F.col("last_reason")))
    latest = latest.withColumn("over_limit", F.coalesce(F.col("last_reason") == "over_limit", F.lit(False)))
    latest = latest.select("feed", "use_run", "stop_at", "landings", "last_run", "reason", "over_limit")
    if expected is None:
        return latest
    lost = expected.select("feed").distinct().join(latest.select("feed"), "feed", "left_anti")
    empty = [F.lit(None).cast("bigint").alias(name) for name in ("use_run", "stop_at", "landings", "last_run")]
    return latest.unionByName(
        lost.select("feed", *empty, F.lit("never_landed").alias("reason"), F.lit(False).alias("over_limit"))
    )


def resolve_batches(
    landed: DataFrame,
    on_failure: str = "raise",
    fallback: DataFrame | None = None,
    expected: DataFrame | None = None,
    step: int = STEP,
    broadcast_bytes: int = BROADCAST_BYTES,
    as_of: str | None = None,
) -> DataFrame:
    """The responses to read records from: the pages of each feed's latest whole run up to its end.

    A feed without a whole run stops the job ("raise"), gives no responses ("empty"), or
    is replaced by its documents in `fallback`, which has the landed columns too
    ("fallback"). An empty feed is not a failed one: it gives no records either way.
    `expected` has the feeds there should be; a fallback's feeds are expected by
    themselves. A latest run with a page over the parser's limits stops the job under
    any policy. A fallback may hold several snapshots of a feed: `as_of` names the column
    that tells when each was taken, and the newest one not newer than the feed's latest run
    is chosen (`snapshots_as_of`).

    `landed` may number its runs and the attempts at a page (`run`, `attempt`); of a page
    landed more than once in a run the latest attempt counts. It is read here, to find
    where each feed ends, and again by whoever uses the result. Where it was classified
    when landed this first read is a narrow one.
    """
    narrow = with_runs(classify(landed)).select("feed", "run", "attempt", "skip", "outcome", "reason")
    return resolve_pages(best_landings(narrow), lambda _: landed, on_failure, fallback, expected, step, broadcast_bytes, as_of)


def resolve_pages(
    pages: DataFrame,
    landed_of: Callable[[DataFrame], DataFrame],
    on_failure: str = "raise",
    fallback: DataFrame | None = None,
    expected: DataFrame | None = None,
    step: int = STEP,
    broadcast_bytes: int = BROADCAST_BYTES,
    as_of: str | None = None,
) -> DataFrame:
    """`resolve_batches` from pages whose outcomes are known already (as `best_landings` gives them).

    `landed_of` gets the feeds' whole runs (feed, use_run, end), settled, and gives the
    landed rows that hold those runs' pages, and may hold any others.
    """
    if on_failure not in POLICIES:
        raise ValueError(f"on_failure must be one of {POLICIES}, not {on_failure!r}")
    if (on_failure == "fallback") != (fallback is not None):
        raise ValueError("a fallback is needed for, and only for, on_failure='fallback'")
    if expected is None and fallback is not None:
        expected = fallback.select("feed")
    # What is known of a table is seen as it is written, so that small ones are not read again to be measured.
    seen, judged = Observation(), Observation()
    row = F.lit(128) + F.coalesce(F.octet_length("feed"), F.lit(0))
    pages = settle(pages.observe(seen, F.sum(row).alias("bytes")), "pages")
    bound = seen.get["bytes"] or 0
    feeds = latest_runs(run_bounds(pages, step, bound, broadcast_bytes), expected)
    stopping = F.col("over_limit") | (F.col("reason").isNotNull() if on_failure == "raise" else F.lit(False))
    feeds = feeds.observe(judged, F.count_if(stopping).alias("stopping"), F.max("landings").alias("landings"))
    feeds = settle(feeds, "feeds")
    if judged.get["stopping"]:
        some = feeds.where(stopping).limit(10).collect()
        raise RuntimeError(f"failed feeds, among them: {sorted((row['feed'], row['reason']) for row in some)}")

    size = bound if expected is None and bound <= broadcast_bytes else width(feeds)
    whole = feeds.where("use_run IS NOT NULL").select("feed", "use_run", F.col("stop_at").alias("end"))
    in_scan = (F.col("run") == F.col("use_run")) & (F.col("skip") < F.col("end"))
    columns = ["feed", "skip", "status", "body"]
    kept = lookup_join(
        with_runs(landed_of(whole)), whole, "feed", "left_semi", in_scan, F.col("skip"), size, broadcast_bytes, measure="body"
    )
    if (judged.get["landings"] or 0) > 1:
        again = pages.where("landings > 1").select("feed", "run", "skip", "_best")
        kept = _landed_again(kept, settle(again, "landed-again"))
    kept = kept.select(columns)
    if fallback is None:
        return kept
    failed = feeds.where("reason IS NOT NULL").select("feed", "last_run")
    if as_of is not None:
        return kept.unionByName(snapshots_as_of(fallback, failed, as_of, broadcast_bytes).select(columns))
    substitutes = lookup_join(
        fallback.select(columns),
        failed.select("feed"),
        "feed",
        "left_semi",
        spread=F.col("body"),
        size=size,
        broadcast_bytes=broadcast_bytes,
        measure="body",
    )
    return kept.unionByName(substitutes)


def snapshots_as_of(
    snapshots: DataFrame, feeds: DataFrame, taken: str = "taken", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The rows of each feed's newest snapshot that is not newer than its `last_run`.

    `feeds` is (feed, last_run); one whose last run is NULL, as it never landed, gets its
    newest snapshot, and one whose snapshots are all newer, or have no time, none. Only the
    times are compared, a maximum that is combined before the shuffle: snapshots are neither
    sorted nor shuffled whole, and a feed with very many of them is one narrow row a task.
    """
    feeds = settle(feeds.select("feed", "last_run"), "as-of-feeds")
    in_time = F.col(taken).isNotNull() & (F.col("last_run").isNull() | (F.col(taken) <= F.col("last_run")))
    times = snapshots.select("feed", taken).distinct()
    # Runs are carried over by a join on the feed, and each feed keeps its newest time.
    joined = lookup_join(times, feeds, "feed", where=in_time, spread=F.col(taken), broadcast_bytes=broadcast_bytes)
    chosen = settle(joined.groupBy("feed").agg(F.max(taken).alias("_chosen")), "as-of")
    return lookup_join(
        snapshots,
        chosen,
        "feed",
        "left_semi",
        F.col(taken) == F.col("_chosen"),
        F.col("body"),
        broadcast_bytes=broadcast_bytes,
        measure="body",
    )


def _landed_again(kept: DataFrame, again: DataFrame) -> DataFrame:
    """`kept` with one row for each page that landed more than once: its best landing, by body if they tie."""
    columns = ["feed", "skip", "status", "body"]
    key = ["feed", "run", "skip"]
    once = kept.join(again.select(key), key, "left_anti").select(columns)
    rank = F.lit(0)
    for outcome, value in RANKS.items():
        rank = F.when(F.col("outcome") == outcome, value).otherwise(rank)
    keyed = F.coalesce("attempt", F.lit(0)).cast("bigint") * len(RANKS) + rank
    more = classify(kept.join(again, key)).where(keyed == F.col("_best"))
    picked = more.groupBy(key).agg(F.max(F.struct("body", "status")).alias("page"))
    return once.unionByName(picked.select("feed", "skip", "page.status", "page.body"))
