"""The registered queries and, for each, its SQL over the same tables.

Every query packs whole tables into landed documents or files and runs the operators
on those; the SQL computes the same rows from the tables directly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from feedloom.functions import calendar_month_key, month_key, request_key
from feedloom.operators import (
    classify,
    judge_records,
    preview,
    project_documents,
    require_rows,
    resolve_batches,
    row_counter,
    set_apart,
    type_audit,
    unpivot_columns,
)
from feedloom.plans import packing
from feedloom.plans.feeds import archive_links, arrivals, incidents, judged_volume, linked_lines, passenger_volume, stops
from feedloom.plans.packing import PAGE_STEP, div, landed, landed_path, table
from feedloom.sinks import (
    append_once,
    append_table,
    column_measures,
    load_verdicts,
    month_replace,
    publish_version,
    read_loads,
    read_version,
    replace_table,
)
from feedloom.sources import (
    LANDED,
    RUNS,
    csv_audit,
    first_member_lines,
    infer_csv,
    infer_lines,
    list_archives,
    missing_pages,
    page_requests,
    parse_lines,
    read_csv,
    read_documents,
    stage_lines,
)
from feedloom.streaming import load_available, load_paged
from feedloom.workspace import new_path, settle

Query = Callable[[SparkSession, str], DataFrame]

EVENT = StructType().add("event_id", LongType()).add("event_type", StringType()).add("value", DoubleType())
PROPS = StructType().add("k", StringType()).add("absent", StringType())
LINE = (
    StructType()
    .add("conv_id", LongType())
    .add("turn", LongType())
    .add("role", StringType())
    .add("line_no", LongType())
    .add("line", StringType())
)
# Ids to a feed.
SPAN = 500
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
ORDER_CSV = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string"
PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]
PART_CSV = "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double"


# Documents


def arrivals_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return arrivals(landed(spark, sf_dir, "arrivals", lambda: packing.arrival_responses(events)), on_failure="empty")


def envelope_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn is a document whose records are the lines of its whole text."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, at: F.struct(
            F.col("conv_id"), F.col("turn"), F.col("role"), (at + 1).cast("bigint").alias("line_no"), line.alias("line")
        ),
    )
    documents = table(spark, sf_dir, "conversations").select(
        F.format_string("%d/%d", "conv_id", "turn").alias("feed"),
        F.lit(0).cast("bigint").alias("skip"),
        F.lit(200).alias("status"),
        F.to_json(F.struct(lines.alias("value"))).alias("body"),
    )
    return project_documents(landed(spark, sf_dir, "turns", lambda: documents), LINE)


def incidents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each web page is one incident document whose message is the page's whole text."""
    pages = table(spark, sf_dir, "pages")
    record = F.struct(
        F.regexp_extract("url", r"^\w+://([^/?]*)", 1).alias("Type"),
        (F.col("page_id") / 8).alias("Latitude"),
        F.col("html").alias("Message"),
        F.col("page_id").alias("Undeclared"),
    )
    packed = packing.single_records(pages, F.col("page_id").cast("string"), F.to_json(record))
    return incidents(landed(spark, sf_dir, "incidents", lambda: packed))


def stops_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stops: feeds of 500 in pages of 50, closed by an empty page that
    one which must not be read follows. A page with a balance under -980 is refused;
    the fallback snapshot of its feed has the stops' codes only."""
    customer = table(spark, sf_dir, "customer")
    feed = div("c_custkey", SPAN).cast("string")
    pages = packing.stop_pages(customer, feed, div(F.pmod("c_custkey", F.lit(SPAN)), 50))
    code = F.to_json(F.struct(F.col("c_custkey").cast("string").alias("BusStopCode")))
    snapshot = packing.single_records(customer, feed, code)
    landed_pages = landed(spark, sf_dir, "stops", lambda: pages)
    return stops(landed_pages, landed(spark, sf_dir, "stops-snapshot", lambda: snapshot))


def project_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared key, a declared key no record has, and the undeclared rest dropped."""
    events = table(spark, sf_dir, "events")
    documents = packing.single_records(events, F.col("event_id").cast("string"), F.col("props"))
    projected = project_documents(landed(spark, sf_dir, "props", lambda: documents), PROPS, "feed")
    return projected.select(F.col("feed").cast("bigint").alias("event_id"), "k", "absent")


def literal_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.lit("all-events").alias("feed"), "event_id", "user_id")


def unpivot_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return unpivot_columns(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], measures, "measure", "amount"
    )


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event documents whose value is written as an integer, a wide one, a decimal, text or null."""
    value = F.col("value")
    text = (
        F.when((F.col("event_type") == "click") & (value > 100), F.concat(F.floor(value), F.lit("0" * 20)))
        .when(F.col("event_type") == "click", F.floor(value).cast("string"))
        .when(F.col("event_type") == "view", F.concat(F.lit('"'), value.cast("string"), F.lit('"')))
        .when(F.col("event_type") == "error", "null")
        .otherwise(value.cast("string"))
    )
    record = F.concat(
        F.lit('{"event_id":'), "event_id", F.lit(',"event_type":"'), "event_type", F.lit('","value":'), text, F.lit("}")
    )
    packed = packing.single_records(table(spark, sf_dir, "events"), F.col("event_id").cast("string"), record)
    return landed(spark, sf_dir, "mixed", lambda: packed)


def type_audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_audit(_mixed(spark, sf_dir), EVENT)


def project_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mistyped values by parser rules: integers become doubles, quoted numbers NULL."""
    return project_documents(_mixed(spark, sf_dir), EVENT, strict=False)


# Paged feeds and failed feeds


def _paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds of 500 events in pages of 20; errors are the records kept."""
    return packing.paged_responses(
        table(spark, sf_dir, "events"),
        feed=div("event_id", SPAN).cast("string"),
        page=div(F.pmod("event_id", F.lit(SPAN)), 20),
        kept=F.col("event_type") == "error",
    )


def _rows(pages: DataFrame) -> DataFrame:
    return project_documents(pages, EVENT, "feed", on_failure="raise")


def pages_until_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(resolve_batches(landed(spark, sf_dir, "paged", lambda: _paged(spark, sf_dir))))


def _hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five feeds, however large the table: each holds a fifth of it, nearly all of which is kept."""
    responses = packing.paged_responses(
        table(spark, sf_dir, "events"),
        feed=F.concat(F.lit("hot"), F.pmod("event_id", F.lit(5))),
        page=div("event_id", 100),
        kept=F.col("value") >= 1,
    )
    return landed(spark, sf_dir, "hot", lambda: classify(responses))


def pages_of_hot_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(resolve_batches(_hot(spark, sf_dir)))


def hot_feeds_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As if the table of feeds were too large to broadcast: hot feeds are cut into parts."""
    return _rows(resolve_batches(_hot(spark, sf_dir), broadcast_bytes=0))


def _troubled(spark: SparkSession, sf_dir: str, silent_below: float | None = None) -> DataFrame:
    """Feeds of 500 events in pages of 10, some of them empty, refused, cut short or not answered."""
    return packing.paged_responses(
        table(spark, sf_dir, "events"),
        feed=div("event_id", SPAN).cast("string"),
        page=div(F.pmod("event_id", F.lit(SPAN)), 10),
        kept=F.col("event_type").isin("error", "click"),
        error_above=350,
        broken_above=300,
        silent_below=silent_below,
    )


def batch_or_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages classified when landed; the fallback snapshot of a feed is all its events."""
    snapshot = packing.single_records(
        table(spark, sf_dir, "events"),
        div("event_id", SPAN).cast("string"),
        F.to_json(F.struct("event_id", "event_type", "value")),
    )
    pages = landed(spark, sf_dir, "troubled-classified", lambda: classify(_troubled(spark, sf_dir)))
    return _rows(resolve_batches(pages, "fallback", landed(spark, sf_dir, "snapshot", lambda: snapshot)))


def batch_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses landed as they came, parsed when resolved."""
    responses = landed(spark, sf_dir, "troubled", lambda: _troubled(spark, sf_dir))
    return _rows(resolve_batches(responses, "empty"))


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        batch_or_empty(spark, sf_dir)
        .groupBy("feed")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("event_type") == "error").alias("n_errors"))
    )


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load's own counter saw on the way to its table, after the check that there are rows."""
    rows = require_rows(batch_or_empty(spark, sf_dir), "the events")
    counted, seen = row_counter(rows, n_errors=F.col("event_type") == "error")
    settle(counted, "loaded")
    return spark.createDataFrame([(seen.get["rows"], seen.get["n_errors"])], "n_rows bigint, n_errors bigint")


def outcome_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feed's responses by outcome, and the failed ones by reason."""
    judged = classify(landed(spark, sf_dir, "silent", lambda: _troubled(spark, sf_dir, silent_below=0.2)))
    return judged.groupBy("feed", "outcome", "reason").agg(F.count(F.lit(1)).alias("n"))


def incomplete_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds that lost pages with a low value, their closing page, or everything, under two policies."""
    events = table(spark, sf_dir, "events")
    feed, page = div("event_id", SPAN), div(F.pmod("event_id", F.lit(SPAN)), 20)
    packed = packing.paged_responses(events, feed.cast("string"), page, F.lit(True), silent_below=0.1)
    number = F.col("feed").cast("int")
    closing = F.col("body") == '{"value":[]}'
    left = packed.where(
        F.col("status").isNotNull() & ~(closing & (number % 7 == 2)) & (number % 5 != 3)
    )  # what got no answer was not landed at all
    responses = landed(spark, sf_dir, "incomplete", lambda: left)
    snapshot_rows = packing.single_records(
        events, feed.cast("string"), F.to_json(F.struct("event_id", F.lit("kept").alias("event_type"), "value"))
    )
    snapshot = landed(spark, sf_dir, "kept-snapshot", lambda: snapshot_rows)
    by_fallback = _rows(resolve_batches(responses, "fallback", snapshot)).withColumn("policy", F.lit("fallback"))
    return by_fallback.unionByName(_rows(resolve_batches(responses, "empty")).withColumn("policy", F.lit("empty")))


def fallback_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds whose last run, 10 or 20, failed, and three snapshots of each, taken at 5, 15 and 25.

    Every fourth feed's run is whole, and every seventh has no snapshot before 15.
    """
    events = table(spark, sf_dir, "events")
    number = div("event_id", SPAN)
    packed = packing.paged_responses(events, number.cast("string"), div(F.pmod("event_id", F.lit(SPAN)), 20), F.lit(True))
    own = F.col("feed").cast("int")
    runs = packed.withColumns({"run": F.when(own % 2 == 0, 10).otherwise(20).cast("bigint"), "attempt": F.lit(1)})
    refused = (F.col("skip") == 0) & (own % 4 != 0)
    runs = runs.withColumn("status", F.when(refused, 503).otherwise(F.col("status")))
    snapshots = [
        packing.single_records(
            events.where(number % 7 != 0) if taken < 15 else events,
            number.cast("string"),
            F.to_json(F.struct("event_id", "event_type", (F.col("value") + taken * 1000).alias("value"))),
        ).withColumn("taken", F.lit(taken).cast("bigint"))
        for taken in (5, 15, 25)
    ]
    taken = landed(spark, sf_dir, "snapshots", lambda: snapshots[0].unionByName(snapshots[1]).unionByName(snapshots[2]))
    return _rows(resolve_batches(landed(spark, sf_dir, "late-runs", lambda: runs), "fallback", taken, as_of="taken"))


def requests_to_make(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of two events each that have no error event are taken as landed; those with one are missing.

    One feed holds every event whose user has a number divisible by three, so it is long.
    """
    events = table(spark, sf_dir, "events")
    feed = F.when(F.col("user_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("user_id") % 50).cast("string")))
    pages = events.select(feed.alias("feed"), div("event_id", 2).alias("page"), "event_type")
    landed_pages = (
        pages.groupBy("feed", "page")
        .agg(F.count_if(F.col("event_type") == "error").alias("errors"))
        .where("errors = 0")
        .select("feed", (F.col("page") * PAGE_STEP).alias("skip"))
    )
    return missing_pages(landed_pages, pages.groupBy("feed").agg((F.max("page") + 1).alias("pages")), PAGE_STEP)


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of every feed; in the second, page 5 of some feeds failed and was fetched again, of others was lost."""
    events = table(spark, sf_dir, "events")
    feed, page = div("event_id", SPAN).cast("string"), div(F.pmod("event_id", F.lit(SPAN)), 20)

    def run(number: int, added: float) -> DataFrame:
        packed = packing.paged_responses(events.withColumn("value", F.col("value") + added), feed, page, F.lit(True))
        return packed.withColumns({"run": F.lit(number).cast("bigint"), "attempt": F.lit(1)})

    second = run(2, 1000)
    fifth = (F.col("skip") == 5 * PAGE_STEP) & (F.col("body") != '{"value":[]}')
    kind = F.pmod(F.col("feed").cast("int"), F.lit(3))
    broken = second.where(fifth & (kind == 0)).withColumn("body", F.lit("{"))
    again = second.where(fifth & (kind == 0)).withColumn("attempt", F.lit(2))
    rest = second.where(~(fifth & (kind < 2)))
    both = run(1, 0).unionByName(rest).unionByName(broken).unionByName(again)
    return _rows(resolve_batches(landed(spark, sf_dir, "two-runs", lambda: both)))


def documents_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as document files of 500 records, one response to a file."""
    customer = table(spark, sf_dir, "customer")
    record = F.struct("c_custkey", "c_name", "c_acctbal")
    bodies = (
        customer.groupBy(div("c_custkey", SPAN).alias("span"))
        .agg(F.collect_list(record).alias("value"))
        .select(F.to_json(F.struct("value")))
    )
    path = landed_path(spark, sf_dir, "documents", bodies.write.option("maxRecordsPerFile", 1).text)
    schema = StructType().add("c_custkey", LongType()).add("c_name", StringType()).add("c_acctbal", DoubleType())
    return project_documents(read_documents(spark, path, "customers"), schema, "feed")


# Files and archives


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    turned = orders.select(*reversed(orders.columns))
    path = landed_path(spark, sf_dir, "turned-csv", lambda path: turned.write.csv(path, header=True))
    return read_csv(spark, path, orders.schema)


def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose price is text for some and which have a cell too many for others, counted and read leniently."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    key = F.col("o_orderkey")
    price = F.when(key % 10 == 3, "none").otherwise(F.col("o_totalprice").cast("string"))
    extra = F.when(key % 10 == 7, ",x").otherwise("")
    lines = orders.select(
        F.concat(key.cast("string"), F.lit(","), price, F.lit(","), "o_orderpriority", extra).alias("value")
    )
    path = landed_path(spark, sf_dir, "malformed-csv", lines.write.text)
    schema = "o_orderkey bigint, o_totalprice double, o_orderpriority string"
    audit = csv_audit(spark, path, schema, header=False).select("malformed", "n")
    read = read_csv(spark, path, schema, header=False, strict=False)
    priced = read.agg(F.count("o_totalprice").alias("n_prices"), F.sum("o_orderkey").alias("keys"))
    return audit.join(F.broadcast(priced))


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = landed_path(spark, sf_dir, "orders-csv", lambda path: orders.write.csv(path, header=True))
    read = read_csv(spark, path)
    types = F.lit(", ".join(f"{name} {kind}" for name, kind in read.dtypes))
    return read.select(*[F.col(f.name).cast(f.dataType) for f in orders.schema.fields], types.alias("types"))


def csv_types_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a code of leading zeros and a month; no value changes by its type."""
    orders = table(spark, sf_dir, "orders")
    coded = orders.select(
        F.format_string("%07d", "o_orderkey").alias("code"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.when(F.col("o_orderkey") % 5 > 0, F.col("o_custkey")).alias("custkey"),
        (F.col("o_orderkey") * 10_000_000_000).alias("wide"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey").cast("string"))
        .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
        .alias("price"),
    )
    path = landed_path(spark, sf_dir, "coded-csv", lambda path: coded.write.csv(path, header=True))
    read = infer_csv(spark, path)
    return read.withColumn("types", F.lit(", ".join(f"{name} {kind}" for name, kind in read.dtypes)))


def months_of_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years of orders as loads of their own: a code is a number in the first, text in the
    second, a wide number after; one load has no rows."""
    year = F.year("o_orderdate")
    code = (
        F.when(year == 1997, F.format_string("%09d", "o_orderkey"))
        .when(year < 1997, F.col("o_orderkey").cast("string"))
        .otherwise((F.col("o_orderkey") + 5_000_000_000).cast("string"))
    )
    lines = table(spark, sf_dir, "orders").select(year.alias("year"), F.concat_ws(",", code, "o_custkey").alias("line"))
    lines = landed(spark, sf_dir, "coded-lines", lambda: lines)
    path = new_path(spark, "typed-loads")
    for load, chosen in (("early", "year < 1997"), ("1997", "year = 1997"), ("none", "year IS NULL"), ("later", "year > 1997")):
        append_once(infer_lines(lines.where(chosen), ["code", "custkey"], nothing="void"), path, load)
    read = read_loads(spark, path)
    return read.withColumn("types", F.lit(", ".join(f"{name} {kind}" for name, kind in read.dtypes)))


def volume_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of archives with a bad cell, a missing and a surplus one, set apart from those that fit."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    size = F.when(key % 10 == 3, "none").otherwise(F.col("p_size").cast("string"))
    cells = [key.cast("string"), F.to_csv(F.struct("p_name")), size, F.col("p_retailprice").cast("string")]
    line = F.concat_ws(",", *cells[: 3], F.when(key % 10 != 7, cells[3]), F.when(key % 10 == 9, "x"))
    path = F.format_string("part-%d.zip", div("p_partkey", 500))
    columns = ["p_partkey", "p_name", "p_size", "p_retailprice"]
    archives = landed(spark, sf_dir, "bad-zips", lambda: packing.archives(part, path, columns, line))
    apart = set_apart(judged_volume(archives, "p_partkey bigint, p_name string, p_size int, p_retailprice double"))
    bad = apart.bad.select(
        F.split("raw", ",")[0].cast("bigint").alias("p_partkey"),
        *[F.lit(None).cast(apart.good.schema[name].dataType).alias(name) for name in columns[1:]],
        "source",
        "reason",
    )
    nothing = F.lit(None).cast("string")
    rows = apart.good.withColumns({"source": nothing, "reason": nothing}).unionByName(bad)
    return rows.withColumns({"n_good": F.lit(apart.n_good), "n_bad": F.lit(apart.n_bad)})


def records_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records whose value has another JSON type, and documents cut short, set apart from the good ones."""
    mixed = _mixed(spark, sf_dir)
    cut = F.pmod(F.col("feed").cast("bigint"), F.lit(11)) == 0
    body = F.when(cut, F.expr("left(body, length(body) - 1)")).otherwise(F.col("body"))
    apart = set_apart(judge_records(mixed.withColumn("body", body), EVENT))
    good = apart.good.select(F.col("event_id").alias("source"), "event_type", "value", F.lit(None).cast("string").alias("reason"))
    bad = apart.bad.select(
        F.col("source").cast("bigint").alias("source"),
        F.lit(None).cast("string").alias("event_type"),
        F.lit(None).cast("double").alias("value"),
        "reason",
    )
    return good.unionByName(bad).withColumns({"n_good": F.lit(apart.n_good), "n_bad": F.lit(apart.n_bad)})


def zip_first_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.format_string("part-%d.zip", div("p_partkey", 500))
    packed = packing.archives(table(spark, sf_dir, "part"), path, PART_COLUMNS)
    archives = landed(spark, sf_dir, "part-zips", lambda: packed)
    return parse_lines(first_member_lines(archives, PART_COLUMNS), PART_CSV)


def archives_opened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives as files, which tasks open by their paths and read as streams, whatever their size."""
    path = F.format_string("part-%d.zip", div("p_partkey", 500))
    packed = packing.archives(table(spark, sf_dir, "part"), path, PART_COLUMNS)
    folder = packing.landed_path(spark, sf_dir, "zip-files", lambda made: packing.archive_files(packed, made))
    return parse_lines(first_member_lines(list_archives(spark, folder), PART_COLUMNS), PART_CSV)


def archive_by_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request key → link document → its first link's archive → staged lines by feed → CSV.

    Each link document also names a decoy archive, whose rows must not appear.
    """
    orders = table(spark, sf_dir, "orders")
    ym = month_key("o_orderdate")
    slice_no = div("o_orderkey", 20000)
    path = F.format_string("%s/%d.zip", ym, slice_no)
    decoy = orders.withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    decoy_path = F.format_string("%s/decoy%d.zip", ym, div(-1 - F.col("o_orderkey"), 20000))
    archives = packing.archives(orders, path, ORDER_COLUMNS).unionByName(
        packing.archives(decoy, decoy_path, ORDER_COLUMNS)
    )
    requests = (
        orders.select(ym.alias("ym"), slice_no.alias("slice"))
        .distinct()
        .withColumn("feed", request_key("volume?Date=%s&part=%d", "ym", "slice"))
    )
    links = packing.single_records(
        requests,
        F.col("feed"),
        F.format_string('{"Link":"%s/%d.zip"},{"Link":"%s/decoy%d.zip"}', "ym", "slice", "ym", "slice"),
    )
    packed = archives
    archives = landed(spark, sf_dir, "order-zips", lambda: packed)
    lines = linked_lines(archives, archive_links(links, archives), ORDER_COLUMNS)
    month = F.regexp_extract("feed", r"Date=(\d{6})", 1)
    raw = new_path(spark, "raw")
    stage_lines(lines.select(month.alias("ym"), "line"), raw, "ym")
    return read_csv(spark, raw, f"{ORDER_CSV}, ym string", header=False)


def volume_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names from the archives' headers, types from their values."""
    path = F.format_string("part-%d.zip", div("p_partkey", 500))
    part = table(spark, sf_dir, "part")
    archives = packing.archives(part, path, PART_COLUMNS)
    paths = part.select(path.alias("path")).distinct()
    feed = F.concat(F.lit("00"), F.regexp_extract("path", r"\d+", 0))
    links = packing.single_records(paths, feed, F.to_json(F.struct(F.col("path").alias("Link"))))
    rows = passenger_volume(links, landed(spark, sf_dir, "volume-zips", lambda: archives))
    types = F.lit(", ".join(f"{name} {kind}" for name, kind in rows.dtypes))
    columns = [F.col(name).cast(part.schema[name].dataType) for name in PART_COLUMNS]
    return rows.select("feed", *columns, types.alias("types"))


def signed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links with a signature after the archive's name; every archive is named by two feeds."""
    path = F.format_string("store/%d/part-%d.zip", div("p_partkey", 5000), div("p_partkey", 500))
    part = table(spark, sf_dir, "part")
    archives = packing.archives(part, path, PART_COLUMNS)
    link = F.format_string("https://host/x/part-%d.zip?sig=a/b%%2F#%d.zip", "slice", "slice")
    feeds = part.select(div("p_partkey", 500).alias("slice")).distinct()
    feeds = feeds.withColumn("feed", F.explode(F.array(F.lit("first"), F.lit("second"))))
    feeds = feeds.withColumn("feed", F.concat("feed", F.lit("-"), F.col("slice").cast("string")))
    links = packing.single_records(feeds, F.col("feed"), F.to_json(F.struct(link.alias("Link"))))
    rows = passenger_volume(links, landed(spark, sf_dir, "signed-zips", lambda: archives), PART_CSV, by_name=True)
    return rows.select(F.split("feed", "-")[0].alias("feed"), *PART_COLUMNS)


def request_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page requests each customer segment's feed needs, at 500 records a page."""
    customer = table(spark, sf_dir, "customer")
    feeds = customer.groupBy(F.col("c_mktsegment").alias("feed")).agg(F.count(F.lit(1)).alias("n"))
    return page_requests(feeds, F.ceil(F.col("n") / PAGE_STEP))


def month_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "orders").select(
        month_key("o_orderdate").alias("ym"), calendar_month_key("o_orderdate").alias("calendar_ym")
    )
    return keyed.groupBy("ym", "calendar_ym").agg(F.count(F.lit(1)).alias("n"))


# Sinks and loads


def table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replaced twice: the second write leaves nothing of the first."""
    customer = table(spark, sf_dir, "customer")
    target = {"path": new_path(spark, "customer")}
    replace_table(customer.withColumn("c_acctbal", F.lit(0.0)), target, fmt="parquet")
    replace_table(customer, target, fmt="parquet")
    return spark.read.schema(customer.schema).parquet(target["path"])


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace, then append with the columns in another order."""
    customer = table(spark, sf_dir, "customer")
    target = {"path": new_path(spark, "customer")}
    replace_table(customer, target, fmt="parquet")
    append_table(customer.select(*reversed(customer.columns)), target, fmt="parquet", schema=customer.schema)
    return spark.read.schema(customer.schema).parquet(target["path"])


def append_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders added month by month; one month fails on its way and is run again, two are repeated."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    path = new_path(spark, "orders-loads")
    year = F.year("o_orderdate")
    failing = F.when(year < 1999, F.col("o_orderkey")).otherwise(F.raise_error(F.lit("half way")).cast("bigint"))
    recent, old = orders.where(year >= 1998), orders.where(year < 1998)
    append_once(old, path, "old")
    try:
        append_once(recent.withColumn("o_orderkey", failing), path, "recent")
    except PySparkException:
        append_once(recent, path, "recent")
    append_once(recent, path, "recent")
    append_once(old, path, "old")
    return read_loads(spark, path)


def loads_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events added week by week of the month, the last of which is short; what the ledger says of each load.

    `distinct_close` and `median_close` hold the sketches against the loads' rows: within four standard
    errors of the distinct values, and four percent of the ranks.
    """
    events = table(spark, sf_dir, "events").select("user_id", "value", "ts")
    path = new_path(spark, "events-loads")
    for week in range(5):
        part = events.where(div(F.dayofmonth("ts") - 1, 7) == week)
        append_once(part, path, f"week {week}", measured=("user_id", "value"))
    held = column_measures(spark, path).drop("n_rows").join(load_verdicts(spark, path), "load_id")
    cells = read_loads(spark, path).select(
        "load_id", F.expr("stack(2, 'user_id', CAST(user_id AS DOUBLE), 'value', value) AS (column, cell)")
    )
    # The measures are two rows a load.
    facts = cells.join(F.broadcast(held.select("load_id", "column", "median")), ["load_id", "column"])
    facts = facts.groupBy("load_id", "column").agg(
        F.count_distinct("cell").alias("exact"),
        F.avg((F.col("cell") < F.col("median")).cast("double")).alias("below"),
        F.avg((F.col("cell") <= F.col("median")).cast("double")).alias("up_to"),
    )
    return held.join(facts, ["load_id", "column"]).select(
        "load_id",
        "column",
        "n_rows",
        "usual_rows",
        "verdict",
        "n_null",
        (F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") * 0.065 + 1).alias("distinct_close"),
        ((F.col("below") <= 0.54) & (F.col("up_to") >= 0.46)).alias("median_close"),
        F.coalesce("shifted", F.lit(False)).alias("shifted"),
    )


def versions_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that began before a publish keeps its version; the next one sees the new table."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = new_path(spark, "customer-versions")
    publish_version(customer, path)
    begun = read_version(spark, path)
    publish_version(customer.withColumn("c_acctbal", F.col("c_acctbal") + 1), path)
    both = begun.withColumn("reader", F.lit("begun"))
    return both.unionByName(read_version(spark, path).withColumn("reader", F.lit("next")))


def preview_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "customer"), 10, F.desc("c_acctbal"), "c_custkey")


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed in two lots; loaded after each, and once more with nothing new."""
    packed = packing.paged_responses(
        table(spark, sf_dir, "events"),
        feed=div("event_id", SPAN).cast("string"),
        page=div(F.pmod("event_id", F.lit(SPAN)), 20),
        kept=F.lit(True),
    )
    pages = packed
    packed = landed(spark, sf_dir, "packed", lambda: pages)
    landing, target, checkpoint = (new_path(spark, name) for name in ("landing", "loaded", "load-checkpoint"))

    def rows(responses: DataFrame) -> DataFrame:
        return project_documents(responses, EVENT)

    odd_page = F.pmod(F.col("skip") / PAGE_STEP, F.lit(2)) == 1
    for lot in (odd_page, ~odd_page):
        packed.where(lot).write.mode("append").parquet(landing)
        load_available(spark, landing, target, checkpoint, rows)
    load_available(spark, landing, target, checkpoint, rows)
    return spark.read.schema(EVENT).parquet(target)


def incremental_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of paged feeds in three lots, loaded after each: the first run, half of the second, the rest of it.

    In every third feed the second run never gets its closing page, so the first one stays.
    """
    events = table(spark, sf_dir, "events")
    feed, page = div("event_id", SPAN).cast("string"), div(F.pmod("event_id", F.lit(SPAN)), 20)

    def run(number: int, added: float) -> DataFrame:
        rows = events.withColumn("value", F.col("value") + added)
        packed = packing.paged_responses(rows, feed, page, F.lit(True))
        return packed.withColumns({"run": F.lit(number).cast("bigint"), "attempt": F.lit(1)})

    packed = landed(spark, sf_dir, "lots", lambda: run(1, 0).unionByName(run(2, 1000)))
    landing, target, state = (new_path(spark, name) for name in ("landing", "paged-target", "paged-state"))
    odd_page = F.pmod(F.col("skip") / PAGE_STEP, F.lit(2)) == 1
    lost = (F.pmod(F.col("feed").cast("int"), F.lit(3)) == 1) & (F.col("body") == '{"value":[]}')
    second = (F.col("run") == 2) & ~lost
    for lot in (F.col("run") == 1, second & odd_page, second & ~odd_page):
        packed.where(lot).write.mode("append").parquet(landing)
        load_paged(spark, landing, target, state, _rows, f"{LANDED}, {RUNS}")
    return read_version(spark, target)


def month_replace_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months loaded, then 199701 loaded again, twice, with corrected prices."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("ym")
    )
    path = new_path(spark, "orders-by-month")
    month_replace(orders, path)
    corrected = orders.where(F.col("ym") == "199701").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    month_replace(corrected, path)
    month_replace(corrected, path)
    return spark.read.schema(orders.schema).parquet(path)


QUERIES: dict[str, Query] = {
    "arrivals_flatten": arrivals_flatten,
    "stops_table": stops_table,
    "incidents_table": incidents_table,
    "envelope_unnest": envelope_unnest,
    "project_named": project_named,
    "project_lenient": project_lenient,
    "literal_key": literal_key,
    "unpivot_columns": unpivot_measures,
    "type_audit": type_audit_counts,
    "pages_until_empty": pages_until_empty,
    "pages_of_hot_feeds": pages_of_hot_feeds,
    "hot_feeds_shuffled": hot_feeds_shuffled,
    "batch_or_fallback": batch_or_fallback,
    "batch_or_empty": batch_or_empty,
    "batch_counts": batch_counts,
    "load_counts": load_counts,
    "outcome_reasons": outcome_reasons,
    "incomplete_feeds": incomplete_feeds,
    "fallback_as_of": fallback_as_of,
    "requests_to_make": requests_to_make,
    "latest_run": latest_run,
    "documents_from_files": documents_from_files,
    "csv_scan": csv_scan,
    "csv_audit": csv_malformed,
    "csv_scan_inferred": csv_scan_inferred,
    "csv_types_kept": csv_types_kept,
    "months_of_types": months_of_types,
    "volume_audit": volume_audit,
    "records_audit": records_audit,
    "zip_first_member": zip_first_member,
    "archives_opened": archives_opened,
    "archive_by_link": archive_by_link,
    "volume_inferred": volume_inferred,
    "signed_links": signed_links,
    "request_keys": request_keys,
    "month_key": month_keys,
    "table_replace": table_replace,
    "table_append": table_append,
    "append_retried": append_retried,
    "loads_reconciled": loads_reconciled,
    "versions_published": versions_published,
    "preview": preview_customers,
    "incremental_load": incremental_load,
    "incremental_pages": incremental_pages,
    "month_replace": month_replace_twice,
}


_UNTIL_EMPTY = """
WITH paged AS ({pages}),
pages AS (SELECT feed, page, count(*) FILTER (kept) AS n FROM paged GROUP BY feed, page),
ends AS (SELECT feed, min(page) AS stop_at FROM pages WHERE n = 0 GROUP BY feed)
SELECT p.feed, p.event_id, p.event_type, p.value
FROM paged p LEFT JOIN ends e ON p.feed = e.feed
WHERE p.kept AND (e.stop_at IS NULL OR p.page < e.stop_at)
"""

_HOT = _UNTIL_EMPTY.format(
    pages="""
  SELECT 'hot' || CAST(event_id % 5 AS VARCHAR) AS feed, event_id // 100 AS page, value >= 1 AS kept,
         event_id, event_type, value FROM events"""
)

_TROUBLED = """
WITH paged AS (
  SELECT CAST(event_id // 500 AS VARCHAR) AS feed, event_id % 500 // 10 AS page,
         event_type IN ('error', 'click') AS kept, event_id, event_type, value
  FROM events),
pages AS (
  SELECT feed, page, max(value) > 300 AS failed, count(*) FILTER (kept) AS n
  FROM paged GROUP BY feed, page),
breaks AS (
  SELECT feed, arg_min(failed, page) AS failed, min(page) AS stop_at
  FROM pages WHERE failed OR n = 0 GROUP BY feed),
fetched AS (
  SELECT p.feed, p.event_id, p.event_type, p.value
  FROM paged p LEFT JOIN breaks b ON p.feed = b.feed
  WHERE p.kept AND (b.feed IS NULL OR (NOT b.failed AND p.page < b.stop_at)))
"""

ORACLES: dict[str, str] = {
    "arrivals_flatten": """
WITH docs AS (
  SELECT *, max(value) OVER (PARTITION BY event_id // 30) AS high,
         min(value) OVER (PARTITION BY event_id // 30) AS low,
         min(event_type) OVER (PARTITION BY event_id // 3) AS operator
  FROM events)
SELECT printf('%05d', event_id // 30) AS "BusStopCode",
       CAST(event_id // 3 AS VARCHAR) AS "ServiceNo",
       operator AS "Operator",
       CASE WHEN value < 4 THEN '' WHEN value >= 8 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' END
         AS "EstimatedArrival",
       CASE WHEN value < 4 THEN '' WHEN value >= 8 THEN CAST(value AS VARCHAR) END AS "Latitude",
       CASE WHEN value < 4 THEN '' WHEN value >= 8 THEN CAST(user_id AS VARCHAR) END AS "Longitude",
       CASE WHEN value < 4 THEN '' WHEN value >= 8 THEN json_extract_string(props, '$.k') END AS "VisitNumber",
       CASE WHEN value < 4 THEN '' WHEN value >= 8 THEN event_type END AS "Load",
       CASE WHEN value < 4 THEN '' WHEN value >= 8 THEN '' END AS "Feature",
       CASE WHEN value < 4 THEN '' WHEN value >= 8 THEN 'true' END AS "Type",
       'NextBus' || CAST(event_id % 3 + 1 AS VARCHAR) AS "BusInstance"
FROM docs
WHERE high <= 400 AND low >= 0.05 AND value >= 2 AND NOT (value >= 4 AND value < 6)
""",
    "stops_table": """
WITH failed AS (
  SELECT DISTINCT c_custkey // 500 AS feed FROM customer WHERE c_acctbal < -980)
SELECT CAST(c_custkey AS VARCHAR) AS "BusStopCode",
       CASE WHEN f.feed IS NULL THEN c_name END AS "RoadName",
       CASE WHEN f.feed IS NULL THEN c_mktsegment END AS "Description",
       CASE WHEN f.feed IS NULL THEN c_acctbal END AS "Latitude",
       CASE WHEN f.feed IS NULL THEN c_nationkey / 2 END AS "Longitude"
FROM customer LEFT JOIN failed f ON c_custkey // 500 = f.feed
""",
    "incidents_table": """
SELECT regexp_extract(url, '^\\w+://([^/?]*)', 1) AS "Type", page_id / 8 AS "Latitude",
       CAST(NULL AS DOUBLE) AS "Longitude", html AS "Message"
FROM pages
""",
    "envelope_unnest": """
SELECT conv_id, turn, role, line_no, line FROM (
  SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS line,
         CAST(unnest(range(1, len(string_split(text, chr(10))) + 1)) AS BIGINT) AS line_no
  FROM conversations)
""",
    "project_named": """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS absent FROM events
""",
    "project_lenient": """
SELECT event_id, event_type,
       CASE WHEN event_type = 'click' AND value > 100 THEN floor(value) * 1e20
            WHEN event_type = 'click' THEN floor(value) WHEN event_type IN ('view', 'error') THEN NULL ELSE value END
         AS value
FROM events
""",
    "literal_key": "SELECT 'all-events' AS feed, event_id, user_id FROM events",
    "unpivot_columns": """
SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem
""",
    "type_audit": """
SELECT 'event_id' AS field, 'BIGINT' AS json_type, true AS accepted, count(*) AS n FROM events
UNION ALL SELECT 'event_type', 'STRING', true, count(*) FROM events
UNION ALL
SELECT 'value', json_type, json_type IN ('VOID', 'DECIMAL'), count(*) FROM (
  SELECT CASE event_type WHEN 'click' THEN CASE WHEN value > 100 THEN 'WIDE INTEGER' ELSE 'BIGINT' END WHEN 'view' THEN 'STRING' WHEN 'error' THEN 'VOID'
         ELSE 'DECIMAL' END AS json_type FROM events)
GROUP BY json_type
""",
    "pages_until_empty": _UNTIL_EMPTY.format(
        pages="""
  SELECT CAST(event_id // 500 AS VARCHAR) AS feed, event_id % 500 // 20 AS page, event_type = 'error' AS kept,
         event_id, event_type, value FROM events"""
    ),
    "pages_of_hot_feeds": _HOT,
    "hot_feeds_shuffled": _HOT,
    "batch_or_fallback": _TROUBLED
    + """
SELECT * FROM fetched
UNION ALL
SELECT b.feed, e.event_id, e.event_type, e.value
FROM events e JOIN breaks b ON b.feed = CAST(e.event_id // 500 AS VARCHAR)
WHERE b.failed
""",
    "batch_or_empty": _TROUBLED + "SELECT * FROM fetched",
    "batch_counts": _TROUBLED
    + """
SELECT feed, count(*) AS n_rows, count(*) FILTER (event_type = 'error') AS n_errors FROM fetched GROUP BY feed
""",
    "load_counts": _TROUBLED
    + "SELECT count(*) AS n_rows, count(*) FILTER (event_type = 'error') AS n_errors FROM fetched",
    "outcome_reasons": """
WITH pages AS (
  SELECT CAST(event_id // 500 AS VARCHAR) AS feed, event_id % 500 // 10 AS page, min(value) AS low, max(value) AS high,
         count(*) FILTER (event_type IN ('error', 'click')) AS n
  FROM events GROUP BY ALL),
judged AS (
  SELECT feed, CASE WHEN low < 0.2 OR high > 300 THEN 'failed' WHEN n = 0 THEN 'empty' ELSE 'data' END AS outcome,
         CASE WHEN low < 0.2 THEN 'no_answer' WHEN high > 350 THEN 'status' WHEN high > 300 THEN 'malformed' END AS reason
  FROM pages
  UNION ALL SELECT DISTINCT feed, 'empty', NULL FROM pages)
SELECT feed, outcome, reason, count(*) AS n FROM judged GROUP BY ALL
""",
    "incomplete_feeds": """
WITH lost AS (
  SELECT DISTINCT event_id // 500 AS feed FROM events GROUP BY event_id // 500, event_id % 500 // 20
  HAVING min(value) < 0.1),
feeds AS (
  SELECT DISTINCT event_id // 500 AS feed, feed % 7 = 2 OR feed % 5 = 3 OR feed IN (FROM lost) AS incomplete FROM events)
SELECT CAST(feed AS VARCHAR) AS feed, event_id, event_type, value, 'empty' AS policy
FROM events JOIN feeds ON feed = event_id // 500 WHERE NOT incomplete
UNION ALL
SELECT CAST(feed AS VARCHAR), event_id, CASE WHEN incomplete THEN 'kept' ELSE event_type END, value, 'fallback'
FROM events JOIN feeds ON feed = event_id // 500
""",
    "fallback_as_of": """
WITH feeds AS (
  SELECT DISTINCT event_id // 500 AS feed, CASE WHEN feed % 2 = 0 THEN 10 ELSE 20 END AS run, feed % 4 != 0 AS failed FROM events),
snapshots AS (SELECT feed, taken FROM feeds, (VALUES (5), (15), (25)) t(taken) WHERE taken >= 15 OR feed % 7 != 0),
chosen AS (SELECT f.feed, s.taken FROM feeds f ASOF JOIN snapshots s ON f.feed = s.feed AND f.run >= s.taken WHERE f.failed)
SELECT CAST(event_id // 500 AS VARCHAR) AS feed, event_id, event_type, value FROM events WHERE event_id // 500 % 4 = 0
UNION ALL
SELECT CAST(feed AS VARCHAR), event_id, event_type, value + taken * 1000 FROM events JOIN chosen ON feed = event_id // 500
""",
    "requests_to_make": """
WITH pages AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE 'u' || CAST(user_id % 50 AS VARCHAR) END AS feed, event_id // 2 AS page,
         event_type = 'error' AS error FROM events),
wanted AS (SELECT feed, unnest(range(0, max(page) + 1)) AS page FROM pages GROUP BY feed),
missing AS (
  SELECT feed, page FROM wanted ANTI JOIN (SELECT feed, page FROM pages GROUP BY ALL HAVING NOT bool_or(error)) USING (feed, page)),
islands AS (SELECT feed, page, page - row_number() OVER (PARTITION BY feed ORDER BY page) AS run FROM missing)
SELECT feed, min(page) * 500 AS first, count(*) AS n FROM islands GROUP BY feed, run
""",
    "latest_run": """
WITH stale AS (SELECT DISTINCT event_id // 500 AS feed FROM events WHERE feed % 3 = 1 AND event_id % 500 // 20 = 5)
SELECT CAST(event_id // 500 AS VARCHAR) AS feed, event_id, event_type,
       value + CASE WHEN event_id // 500 IN (FROM stale) THEN 0 ELSE 1000 END AS value
FROM events
""",
    "documents_from_files": "SELECT 'customers' AS feed, c_custkey, c_name, c_acctbal FROM customer",
    "csv_scan": "SELECT * FROM orders",
    "csv_audit": """
SELECT malformed, count(*) AS n, any_value(n_prices) AS n_prices, any_value(keys) AS keys
FROM (SELECT o_orderkey % 10 IN (3, 7) AS malformed FROM orders),
     (SELECT count(*) FILTER (o_orderkey % 10 != 3) AS n_prices, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders)
GROUP BY malformed
""",
    "csv_scan_inferred": """
SELECT *, 'o_orderkey int, o_custkey int, o_orderstatus string, o_totalprice double, o_orderdate timestamp, '
       || 'o_orderpriority string' AS types
FROM orders
""",
    "csv_types_kept": """
SELECT printf('%07d', o_orderkey) AS code, strftime(o_orderdate, '%Y-%m') AS month,
       CASE WHEN o_orderkey % 5 > 0 THEN o_custkey::INTEGER END AS custkey, o_orderkey * 10000000000 AS wide,
       CASE WHEN o_orderkey % 3 = 0 THEN o_custkey::DOUBLE ELSE o_totalprice::DECIMAL(12,2)::DOUBLE END AS price,
       'code string, month string, custkey int, wide bigint, price double' AS types
FROM orders
""",
    "months_of_types": """
SELECT CASE WHEN year(o_orderdate) = 1997 THEN printf('%09d', o_orderkey) WHEN year(o_orderdate) < 1997 THEN o_orderkey::VARCHAR
            ELSE (o_orderkey + 5000000000)::VARCHAR END AS code,
       o_custkey::INTEGER AS custkey,
       CASE WHEN year(o_orderdate) < 1997 THEN 'early' WHEN year(o_orderdate) = 1997 THEN '1997' ELSE 'later' END AS load_id,
       'code string, custkey int, load_id string' AS types
FROM orders
""",
    "volume_audit": """
WITH judged AS (
  SELECT *, CASE WHEN p_partkey % 10 IN (7, 9) THEN 'cells' WHEN p_partkey % 10 = 3 THEN 'type' END AS reason FROM part)
SELECT p_partkey, CASE WHEN reason IS NULL THEN p_name END AS p_name, CASE WHEN reason IS NULL THEN p_size END AS p_size,
       CASE WHEN reason IS NULL THEN p_retailprice END AS p_retailprice,
       CASE WHEN reason IS NOT NULL THEN 'part-' || CAST(p_partkey // 500 AS VARCHAR) || '.zip' END AS source, reason,
       count(*) FILTER (reason IS NULL) OVER () AS n_good, count(reason) OVER () AS n_bad
FROM judged
""",
    "records_audit": """
WITH judged AS (
  SELECT *, CASE WHEN event_id % 11 = 0 THEN 'malformed'
                 WHEN event_type = 'click' THEN 'field value: double expected, found '
                      || CASE WHEN value > 100 THEN 'WIDE INTEGER' ELSE 'BIGINT' END
                 WHEN event_type = 'view' THEN 'field value: double expected, found STRING' END AS reason
  FROM events)
SELECT event_id AS source, CASE WHEN reason IS NULL THEN event_type END AS event_type,
       CASE WHEN reason IS NULL AND event_type != 'error' THEN value END AS value, reason,
       count(*) FILTER (reason IS NULL) OVER () AS n_good, count(reason) OVER () AS n_bad
FROM judged
""",
    "archives_opened": "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part",
    "zip_first_member": "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part",
    "archive_by_link": """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
       strftime(o_orderdate - INTERVAL 30 DAY, '%Y%m') AS ym
FROM orders
""",
    "volume_inferred": """
SELECT '00' || CAST(p_partkey // 500 AS VARCHAR) AS feed, p_partkey, p_name, p_brand, p_size, p_retailprice,
       'feed string, p_partkey int, p_name string, p_brand string, p_size int, p_retailprice double' AS types
FROM part
""",
    "signed_links": """
SELECT feed, p_partkey, p_name, p_brand, p_size, p_retailprice FROM part, (VALUES ('first'), ('second')) t(feed)
""",
    "request_keys": """
SELECT feed, skip, feed || '?$skip=' || CAST(skip AS VARCHAR) AS request FROM (
  SELECT c_mktsegment AS feed, unnest(range(0, count(*), 500)) AS skip FROM customer GROUP BY c_mktsegment)
""",
    "month_key": """
SELECT strftime(o_orderdate - INTERVAL 30 DAY, '%Y%m') AS ym,
       strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%Y%m') AS calendar_ym, count(*) AS n
FROM orders GROUP BY ALL
""",
    "table_replace": "SELECT * FROM customer",
    "table_append": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "append_retried": """
SELECT o_orderkey, o_totalprice, o_orderdate, CASE WHEN year(o_orderdate) < 1998 THEN 'old' ELSE 'recent' END AS load_id
FROM orders
""",
    "loads_reconciled": """
WITH loads AS (
  SELECT 'week ' || (day(ts) - 1) // 7 AS load_id, count(*) AS n_rows,
         count(*) FILTER (user_id IS NULL) AS no_user, count(*) FILTER (value IS NULL) AS no_value
  FROM events GROUP BY 1),
usual AS (
  SELECT *, median(n_rows) OVER (ORDER BY load_id ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS usual_rows FROM loads),
cells AS (
  SELECT load_id, 'user_id' AS "column", n_rows, usual_rows, no_user AS n_null FROM usual
  UNION ALL SELECT load_id, 'value', n_rows, usual_rows, no_value FROM usual)
SELECT load_id, "column", n_rows, usual_rows,
       CASE WHEN usual_rows IS NULL THEN 'first' WHEN n_rows < 0.5 * usual_rows THEN 'thin'
            WHEN n_rows > 2 * usual_rows THEN 'thick' ELSE 'usual' END AS verdict,
       n_null, true AS distinct_close, true AS median_close, false AS shifted
FROM cells
""",
    "versions_published": """
SELECT c_custkey, c_name, c_acctbal, 'begun' AS reader FROM customer
UNION ALL SELECT c_custkey, c_name, c_acctbal + 1, 'next' FROM customer
""",
    "preview": "SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10",
    "incremental_load": "SELECT event_id, event_type, value FROM events",
    "incremental_pages": """
SELECT CAST(event_id // 500 AS VARCHAR) AS feed, event_id, event_type,
       value + CASE WHEN event_id // 500 % 3 = 1 THEN 0 ELSE 1000 END AS value
FROM events
""",
    "month_replace": """
SELECT o_orderkey,
       CASE WHEN strftime(o_orderdate, '%Y%m') = '199701' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       strftime(o_orderdate, '%Y%m') AS ym
FROM orders
""",
}
