"""Helpers the operators share: rows as one column, gapless numbers, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedloom.operators.lookup import BROADCAST_BYTES, width
from feedloom.workspace import settle

#: Rows of a group that one task numbers.
NUMBERED_ROWS = 200_000


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no added name can clash with them; `row.*` takes them out."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("row")


def numbered(df: DataFrame, group: list[str], order: list[str], rows: int = NUMBERED_ROWS) -> DataFrame:
    """`df`, a settled table, with `slot`: gapless numbers from 0 within each group.

    A group is cut by a hash of its `order` columns into parts of about `rows` rows; parts
    are counted first, and each numbers its own rows from the sum of those before it. So
    no task gets a whole group, however large.
    """
    parts = max(1, -(-df.count() // rows))
    cut = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*group, "_part")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    within = Window.partitionBy(*group, "_part").orderBy(*order)
    placed = cut.withColumn("_own", F.row_number().over(within) - 1).join(offsets, [*group, "_part"])
    return placed.withColumn("slot", F.col("_before") + F.col("_own")).drop("_part", "_before", "_own")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the edges (a, b).

    Alternates large and small stars until every node hangs on a root and on that alone.
    Each round is joins and minimums over narrow rows, written to the shared folder;
    nothing but one row of a test reaches the driver.
    """

    def ended(df: DataFrame) -> bool:
        heads = df.select(F.col("b").alias("a"), F.lit(True).alias("is_head")).distinct()
        counted = df.groupBy("a").agg(F.count("*").alias("n")).join(heads, "a", "left")
        return counted.where("n > 1 OR is_head").isEmpty()

    larger = F.greatest("a", "b").alias("a")
    smaller = F.least("a", "b").alias("b")
    edges = settle(edges.where("a != b").select(larger, smaller).distinct(), "edges")
    while not ended(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = settle(large.distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = settle(small.unionByName(least.withColumnRenamed("least", "b")).distinct(), "small-star")
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def sized_join(rows: DataFrame, lookup: DataFrame, on, how: str = "inner", limit: int = BROADCAST_BYTES) -> DataFrame:
    """rows ⋈ lookup, a settled table: broadcast where its measured size is within `limit`.

    Beyond it both sides are shuffled and merged, and Spark splits hot keys at run time.
    """
    small = width(lookup) <= limit
    return rows.join(F.broadcast(lookup) if small else lookup.hint("merge"), on, how)
