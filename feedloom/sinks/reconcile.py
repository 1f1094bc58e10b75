"""What each load of a table held, gathered as it was written, against the loads before it.

A measure is a column's NULLs, a sketch of its distinct values and one of its quantiles.
All are gathered by the pass that writes the load and kept in its ledger entry, some
kilobytes a column however large the load; sketches of loads merge, so that a load is
held against all before it without reading their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType
from pyspark.sql.window import Window

from feedloom.sinks.commits import records

#: Base-2 logarithm of the distinct sketch's registers: a standard error of 1.04 / 2 ** 6, 1.6 percent.
DISTINCT_BITS = 12
#: Size of the quantile sketch: ranks are within 1.7 percent of the true ones in 99 of 100 cases.
QUANTILE_SIZE = 200
#: Loads before a load whose median row count is the usual one.
HISTORY = 12
MEASURE = "nulls: bigint, distinct: string, quantiles: string"
MEASURED = f"load_id string, attempt string, n_rows bigint, added_at double, measures map<string, struct<{MEASURE}>>"


def measuring(schema: StructType, columns: tuple[str, ...]) -> dict[str, Column]:
    """The aggregates of the measured columns, by the name that an observation gives them."""
    found = {}
    for at, name in enumerate(columns):
        cell = F.col(f"`{name}`")
        found[f"nulls-{at}"] = F.count_if(cell.isNull())
        found[f"distinct-{at}"] = F.hll_sketch_agg(cell.cast("string"), DISTINCT_BITS)
        if isinstance(schema[name].dataType, NumericType):
            found[f"quantiles-{at}"] = F.kll_sketch_agg_double(cell.cast("double"), QUANTILE_SIZE)
    return found


def measures(schema: StructType, columns: tuple[str, ...], seen: dict) -> dict[str, dict]:
    """The measures as a ledger entry holds them, from what the write observed."""

    def text(value: bytes | None) -> str | None:
        return None if value is None else bytes(value).hex()

    return {
        name: {
            "nulls": seen[f"nulls-{at}"],
            "distinct": text(seen[f"distinct-{at}"]),
            "quantiles": text(seen.get(f"quantiles-{at}")),
        }
        for at, name in enumerate(columns)
    }


def load_verdicts(spark: SparkSession, path: str, low: float = 0.5, high: float = 2.0, history: int = HISTORY) -> DataFrame:
    """One row per load: load_id, n_rows, usual_rows, verdict ('first', 'thin', 'thick' or 'usual').

    Usual is the median row count of up to `history` loads before it, empty ones included; a load of
    under `low` times as many rows is thin, one of over `high` times thick. Only the ledger is read.
    """
    before = Window.orderBy("added_at", "load_id").rowsBetween(-history, -1)  # a row a load
    loads = records(spark, f"{path}/loads", MEASURED)
    held = loads.select("load_id", "n_rows", F.percentile("n_rows", F.lit(0.5)).over(before).alias("usual_rows"))
    verdict = (
        F.when(F.col("usual_rows").isNull(), "first")
        .when(F.col("n_rows") < low * F.col("usual_rows"), "thin")
        .when(F.col("n_rows") > high * F.col("usual_rows"), "thick")
        .otherwise("usual")
    )
    return held.withColumn("verdict", verdict)


def column_measures(spark: SparkSession, path: str, shift: float = 0.25) -> DataFrame:
    """One row per load and measured column, from the sketches alone.

    load_id, column, n_rows, n_null, n_distinct and median (estimates), seen_before (distinct
    values of all loads before it), fresh (those that this load adds to them), usual_low and
    usual_high: the quantiles `shift` below and above the median of all values before it.
    `shifted` says that its own median is outside these. NULL is what a column that is no
    number, or holds none here or before, cannot give.
    """
    loads = records(spark, f"{path}/loads", MEASURED)
    held = loads.select("load_id", "added_at", "n_rows", F.explode("measures").alias("column", "m")).select(
        "load_id",
        "added_at",
        "n_rows",
        "column",
        F.col("m.nulls").alias("n_null"),
        F.unhex("m.distinct").alias("distinct"),
        F.unhex("m.quantiles").alias("quantiles"),
    )
    own = Window.partitionBy("column").orderBy("added_at", "load_id")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        "*",
        F.hll_union_agg("distinct").over(before).alias("distinct_before"),
        F.hll_union_agg("distinct").over(own.rowsBetween(Window.unboundedPreceding, 0)).alias("distinct_so_far"),
        F.kll_merge_agg_double("quantiles").over(before).alias("quantiles_before"),
    )

    def quantile(sketch: str, rank: float) -> Column:
        """A quantile of a sketch, which has none to give without values."""
        return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(rank)))

    held = held.select(
        "*",
        quantile("quantiles", 0.5).alias("median"),
        F.hll_sketch_estimate("distinct_before").alias("seen_before"),
        quantile("quantiles_before", 0.5 - shift).alias("usual_low"),
        quantile("quantiles_before", 0.5 + shift).alias("usual_high"),
    )
    return held.select(
        "load_id",
        "column",
        "n_rows",
        "n_null",
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
        "median",
        "seen_before",
        F.greatest(F.hll_sketch_estimate("distinct_so_far") - F.col("seen_before"), F.lit(0)).alias("fresh"),
        "usual_low",
        "usual_high",
        ((F.col("median") < F.col("usual_low")) | (F.col("median") > F.col("usual_high"))).alias("shifted"),
    )
