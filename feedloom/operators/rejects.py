"""Good rows and bad ones told apart in one pass, with counts that add up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from feedloom.functions.json_types import accepts, json_type
from feedloom.operators.envelope import MALFORMED, PARSER, classify, first_document, parsed_body
from feedloom.operators.project import declared_columns, read_as
from feedloom.workspace import new_path

#: The columns of a bad row: where it came from, its place there, its text, and why it is bad.
PLACE = ("source", "position", "raw", "reason")


@dataclass(frozen=True)
class Apart:
    """The rows without a reason, those with one, and how many of each."""

    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: int


def set_apart(judged: DataFrame) -> Apart:
    """The typed columns of the rows without a `reason`, and (source, position, raw, reason) of the others.

    Written once, in two partitions of one table, so that the input is read once and a good
    row's text, which nothing needs any more, is not kept.
    """
    spark, seen = judged.sparkSession, Observation()
    bad = F.col("reason").isNotNull()
    path = new_path(spark, "judged")
    kept = judged.observe(seen, F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
    kept = kept.withColumn("raw", F.when(bad, F.col("raw"))).withColumn("_bad", bad)
    kept.write.partitionBy("_bad").parquet(path)
    read = spark.read.schema(f"{judged.schema.toDDL()}, _bad boolean").parquet(path)
    columns = [f"`{name}`" for name in judged.columns if name not in PLACE]
    return Apart(
        read.where("NOT _bad").select(*columns), read.where("_bad").select(*PLACE), seen.get["good"], seen.get["bad"]
    )


def judge_records(responses: DataFrame, schema: StructType, field: str = "value", strict: bool = True) -> DataFrame:
    """(source, position, raw, reason) and the declared columns of every record of the responses.

    The source is the feed, the position the record's place in its document from 0. A failed
    response is one row without a position, with its body and the reason that `classify`
    gives. A record of another shape or type is "record", and where doubles are `strict` one
    with another JSON type in a double field names the field and the type found. Rows with a
    reason have NULL columns. No response and no record stops the job, but for a body that
    is nested too deep to be read, which is a row with the reason over_limit.
    """
    judged = classify(responses, field)
    records = first_document(parsed_body(field, StringType()))[field]
    row = "struct<position:bigint,raw:string,why:string>"
    failed = F.array(F.struct(F.lit(None), F.col("body"), F.col("reason")).cast(row))
    found = F.transform(records, lambda text, at: F.struct(at.cast("bigint"), text, F.lit(None)).cast(row))
    rows = judged.select(
        F.col("feed").alias("source"), F.explode(F.when(F.col("outcome") == "failed", failed).otherwise(found)).alias("_row")
    ).select("source", "_row.*")
    read = read_as(schema, strict)
    parsed = rows.withColumn("_record", F.from_json("raw", read.add(MALFORMED, StringType()), PARSER))
    record = F.col("_record")
    reason = F.coalesce(F.col("why"), F.when(record[MALFORMED].isNotNull(), "record"))
    for declared in schema.fields:
        if strict and isinstance(declared.dataType, DoubleType):
            kind = json_type(record[declared.name])
            text = F.concat(F.lit(f"field {declared.name}: double expected, found "), kind)
            reason = F.coalesce(reason, F.when(record.isNotNull() & ~accepts("double", kind), text))
    judged = parsed.withColumn("reason", reason)
    good = F.when(F.col("reason").isNull(), record)
    return judged.select(*PLACE, *declared_columns(good, schema, strict))
