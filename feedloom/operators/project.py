"""Records projected to a declared schema by name, and the audit of their JSON types.

Strict, a double field takes only JSON numbers with a fraction or an exponent; an
integer, a quoted number or anything else stops the job when the column is read.
Otherwise parser rules apply: 1 becomes 1.0 and a mistyped value NULL. Unknown keys
vanish and missing keys are NULL either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType, VariantType

from feedloom.functions.json_types import accepts, json_type, strict_double
from feedloom.operators.envelope import unnest


def read_as(schema: StructType, strict: bool) -> StructType:
    """The schema to parse with: strict doubles are read as variants to see their JSON type."""
    read = StructType()
    for field in schema.fields:
        checked = strict and isinstance(field.dataType, DoubleType)
        read = read.add(field.name, VariantType() if checked else field.dataType)
    return read


def declared_columns(row: Column, schema: StructType, strict: bool) -> list[Column]:
    """The declared columns of a record that was read with `read_as`."""
    return [
        (
            strict_double(row[field.name], field.name)
            if strict and isinstance(field.dataType, DoubleType)
            else row[field.name]
        ).alias(field.name)
        for field in schema.fields
    ]


def project_documents(
    responses: DataFrame,
    schema: StructType,
    *keep: Column | str,
    field: str = "value",
    on_failure: str = "raise",
    strict: bool = True,
    seen: Observation | None = None,
) -> DataFrame:
    """Declared columns of the responses' records, from body to columns in one parse.

    `on_failure` and `seen` are those of `unnest`.
    """
    records = unnest(responses, read_as(schema, strict), field, on_failure, strict, seen)
    return records.select(*keep, *declared_columns(F.col("record"), schema, strict))


def type_audit(
    responses: DataFrame, schema: StructType, field: str = "value", on_failure: str = "raise"
) -> DataFrame:
    """(field, json_type, accepted, n): the JSON types each declared field really holds.

    Counted per combination of types first, so the rows are not multiplied by the fields.
    """
    variants = StructType()
    for declared in schema.fields:
        variants = variants.add(declared.name, VariantType())
    types = unnest(responses, variants, field, on_failure).select(
        *[json_type(F.col("record")[f.name]).alias(f.name) for f in schema.fields]
    )
    combined = types.groupBy(*schema.names).agg(F.count(F.lit(1)).alias("_n"))
    found = combined.select(
        "_n",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(f.name).alias("field"),
                        F.col(f"`{f.name}`").alias("json_type"),
                        accepts(f.dataType.simpleString(), F.col(f"`{f.name}`")).alias("accepted"),
                    )
                    for f in schema.fields
                ]
            )
        ).alias("_found"),
    )
    return found.select("_found.*", "_n").groupBy("field", "json_type", "accepted").agg(F.sum("_n").alias("n"))
