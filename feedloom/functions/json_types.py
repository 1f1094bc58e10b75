"""JSON value types, read from VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON types a declared Spark type takes without conversion. A string field takes
# anything as its text, so it has no entry.
ACCEPTED = {
    "double": ("DECIMAL", "DOUBLE", "FLOAT"),
    "bigint": ("BIGINT",),
    "int": ("BIGINT",),
    "boolean": ("BOOLEAN",),
}


WIDEST = 9_223_372_036_854_775_807


def json_type(value: Column) -> Column:
    """BIGINT, WIDE INTEGER, DECIMAL, DOUBLE, STRING, BOOLEAN, OBJECT, ARRAY, or VOID for null and absent.

    An integer beyond 64 bits is read as a decimal without a fraction, and told by its
    size from one like 1.0. One of more than 38 digits is read as a double and cannot be
    told from it.
    """
    described = F.schema_of_variant(value)
    bare = F.substring_index(F.substring_index(described, "(", 1), "<", 1)
    whole = described.startswith("DECIMAL") & described.endswith(",0)")
    wide = whole & (F.abs(F.try_variant_get(value, "$", "decimal(38,0)")) > WIDEST)
    return F.coalesce(F.when(wide, "WIDE INTEGER").otherwise(bare), F.lit("VOID"))


def accepts(declared: str, found: Column) -> Column:
    allowed = ACCEPTED.get(declared)
    if allowed is None:
        return F.lit(True)
    return found.isin("VOID", *allowed)


def strict_double(value: Column, name: str) -> Column:
    """The variant as a double; integers, text and anything else stop the job."""
    found = json_type(value)
    return F.when(accepts("double", found), F.variant_get(value, "$", "double")).otherwise(
        F.raise_error(F.concat(F.lit(f"field {name}: double expected, found "), found))
    )
