"""CSV files and CSV lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feedloom.workspace import settle

MALFORMED = "_malformed"


def _by_header(spark: SparkSession, path: str, schema: StructType | str, header: bool) -> tuple[DataFrame, StructType]:
    """Every column of the files, the declared ones typed, and the text of rows that do not fit."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = spark.read.csv(path, header=True).columns if header else declared.names
    missing = sorted(set(declared.names) - set(names))
    if missing:
        raise ValueError(f"columns not in the header of {path}: {missing}")
    types = {field.name: field.dataType for field in declared.fields}
    found = StructType()
    for name in names:
        found = found.add(name, types.get(name, StringType()))
    reader = spark.read.option("columnPruning", False)  # else cells too many go unseen
    rows = reader.csv(
        path,
        schema=found.add(MALFORMED, StringType()),
        header=header,
        enforceSchema=not header,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=MALFORMED,
    )
    # A cell is converted, and found wrong, only where its column is used, so a malformed row's text uses them all.
    every = F.xxhash64(*[f"`{name}`" for name in names]).cast("string")
    text = F.when(F.col(MALFORMED).isNotNull(), F.concat(MALFORMED, F.left(every, F.lit(0))))
    return rows.withColumn(MALFORMED, text), declared


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    strict: bool = True,
) -> DataFrame:
    """CSV scan; the columns of a declared schema are taken by name where there is a header.

    A row with a cell that is not of its type, or with more or fewer cells than the
    header, stops the job; unless `strict` it has NULLs there. Columns that are not
    declared are left out. Without a schema the types are inferred, which reads the data
    twice and can change values (01012 becomes 1012): declare one where it is known, or use
    `infer_csv`.
    """
    if schema is None:
        return spark.read.csv(path, header=header, inferSchema=True)
    rows, declared = _by_header(spark, path, schema, header)
    columns = [F.col(f"`{name}`") for name in declared.names]
    if not strict:
        return rows.select(*columns)
    stop = F.raise_error(F.concat(F.lit("malformed row: "), F.col(MALFORMED)))
    return rows.where(F.when(F.col(MALFORMED).isNull(), F.lit(True)).otherwise(stop)).select(*columns)


def csv_audit(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """(malformed, n, example): the rows that fit the declared schema, and those that do not with one of them."""
    rows, _ = _by_header(spark, path, schema, header)
    return rows.groupBy(F.col(MALFORMED).isNotNull().alias("malformed")).agg(
        F.count(F.lit(1)).alias("n"), F.min(MALFORMED).alias("example")
    )


def judge_lines(lines: DataFrame, schema: str, *keep: Column | str, reason: str = "reason") -> DataFrame:
    """`keep`, the typed columns of a `line` column, and why a line does not fit them, or NULL.

    A line with more or fewer cells than the schema is "cells", one with a cell that is not
    of its type "type"; its columns are NULL where it does not fit.
    """
    declared = StructType.fromDDL(schema)
    text = StructType()
    for field in declared.fields:
        text = text.add(field.name, StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}

    def parsed(kind: StructType) -> Column:
        own = StructType([*kind.fields, StructField(MALFORMED, StringType())])
        return F.from_csv("line", F.lit(own.toDDL()), options)

    # Read as text for a line that does not fit only: are the cells too many or too few?
    cells = F.exists(F.array(parsed(text)), lambda row: row[MALFORMED].isNotNull())
    found = lines.withColumn("_parsed", parsed(declared))
    why = F.when(F.col("_parsed")[MALFORMED].isNotNull(), F.when(cells, "cells").otherwise("type"))
    columns = [F.col("_parsed")[name].alias(name) for name in declared.names]
    return found.select(*keep, *columns, why.alias(reason))


def parse_lines(lines: DataFrame, schema: str, *keep: Column | str, strict: bool = True) -> DataFrame:
    """`keep` and typed columns from a `line` column, by the rules of a CSV scan.

    A line with a cell that is not of its type, or with more or fewer cells than the
    schema, stops the job; unless `strict` it has NULLs there. `judge_lines` tells them apart.
    """
    judged = judge_lines(lines.withColumn("_line", F.col("line")), schema, "_line", *keep, reason="_reason")
    if strict:
        text = F.concat(F.lit("malformed line ("), F.col("_reason"), F.lit("): "), F.col("_line"))
        judged = judged.where(F.when(F.col("_reason").isNull(), F.lit(True)).otherwise(F.raise_error(text)))
    return judged.drop("_line", "_reason")


# What a cell can be read as without a change; a column's cells are merged by or.
WHOLE, WIDE, REAL, TEXT = 1, 2, 4, 8


def cell_kind(cell: Column | str) -> Column:
    """What a cell of text is: nothing, an integer or a wide one as it is written, a real number, or text.

    An integer must be written as its number is (01012 and +5 are text). A real number has no
    leading zeros and 15 digits at most, which a double holds without a change of its value.
    """
    cell = F.col(cell) if isinstance(cell, str) else cell
    digits = F.length(F.regexp_replace(F.regexp_replace(cell, r"[eE].*|[-.]", ""), "^0+", ""))
    real = F.rlike(cell, F.lit(r"^-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][-+]?[0-9]{1,2})?$")) & (digits <= 15)
    return (
        F.when(cell.isNull(), 0)
        .when(cell == cell.try_cast("int").cast("string"), WHOLE)
        .when(cell == cell.try_cast("bigint").cast("string"), WIDE)
        .when(real, REAL)
        .otherwise(TEXT)
    )


def kind_type(kinds: int | None, nothing: str = "string") -> str:
    """The type that holds all cells of these kinds unchanged; `nothing` where there are none."""
    kinds = kinds or 0
    if kinds == 0:
        return nothing
    if kinds & TEXT or (kinds & REAL and kinds & WIDE):
        return "string"
    if kinds & REAL:
        return "double"
    return "bigint" if kinds & WIDE else "int"


def infer_lines(lines: DataFrame, names: list[str], *keep: str, nothing: str = "string") -> DataFrame:
    """`keep` and the columns `names` of a `line` column, typed by what all of their cells can be.

    No value changes: a column is a number only if each of its cells is one as it is
    written, so codes, months and dates stay text. The lines are read once: cells are kept
    as text while their kinds are merged on the way, and cast when they are read. A line
    with more or fewer cells than names stops the job. A column without any cell is text, or
    of the type `nothing`: "void" lets other loads of a table decide.
    """
    text = ", ".join(f"`{name}` string" for name in names)
    return _typed(parse_lines(lines, text, *keep), names, nothing)


def _typed(cells: DataFrame, names: list[str], nothing: str = "string") -> DataFrame:
    """The frame with the columns `names`, text so far, cast to what all of their cells can be; read once."""
    seen = Observation()
    kinds = [F.bit_or(cell_kind(F.col(f"`{name}`"))).alias(f"k{at}") for at, name in enumerate(names)]
    kept = settle(cells.observe(seen, *kinds), "cells")
    types = {name: kind_type(seen.get[f"k{at}"], nothing) for at, name in enumerate(names)}

    def typed(name: str, kind: str) -> Column:
        return F.lit(None) if kind == "void" else F.col(f"`{name}`").cast(kind)

    return kept.select(*[typed(name, types.get(name, kind)).alias(name) for name, kind in kept.dtypes])


def infer_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """A CSV scan whose types are inferred without changing a value, by the rules of `infer_lines`."""
    names = spark.read.csv(path, header=header).columns
    text = ", ".join(f"`{name}` string" for name in names)
    return _typed(read_csv(spark, path, text, header), names)
