"""Zip archives held as (path, content) rows, or named by their paths and opened by the tasks."""

from __future__ import annotations

import codecs
import csv
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom.sources.streams import opened

# Text that leaves a task as one row, cut at the last line's end.
BLOCK_BYTES = 4 * 1024 * 1024


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archive files as (path, content), one row per file."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archive files as `path` alone, for `first_member_lines` to open: of any size, where a cell ends at 2 GB."""
    return spark.read.format("binaryFile").load(path).select("path")


def first_member_lines(
    archives: DataFrame,
    columns: list[str] | None,
    *keep: str,
    seen: Observation | None = None,
    number: str | None = None,
) -> DataFrame:
    """One `line` row per data line of each archive's first member, with its place in the member under `number`, if any.

    `columns` is the header the member must have; without it any header will do, and
    `seen` tells `shared_header` of it. `keep` names string columns of `archives` to carry
    along. Python only inflates and cuts blocks of a few MB; lines are split by Spark. One
    archive is one task's work, since a zip stream cannot be split, and a task holds one
    block of it, and its `content` if the archives have that column. Without it the task
    opens the path (`streams.opened`) and reads the member as a stream.
    """
    names = list(dict.fromkeys(("path", *keep)))
    blocks = _expand(archives, names, columns)
    if seen is not None:
        blocks = blocks.observe(seen, F.min("header").alias("first"), F.max("header").alias("last"))
    split = F.split("block", "\r\n|[\r\n]")
    if number is None:
        lines = blocks.select(*keep, F.explode(split).alias("line"))
    else:
        lines = blocks.select(*keep, "before", F.posexplode(split).alias("_at", "line"))
        lines = lines.select(*keep, (F.col("before") + F.col("_at") + 1).alias(number), "line")
    return lines.where(F.rlike("line", F.lit(r"[^\s\p{Z}\x1c-\x1f\x85]")))


def shared_header(seen: Observation) -> list[str]:
    """The column names in the header lines that were seen, which must be all alike."""
    headers = sorted({seen.get["first"], seen.get["last"]} - {None})
    if len(headers) != 1:
        raise ValueError(f"archives must share one header, found {headers or 'none'}")
    return next(csv.reader(headers))


def _expand(archives: DataFrame, names: list[str], columns: list[str] | None) -> DataFrame:
    """`names`, the header line and the blocks of data lines of each first member, one block at least."""
    texts = [(name, pa.string()) for name in (*names, "header")]
    schema = pa.schema([*texts, ("before", pa.int64()), ("block", pa.large_string())])
    by_path = "content" not in archives.columns
    if by_path:  # An archive a task: rows as narrow as these would be put together in a few.
        archives = archives.repartition(max(1, archives.count()), "path")

    # Nested, so that they travel to the executors with `expand`.
    def source(batch: pa.RecordBatch, row: int) -> pa.NativeFile:
        if not by_path:
            return pa.BufferReader(batch.column("content")[row].as_buffer())
        fs, inner = opened(batch.column("path")[row].as_py())
        return fs.open_input_file(inner)

    def blocks(file: pa.NativeFile) -> Iterator[str]:
        """The member's text in blocks that end with a line, the last one as it is."""
        with file, zipfile.ZipFile(file) as archive:
            with archive.open(archive.namelist()[0]) as member:
                decode = codecs.getincrementaldecoder("utf-8-sig")("replace").decode
                held: list[str] = []
                while data := member.read(BLOCK_BYTES):
                    text = decode(data)
                    # A carriage return may be half of a line's end, so it cannot be the last of a block.
                    cut = max(text.rfind("\n"), text.rfind("\r", 0, max(len(text) - 1, 0))) + 1
                    if cut:
                        yield "".join([*held, text[:cut]])
                        held = [text[cut:]]
                    else:
                        held.append(text)
                yield "".join([*held, decode(b"", True)])

    def ends(text: str) -> int:
        """Line ends in a text."""
        return text.count("\n") + text.count("\r") - text.count("\r\n")

    def member_blocks(file: pa.NativeFile, path: str) -> Iterator[tuple[str, int, str]]:
        """The header line, the first with more than white space, and what follows it with the lines before."""
        header, before = None, 0
        for block in blocks(file):
            if header is None:
                found = next((line for line in re.finditer("[^\r\n]+", block) if line[0].strip()), None)
                if found is None:
                    before += ends(block)
                    continue
                header = found[0]
                check(path, next(csv.reader([header]), []))
                before += ends(block[: found.end()])
                block = block[found.end() :]
            yield header, before, block
            before += ends(block)
        if header is None:
            check(path, [])
            yield "", 0, ""

    def check(path: str, header: list[str]) -> None:
        if columns is not None and header != columns:
            raise ValueError(f"{path}: header {header} is not the declared {columns}")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            carried = [batch.column(name) for name in names]
            for row in range(batch.num_rows):
                fixed = [column[row].as_py() for column in carried]
                for header, before, block in member_blocks(source(batch, row), fixed[0]):
                    arrays = [pa.array([value], pa.string()) for value in (*fixed, header)]
                    arrays += [pa.array([before], pa.int64()), pa.array([block], pa.large_string())]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    ddl = ", ".join(f"`{name}` {'bigint' if name == 'before' else 'string'}" for name in schema.names)
    held = names if by_path else [*names, "content"]
    return archives.select(*held).mapInArrow(expand, ddl)


def stage_lines(lines: DataFrame, path: str, partition: str, rebalance: bool = True) -> None:
    """Keep extracted lines as text under path/partition=…, the replayable raw input.

    Partitions staged earlier stay unless staged again. The rebalance lets Spark split
    a partition value that holds much of the data; without it nothing is shuffled, and
    each task writes a file per value it has.
    """
    staged = lines.select(partition, F.col("line").alias("value"))
    if rebalance:
        staged = staged.hint("rebalance", partition)
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).text(path)
