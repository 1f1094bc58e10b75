"""Quality rules: counts within each document, and line frequency across the documents of a host.

Lines are normalised (A-Z lowered, digit runs as 0, white space as one space) and hashed;
per host the distinct documents with each line are counted. Lines above the host's limit
are removed, and a document that loses most of its words that way is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from feedloom.llm.common import whole_row
from feedloom.llm.slices import by_slices
from feedloom.workspace import settle

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line is above its host's limit when more than LIMIT_DOCS documents and LIMIT_PERCENT of the host's have it.
LIMIT_DOCS = 10
LIMIT_PERCENT = 5
#: A document is depleted when removed lines held more than this part of its words.
DEPLETED_PERCENT = 50

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
DIGITS = re.compile(rb"[0-9]+")

PROFILE = (
    StructType()
    .add("n_words", LongType())
    .add("word_chars", LongType())
    .add("n_symbols", LongType())
    .add("n_dup_lines", LongType())
    .add("n_repeat_words", LongType())
    .add("lines", ArrayType(StructType().add("line", LongType()).add("words", LongType())))
)

LINES = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))


def line_hash(line: bytes) -> int:
    """A signed 64-bit hash of a line already lowered and without digit runs."""
    return xxhash.xxh3_64_intdigest(b" ".join(line.split())) - (1 << 63)


def normalised(data: bytes) -> bytes:
    return DIGITS.sub(b"0", data.lower())


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more, the first finding included."""
    if len(words) < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(word, len(index)) for word in words])
    pairs = ids[:-1] * len(index) + ids[1:]
    if len(index) > 1_000_000:  # three ids would not fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(index) + ids[2:]
    ordered = np.sort(windows)
    repeats = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(repeats):
        return 0
    found = np.isin(windows, repeats)
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift : shift + len(found)] |= found
    return int(inside.sum())


def profile(text: str | None) -> tuple:
    data = (text or "").encode()
    words = data.split()
    lines = data.split(b"\n")
    filled = [line for line in lines if line and not line.isspace()]
    spaces = len(data) - len(data.translate(None, SPACE))
    counted: dict[int, int] = {}
    for line in normalised(data).split(b"\n"):
        size = len(line.split())
        if size:
            key = line_hash(line)
            counted[key] = counted.get(key, 0) + size
    return (
        len(words),
        len(text or "") - spaces,
        len(data) - len(data.translate(None, SYMBOLS)),
        len(filled) - len(set(filled)),
        repeated_words(words),
        [{"line": key, "words": size} for key, size in counted.items()],
    )


@F.arrow_udf(PROFILE)
def profiles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    def compute(texts: list[str | None]) -> pa.Array:
        *counts, lines = zip(*map(profile, texts))
        flat = [line for found in lines for line in found]
        line_type = LINES.value_type
        fields = [pa.array([line[name] for line in flat], pa.int64()) for name in ("line", "words")]
        ends = np.cumsum([0, *map(len, lines)])
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(line_type)))
        return pa.StructArray.from_arrays([*[pa.array(c, pa.int64()) for c in counts], listed], PROFILE.names)

    kind = pa.struct([*[(name, pa.int64()) for name in PROFILE.names[:-1]], (PROFILE.names[-1], LINES)])
    yield from by_slices(batches, compute, kind)


@F.arrow_udf(StringType())
def without_lines(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The texts without their lines whose hash is listed; a text with none listed stays as it is."""

    def cleaned(text: str | None, listed: list[int] | None) -> str | None:
        if text is None or not listed:
            return text
        drop = set(listed)
        lines = text.split("\n")
        plain = normalised(text.encode()).split(b"\n")
        return "\n".join(line for line, key in zip(lines, plain) if not key.split() or line_hash(key) not in drop)

    yield from by_slices(batches, lambda texts, removed: list(map(cleaned, texts, removed)), pa.string())


def text_hash(column: Column) -> Column:
    return F.xxhash64(F.coalesce(column, F.lit("")))


def profiled(docs: DataFrame, doc_id: str, host: str, text: str) -> DataFrame:
    """(doc_id, host, text_hash, counts, lines) of every document, written once: no text is kept."""
    source = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{host}`").alias("host"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    found = source.select("doc_id", "host", text_hash(F.col("text")).alias("text_hash"), profiles("text").alias("p"))
    return settle(found.select("doc_id", "host", "text_hash", "p.*"), "quality-profiles")


def frequent_lines(profiles: DataFrame, limit_docs: int = LIMIT_DOCS, limit_percent: int = LIMIT_PERCENT) -> DataFrame:
    """(host, text_hash, line, words): the lines to remove from the texts of each host.

    Documents with equal texts count once. All counts are combined before their shuffle.
    """
    lines = (
        profiles.select("host", "text_hash", F.inline("lines"))
        .groupBy("host", "line", "text_hash")
        .agg(F.max("words").alias("words"))
    )
    hosts = (
        profiles.groupBy("host", "text_hash")
        .agg(F.lit(1).alias("one"))
        .groupBy("host")
        .agg(F.count("*").alias("n_docs"))
    )
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > limit_docs)
    above = (
        counts.join(hosts.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
        .where(F.col("n") * 100 > F.col("n_docs") * limit_percent)
        .select(F.col("host").alias("of"), F.col("line").alias("above"))
    )
    return lines.join(above, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("above"))).select(
        "host", "text_hash", "line", "words"
    )


def judge(
    docs: DataFrame,
    doc_id: str = "doc_id",
    host: str = "source",
    text: str = "text",
    limit_docs: int = LIMIT_DOCS,
    limit_percent: int = LIMIT_PERCENT,
    depleted_percent: int = DEPLETED_PERCENT,
) -> DataFrame:
    """One row per document: its counts, removed_lines (hashes), n_removed_words, base_failed, kept.

    `kept` is false for a document that fails the base rules or is depleted. A null or
    empty text has zero counts and fails. A null host is a host of its own. Repeated rows
    and equal ids each give their row. Columns of other names are not looked at. Texts go
    once through one narrow pass; what is shuffled are line hashes.
    """
    found = profiled(docs, doc_id, host, text)
    removed = (
        frequent_lines(found, limit_docs, limit_percent)
        .groupBy("host", "text_hash")
        .agg(F.sum("words").alias("lost"), F.collect_list("line").alias("removed"))
        .withColumnsRenamed({"host": "of", "text_hash": "hash_of"})
    )
    judged = found.drop("lines").join(
        removed, F.col("host").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("hash_of")), "left"
    )
    lost = F.coalesce("lost", F.lit(0)).cast("bigint")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return judged.select(
        "doc_id",
        "host",
        "text_hash",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed_lines"),
        lost.alias("n_removed_words"),
        failed.alias("base_failed"),
        (~failed & (lost * 100 <= F.col("n_words") * depleted_percent)).alias("kept"),
    )


def apply_rules(docs: DataFrame, host: str = "source", text: str = "text", **limits) -> DataFrame:
    """The kept documents with all their columns, their lines above limits removed.

    A verdict depends on a document's host and text alone, so copies share it.
    """
    own = docs.select(
        whole_row(docs),
        F.col(f"`{host}`").alias("own_host"),
        text_hash(F.col(f"`{text}`")).alias("own_hash"),
    )
    named = docs.select(
        F.lit(None).cast("bigint").alias("doc_id"), F.col(f"`{host}`").alias("source"), F.col(f"`{text}`").alias("text")
    )
    by_text = (
        judge(named, **limits).where("kept").groupBy("host", "text_hash").agg(F.max("removed_lines").alias("removed"))
    )
    joined = own.join(by_text, F.col("own_host").eqNullSafe(F.col("host")) & (F.col("own_hash") == F.col("text_hash")))
    before = F.col("row")[text]
    after = F.when(F.size("removed") > 0, without_lines(before, F.col("removed"))).otherwise(before)
    return joined.select(*[after.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
