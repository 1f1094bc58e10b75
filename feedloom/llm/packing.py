"""Packing documents into token-budget batches of optimal length buckets.

Token sequences of all documents are counted into one global histogram of lengths;
dynamic programming over it chooses the bucket boundaries with the least padding. Inside
each bucket batches are filled up to a token budget.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import numbered
from feedloom.llm.slices import by_slices
from feedloom.workspace import settle

MAX_LENGTH = 2048
BUCKETS = 8
BATCH_TOKENS = 32_768
#: Runs of white space from this length on are encoded by themselves.
LONG_SPACE = regex.compile(r"\p{White_Space}{4096,}")


def encoding(vocabulary: str, pattern: str) -> tiktoken.Encoding:
    with open(vocabulary, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode(vocabulary: tiktoken.Encoding, text: str | None) -> np.ndarray:
    """The ids of a text; long white space is cut out, where the library's splitter would run out of stack.

    All of such a run but its last character is one pre-token, and that one belongs to what follows.
    """
    if not text:
        return np.empty(0, np.int32)
    found, at = [], 0
    for run in LONG_SPACE.finditer(text):
        last = run.end() - (run.end() < len(text))
        found += [vocabulary.encode_ordinary(text[at : run.start()]), vocabulary._encode_single_piece(text[run.start() : last])]
        at = last
    found.append(vocabulary.encode_ordinary(text[at:]))
    return np.concatenate([np.array(part, np.int32) for part in found])


def token_ids(vocabulary: str, pattern: str):
    kind = pa.list_(pa.int32())

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoding(vocabulary, pattern)

        def encoded(texts: list[str | None]) -> pa.ListArray:
            found = [encode(own, text) for text in texts]
            ends = np.cumsum([0, *map(len, found)])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found), pa.int32()))

        yield from by_slices(batches, encoded, kind)

    return ids


def best_boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """The at most `buckets` boundaries, the largest length last, with the least total padding.

    A sequence is padded to the first boundary not below its length. Exact: every choice
    of lengths as boundaries is considered. Of equal choices the one found first stays.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[length] for length in lengths], dtype=np.int64)
    number = np.r_[0, np.cumsum(counts)]
    tokens = np.r_[0, np.cumsum(counts * lengths)]
    # padding[i, j]: of lengths i to j - 1 in one bucket that ends at length j - 1
    padding = np.r_[0, lengths][None, :] * (number[None, :] - number[:, None]) - (tokens[None, :] - tokens[:, None])
    size = len(number)
    never = np.iinfo(np.int64).max // 4
    padding = np.where(np.arange(size)[:, None] < np.arange(size)[None, :], padding, never)
    best = np.full(size, never)
    best[0] = 0
    choices = []
    totals = []
    for _ in range(min(buckets, len(lengths))):
        total = best[:, None] + padding
        choices.append(total.argmin(axis=0))
        best = np.minimum(total.min(axis=0), never)
        totals.append(best[-1])
    boundaries, end = [], size - 1
    for choice in reversed(choices[: int(np.argmin(totals)) + 1]):
        boundaries.append(int(lengths[end - 1]))
        end = int(choice[end])
    return boundaries[::-1]


def sequences(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """One row per sequence: row, doc_id, chunk, start, n_tokens, bucket, padding, batch, position, ids.

    A document is one sequence, or where it has more than `max_length` tokens several that
    follow each other (`start` is the first token's place), so nothing is cut off; `ids` are
    its token ids. `row` is a number of the input row, by which rows of equal or null ids are
    told apart. `bucket` is the padded length; a batch holds as many sequences of its bucket
    as fit `batch_tokens` padded, at least one, and batches are filled in turn, so one per
    bucket can be short. Special strings count as ordinary text. A null or empty text has no
    tokens and no sequence. Repeated rows and equal ids are packed each; null ids too. Other
    columns are not looked at. The histogram that reaches the driver has `max_length` rows at
    most.
    """
    ids = token_ids(vocabulary, pattern)
    own = [F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("doc_id")]
    encoded = settle(docs.select(*own, ids(F.col(f"`{text}`")).alias("all")), "tokens")  # else encoded for each use
    tokens = F.size("all")
    pieces = F.sequence(F.lit(0), ((tokens - 1) / max_length).cast("int"))
    chunks = (
        encoded.where(tokens > 0)
        .withColumn("chunk", F.explode(pieces))
        .withColumn("start", F.col("chunk").cast("bigint") * max_length)
        .withColumn("n_tokens", F.least(tokens - F.col("start"), F.lit(max_length)))
    )
    histogram = {row["n_tokens"]: row["n"] for row in chunks.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    bucket = F.lit(None).cast("bigint")
    for boundary in reversed(best_boundaries(histogram, buckets)):
        bucket = F.when(F.col("n_tokens") <= boundary, F.lit(boundary).cast("bigint")).otherwise(bucket)
    chunks = chunks.withColumn("ids", F.slice("all", F.col("start").cast("int") + 1, F.col("n_tokens").cast("int"))).drop("all")
    placed = numbered(chunks.withColumn("bucket", bucket), ["bucket"], ["doc_id", "chunk", "n_tokens"])
    capacity = F.greatest(F.call_function("div", F.lit(batch_tokens), F.col("bucket")), F.lit(1).cast("bigint"))
    return placed.select(
        "row",
        "doc_id",
        "chunk",
        "start",
        "n_tokens",
        "bucket",
        (F.col("bucket") - F.col("n_tokens")).alias("padding"),
        F.call_function("div", F.col("slot"), capacity).alias("batch"),
        F.pmod(F.col("slot"), capacity).alias("position"),
        "ids",
    )


def pack(docs: DataFrame, vocabulary: str, pattern: str, **options) -> DataFrame:
    """The plan of `sequences`, without the ids and the row's number."""
    return sequences(docs, vocabulary, pattern, **options).drop("row", "ids")
