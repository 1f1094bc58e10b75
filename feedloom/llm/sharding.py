"""Shards of near-equal bytes by histogram sort.

Rows are ordered by a key, (hash of the text, hash of the doc_id). Splitters between
shards are found by counting exact bytes below candidate boundaries over all partitions,
round after round on finer boundaries, until each splitter is within the tolerance; only
then are rows exchanged, once. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import numbered, whole_row
from feedloom.workspace import settle

#: Candidate boundaries tried in the interval that holds a splitter, per round.
PROBES = 4096
#: A splitter is found when the bytes below it miss their target by less than this part of a shard.
TOLERANCE = 0.001
#: Keys are two numbers in [0, TOP).
TOP = 1 << 62


@dataclass
class Splitter:
    """The boundary with `target` bytes below it, known to lie in [low, high).

    `below` is the exact number of bytes below `low`. Where one text hash is across the
    target, `group` is that hash and the interval is one of doc_id hashes within it.
    """

    target: float
    low: int = 0
    high: int = TOP
    group: int | None = None
    below: int = 0
    found: bool = False

    def interval(self) -> tuple:
        return (self.group, self.low, self.high)

    def refine(self, counts: dict[int, int], allowed: float) -> None:
        """Narrow the interval by the exact bytes of its probe steps."""
        step = step_of(self.low, self.high)
        below = self.below
        for probe in sorted(counts):
            edge, above = self.low + probe * step, below + counts[probe]
            if above <= self.target:
                below = above
                continue
            if self.target - below <= allowed:
                self.low, self.found = edge, True
            elif above - self.target <= allowed:
                self.low, self.found = edge + step, True
            elif step > 1:
                self.low, self.high = edge, min(edge + step, self.high)
            elif self.group is None:
                self.group, self.low, self.high = edge, 0, TOP
            else:  # rows with one key: the nearer side
                self.low, self.found = (edge if self.target - below <= above - self.target else edge + 1), True
            self.below = below
            return
        self.low, self.below, self.found = self.high, below, True

    def reached(self) -> Column:
        """Whether a row's key lies at or above the splitter."""
        if self.group is None:
            return F.col("hash") >= self.low
        return (F.col("hash") > self.group) | ((F.col("hash") == self.group) & (F.col("id_hash") >= self.low))


def step_of(low: int, high: int) -> int:
    return max(1, -(-(high - low) // PROBES))


def probed(keys: DataFrame, intervals: list[tuple]) -> list[dict[int, int]]:
    """Exact bytes per probe step of each interval: one scan, combined before the shuffle.

    The intervals are disjoint, so a row is counted in one at most.
    """
    number, probe = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for at, (group, low, high) in enumerate(intervals):
        value = F.col("hash" if group is None else "id_hash")
        inside = (value >= low) & (value < high)
        if group is not None:
            inside = inside & (F.col("hash") == group)
        number = F.when(inside, at).otherwise(number)
        probe = F.when(inside, F.call_function("div", value - low, F.lit(step_of(low, high)))).otherwise(probe)
    sums = (
        keys.select(number.alias("at"), probe.alias("probe"), "size")
        .where("at IS NOT NULL")
        .groupBy("at", "probe")
        .agg(F.sum("size").alias("bytes"))
    )
    counts: list[dict[int, int]] = [{} for _ in intervals]
    for row in sums.collect():  # at most PROBES rows per splitter
        counts[row["at"]][row["probe"]] = row["bytes"]
    return counts


def find_splitters(keys: DataFrame, shards: int, tolerance: float) -> list[Splitter]:
    total = keys.agg(F.sum("size")).first()[0] or 0
    splitters = [Splitter(total * n / shards, found=not total) for n in range(1, shards)]
    while any(not splitter.found for splitter in splitters):
        waiting = [splitter for splitter in splitters if not splitter.found]
        intervals = list(dict.fromkeys(splitter.interval() for splitter in waiting))
        counts = dict(zip(intervals, probed(keys, intervals)))
        for splitter in waiting:
            splitter.refine(counts[splitter.interval()], tolerance * total / shards)
    return splitters


def with_keys(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def key(column: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(column), 2)

    return docs.select(
        whole_row(docs),
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        key(body).alias("hash"),
        key(F.col(f"`{doc_id}`")).alias("id_hash"),
    )


def shard_number(splitters: list[Splitter]) -> Column:
    return sum((splitter.reached().cast("int") for splitter in splitters), F.lit(0))


def assign_shards(
    docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text", tolerance: float = TOLERANCE
) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law `bytes`: sizes of shards are equal but for the tolerance on each side, or the
    largest row where that is more. Size is the UTF-8 bytes of the text plus 1; empty and
    null texts have size 1 and checksum 0. Equal texts are neighbours, in one shard
    unless a boundary has to cut their group, which it then does by doc_id. Rows alike in
    text and doc_id (null or not) share a shard. Slots run from 0 in each shard without a
    gap, in no order that means anything. An empty table gives no rows. grown_shard is
    null under this law. Other columns are not looked at.
    """
    keys = settle(with_keys(docs, doc_id, text).drop("row"), "shard-keys")
    splitters = find_splitters(keys, shards, tolerance)
    slotted = numbered(keys.withColumn("shard", shard_number(splitters)), ["shard"], ["hash", "id_hash"])
    return slotted.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = 16,
    doc_id: str = "doc_id",
    text: str = "text",
    tolerance: float = TOLERANCE,
    files_per_shard: int = 8,
) -> None:
    """Write the rows, all their columns under `row`, as Parquet in folders shard=0, 1, ...

    The same shards as `assign_shards`; the rows are exchanged once, and each shard is
    written by `files_per_shard` tasks.
    """
    keyed = with_keys(docs, doc_id, text)
    splitters = find_splitters(settle(keyed.drop("row"), "shard-keys"), shards, tolerance)
    placed = keyed.withColumn("shard", shard_number(splitters))
    file = F.pmod(F.xxhash64("hash", "id_hash"), F.lit(files_per_shard))
    parts = shards * files_per_shard
    placed.repartition(parts, "shard", file).select("row", "shard").write.partitionBy("shard").parquet(path)
