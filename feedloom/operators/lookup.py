"""Joining wide rows to a lookup that is usually, but not provably, small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.workspace import settle

BROADCAST_BYTES = 32 * 1024 * 1024
# Bytes of one key's rows from which on the key is cut, and of each of its parts.
PART_BYTES = 256 * 1024 * 1024
# Keys that are cut, at most: more data means larger parts, not a larger table of keys.
HOT_KEYS = 200_000


def width(df: DataFrame) -> int:
    """Bytes a frame takes as a broadcast, from its row count, its string lengths and its array sizes."""
    strings = [F.coalesce(F.octet_length(f"`{n}`"), F.lit(0)) for n, t in df.dtypes if t == "string"]
    strings += [F.greatest(F.size(f"`{n}`"), F.lit(0)) * 32 for n, t in df.dtypes if t.startswith("array<")]
    fixed = F.lit(16 * (len(df.columns) + 1))
    return df.agg(F.coalesce(F.sum(sum(strings, fixed)), F.lit(0)).alias("bytes")).first()["bytes"]


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    where: Column | None = None,
    spread: Column | None = None,
    size: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    measure: str | None = None,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """rows ⋈ lookup on `key`; `how` is inner, left_semi or left_anti.

    `lookup` is a settled table. Its size is measured unless an upper bound is given:
    within `broadcast_bytes` the rows are not shuffled at all. Beyond that both sides
    are shuffled and merged, and given a `spread` column, keys whose rows have more than
    `part_bytes` (counted as the bytes of the `measure` column and 64 a row) are cut into
    parts of that size by it and their lookup rows copied to each part, so that no task
    gets a hot key whole. `where` adds a condition over columns of both sides.
    """
    if size is None:
        size = width(lookup)
    if size <= broadcast_bytes:
        return _joined(rows, F.broadcast(lookup), [key], how, where)
    # Hinted, as the planner would broadcast by compressed file size.
    if spread is None:
        return _joined(rows, lookup.hint("merge"), [key], how, where)

    wide = F.lit(64) if measure is None else F.coalesce(F.octet_length(f"`{measure}`"), F.lit(0)) + 64
    sizes = settle(rows.groupBy(key).agg(F.sum(wide).alias("_bytes")), "key-bytes")
    total = sizes.agg(F.sum("_bytes")).first()[0] or 0
    part = max(part_bytes, -(-total // HOT_KEYS))
    hot = sizes.where(F.col("_bytes") > part).select(key, F.ceil(F.col("_bytes") / part).cast("int").alias("_parts"))
    hot = F.broadcast(settle(hot, "hot-keys"))  # HOT_KEYS rows at most, as each has more than `part` bytes
    parts = F.coalesce("_parts", F.lit(1))
    cut = rows.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(spread), parts).cast("int"))
    copies = lookup.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    joined = _joined(cut.drop("_parts"), copies.drop("_parts").hint("merge"), [key, "_part"], how, where)
    return joined.drop("_part")


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str, where: Column | None) -> DataFrame:
    if where is None:
        return left.join(right, keys, how)
    renamed = {name: f"_r_{name}" for name in keys}
    right = right.withColumnsRenamed(renamed)
    condition = where
    for name, other in renamed.items():
        condition = condition & (F.col(name) == F.col(other))
    return left.join(right, condition, how).drop(*renamed.values())
