"""Repeated slots of one wide object, unpivoted to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import ordinal_label


def flatten_slots(
    df: DataFrame,
    slots: Sequence[Column | str],
    fields: Sequence[str],
    label: str,
    label_prefix: str,
    keep: Sequence[Column | str] = (),
) -> DataFrame:
    """One row per non-empty slot: `keep`, each of `fields`, and the slot's label.

    Slots are map<string,string>, because only a map can tell an object without keys
    (no row) from an object whose values are all null or unknown (a row of NULLs).
    """
    slots = [F.col(slot) if isinstance(slot, str) else slot for slot in slots]
    named = [f"_slot{at}" for at in range(len(slots))]
    apart = df.select(*keep, *[slot.alias(name) for slot, name in zip(slots, named)])
    kept = [F.col(f"`{name}`") for name in apart.columns[: -len(slots)]]
    taken = apart.select(*kept, F.posexplode(F.array(*named)).alias("_pos", "_slot"))
    return taken.where(F.size("_slot") > 0).select(
        *kept,
        *[F.col("_slot")[field].alias(field) for field in fields],
        ordinal_label(label_prefix, F.col("_pos")).alias(label),
    )


def unpivot_columns(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per id row and value column; no shuffle."""
    return df.unpivot(list(ids), list(values), name, value)
