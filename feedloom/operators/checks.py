"""Checks before a write, counts along the way, and a preview."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def require_settings(settings: Mapping[str, str | None], *names: str) -> dict[str, str]:
    """The named settings, or an error naming the absent and blank ones (never a value)."""
    missing = [name for name in names if not settings.get(name)]
    if missing:
        raise ValueError(f"missing settings: {', '.join(missing)}")
    return {name: settings[name] for name in names}


def require_rows(df: DataFrame, what: str = "batch") -> DataFrame:
    """The frame itself, or an error when it has no rows; reads no more than one row."""
    if df.isEmpty():
        raise ValueError(f"no data for {what}")
    return df


def row_counter(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """The frame, with its rows counted as some later action passes over them."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()])
    return counted, seen


def preview(df: DataFrame, n: int = 10, *order_by: Column | str) -> DataFrame:
    """n rows; with an order the same n on every run."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
