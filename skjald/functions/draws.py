"""Seeded draws that depend on keys alone, so that any plan and rerun agree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rank_key(seed: str, *keys: Column) -> Column:
    """A string by which rows are in a random order."""
    return F.md5(F.concat_ws("-", F.lit(seed), *(k.cast("string") for k in keys)))


def whole_number(seed: str, low: int, high: int, *keys: Column) -> Column:
    """From `low` to `high`, both included."""
    draw = F.conv(F.substring(rank_key(seed, *keys), 1, 8), 16, 10).cast("long")
    return F.lit(low) + draw % (high - low + 1)
