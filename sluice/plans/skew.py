"""Joins and groupings in which one key may hold a large part of all rows.

A key is *hot* when it has more rows than ``slot_rows``. With ``slot_rows`` at least
``total / max_hot`` there can be no more than ``max_hot`` hot keys, whatever the data, so the list
of hot keys is the one thing here that is broadcast, by a 64-bit hash, so that its bytes are bounded too: a
key that shares a hot key's hash is only slotted without need. A hot key is cut into
``fan = ceil(rows / slot_rows)`` slots; the fans of all hot keys add up to at most ``2 * max_hot``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SkewLimits:
    """``max_hot`` bounds the hot list; ``min_rows`` is the least number of rows worth splitting."""

    max_hot: int = 100_000
    min_rows: int = 200_000

    def slot_rows(self, total: int) -> float:
        return max(total / self.max_hot, float(self.min_rows))


DEFAULT_LIMITS = SkewLimits()


def hot_keys(weights: DataFrame, key: str, weight: str, limits: SkewLimits = DEFAULT_LIMITS) -> DataFrame:
    """``(hot, fan)``: hashes of the keys of ``weights`` (one row per key) that need more than one slot."""
    total = weights.agg(F.sum(weight).alias("total")).scalar()
    slot_rows = F.greatest(total / F.lit(limits.max_hot), F.lit(float(limits.min_rows)))
    return (
        weights.where(F.col(weight) > slot_rows)
        .groupBy(F.xxhash64(key).alias("hot"))
        .agg(F.max(F.ceil(F.col(weight) / slot_rows)).cast("int").alias("fan"))
    )


def slot_of(fan: Column, spread: Sequence[str]) -> Column:
    """The slot of a row, from a hash of its other columns, so that a retried task agrees with itself."""
    return F.when(fan.isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*spread), fan).cast("int"))


def every_slot(fan: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(fan, F.lit(1)) - 1))


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``rows``, in which a key may be very frequent, to ``lookup`` with few rows per ``key``.

    A merge join on the key: its sizes are known when it runs, and adaptive execution then splits
    the partition of a frequent key of ``rows`` over several tasks, each with the key's few rows of ``lookup``.
    The hint stands against broadcasting a ``lookup`` whose size the planner can only guess. Both inputs are
    read once.
    """
    return rows.join(lookup.hint("merge"), key, how)
