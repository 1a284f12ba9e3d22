"""Lineage cuts and the fixed layout of the arcs that a loop joins again and again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import ensure_checkpoint_dir, shuffle_partitions


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


#: Rows that one task sorts and keeps.
ROWS_PER_PARTITION = 2_000_000


def keep_sorted(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Keep ``df`` (of about ``rows`` rows) hashed and sorted on ``keys``, on disk, so that joins on them neither move nor sort it.

    The blocks lie on the executors' disks. A lost one is rebuilt from what ``df`` reads, which should
    be a cut. The caller unpersists. A graph that several jobs use is better kept as a bucketed table.
    """
    partitions = max(shuffle_partitions(df.sparkSession), -(-rows // ROWS_PER_PARTITION))
    kept = (
        df.repartition(partitions, *keys)
        .sortWithinPartitions(*keys)
        .persist(StorageLevel.DISK_ONLY)
    )
    # the layout is known to the planner only once it exists
    kept.agg(F.count(F.lit(1))).collect()
    return kept
