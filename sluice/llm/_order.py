"""The place of every row in one order over a whole table."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._frames import written

_ROW_BITS = 33


def numbered(rows: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """``rows`` with the bigint column ``name``: their place from 0 in the order by ``order``, nulls first.

    The rows are dealt out by ranges of the order and written sorted, so no task holds a whole group of equal
    keys; rows equal in ``order`` are told apart by where they were read, which a repeated task finds again. ``rows`` must be a
    table read from files. One number for each written part comes to the driver and goes out again.
    """
    keys = [*order, "_read"]
    table = written(
        rows.withColumn("_read", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_read")
        .withColumn("_row", F.monotonically_increasing_id())
    )
    part = F.shiftright("_row", _ROW_BITS)
    sizes = sorted(table.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = accumulate([0, *[n for _, n in sizes[:-1]]])
    starts = table.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(sizes, before)], "_part bigint, _start bigint"
    )
    place = F.col("_start") + F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        table.join(F.broadcast(starts), part == F.col("_part")).withColumn(name, place).drop("_row", "_part", "_start")
    )
