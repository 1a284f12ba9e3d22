"""Timestamp-ordered reads over a log of put and get operations.

The log is ``(op_id, ts, key, op, value, loc)``; ``op`` is ``put`` or ``get``. Operations on a key
run in the order of ``ts``, then ``op_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.plans.layout import cut
from sluice.plans.skew import DEFAULT_LIMITS, SkewLimits, hot_keys


def _put_value():
    # a struct, so that a put of null still counts as a put
    return F.when(F.col("op") == "put", F.struct(F.col("value").alias("value")))


def _last_put(order: Window):
    return F.last(_put_value(), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))


def kv_read_asof(ops: DataFrame, limits: SkewLimits = DEFAULT_LIMITS) -> DataFrame:
    """``(op_id, key, ts, loc, value)`` per get: what the last put before it stored, null if there was none.

    A key of ordinary size is one window. The log of a hot key is cut into ranges of time of equal
    size; each is read by itself, and what a range has no put for comes from the ranges before.
    """
    log = ops.where("key is not null").withColumn("hot", F.xxhash64("key"))
    weights = log.groupBy("key").agg(F.count(F.lit(1)).alias("weight"))
    hot = cut(hot_keys(weights, "key", "weight", limits).select("hot"))
    by_key = Window.partitionBy("key").orderBy("ts", "op_id")
    columns = ["op_id", "key", "ts", "loc"]
    if hot.isEmpty():
        return log.withColumn("stored", _last_put(by_key)).where("op = 'get'").select(*columns, "stored.value")

    usual = (
        log.join(F.broadcast(hot), "hot", "left_anti")
        .withColumn("stored", _last_put(by_key))
        .where("op = 'get'")
        .select(*columns, "stored.value")
    )
    # written out, so that the number of the range a row fell into is fixed
    ranged = cut(
        log.join(F.broadcast(hot), "hot", "left_semi")
        .repartitionByRange("key", "ts", "op_id")
        .withColumn("part", F.spark_partition_id())
    )
    in_part = Window.partitionBy("key", "part").orderBy("ts", "op_id")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per hot key and range
    carried = (
        ranged.groupBy("key", "part")
        .agg(F.max_by(_put_value(), F.when(F.col("op") == "put", F.struct("ts", "op_id"))).alias("last"))
        .select("key", "part", F.last("last", ignorenulls=True).over(before).alias("carried"))
    )
    split = (
        ranged.withColumn("stored", _last_put(in_part))
        .where("op = 'get'")
        .join(carried, ["key", "part"])
        .select(*columns, F.coalesce("stored", "carried")["value"].alias("value"))
    )
    return usual.unionByName(split)


def kv_latest(ops: DataFrame) -> DataFrame:
    """``(key, value)`` after all puts.

    Spark sorts by key for an aggregate of this kind, before the partial step and after the shuffle; a key moves as one row
    from each task.
    """
    return (
        ops.where("op = 'put' and key is not null")
        .groupBy("key")
        .agg(F.max_by("value", F.struct("ts", "op_id")).alias("value"))
    )
