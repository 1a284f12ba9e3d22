"""Reads in time order over a stream in which operations arrive in any order."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, BooleanType, StructField, StructType

from sluice.streaming.requests import batch_writer, start_stream

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


#: Operations that share a row of the state.
OPS_PER_ROW = 4096
_WAITING = StructType([StructField("ops", BinaryType(), False)])


class _Reads(StatefulProcessor):
    """Per key: what waits for the watermark, and the value after everything before it.

    Each row of the state and each value that is passed to or from it costs far more than an operation does, so many share a row.
    """

    def __init__(self, stored: StructType):
        self._stored_schema = stored

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", _WAITING)
        self._stored = handle.getValueState("stored", self._stored_schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [(op_id, micros, put, value, loc, ts) for op_id, _, ts, micros, put, value, loc in rows]
        if new:
            self._waiting.appendList(_packed(new))
            due = min(micros for _, micros, *_ in new)
            self._handle.registerTimer(-(-due // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = [op for (ops,) in self._waiting.get() for op in pickle.loads(ops)]
        ready = sorted((w for w in waiting if w[1] <= upto), key=lambda w: (w[1], w[0]))
        if not ready:
            return
        later = [w for w in waiting if w[1] > upto]
        if later:
            self._waiting.put(_packed(later))
            self._handle.registerTimer(-(-min(w[1] for w in later) // 1000))
        else:
            self._waiting.clear()
        value = self._stored.get()[0] if self._stored.exists() else None
        changed = False
        for op_id, _, put, new, loc, ts in ready:
            if put:
                value, changed = new, True
            else:
                yield Row(op_id=op_id, key=key[0], ts=ts, loc=loc, value=value)
        if changed:
            self._stored.update((value, True))

    def close(self) -> None:
        pass


def _packed(ops: list[tuple]) -> list[tuple[bytes]]:
    return [(pickle.dumps(ops[first : first + OPS_PER_ROW]),) for first in range(0, len(ops), OPS_PER_ROW)]


def kv_read_asof_stream(
    ops: DataFrame, path: str, checkpoint: str, delay: str = "1 hour", available_now: bool = False
) -> StreamingQuery:
    """Answer arriving gets in the order of ``ts``, as ``kv_read_asof`` does, into ``path``.

    ``ops`` is a stream of ``(op_id, ts, key, op, value, loc)`` with ``ts`` a timestamp. Puts and gets may arrive in any order. A get is
    answered when the watermark, the largest ``ts`` seen less ``delay``, has reached its ``ts``: all puts before it
    are there then. An operation that arrives when the watermark has already reached its ``ts`` is late: it is left out, a
    get without an answer and a put without effect, and counted in the query's progress
    (``numRowsDroppedByWatermark``). Operations without a key or a ``ts`` are left out.

    The state is held in RocksDB: for each key one value, and its operations of the last ``delay``.
    """
    spark = ops.sparkSession
    fields = {field.name: field for field in ops.schema}
    ts = F.col("ts").cast("timestamp")
    rows = (
        ops.where("key is not null and ts is not null and op in ('put', 'get')")
        .withColumn("ts", ts)
        .withWatermark("ts", delay)
        .withColumn("micros", F.unix_micros("ts"))
        .withColumn("put", F.col("op") == "put")
        .select("op_id", "key", "ts", "micros", "put", "value", "loc")
    )
    parts = {field.name: field for field in rows.schema}
    stored = StructType([StructField("value", fields["value"].dataType, True), StructField("known", BooleanType(), True)])
    answer = StructType([StructField(n, parts[n].dataType, True) for n in ("op_id", "key", "ts", "loc", "value")])
    answers = rows.groupBy("key").transformWithState(
        _Reads(stored), outputStructType=answer, outputMode="Append", timeMode="EventTime"
    )
    spark.createDataFrame([], answer).write.mode("ignore").parquet(f"{path}/batch=-1")
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        return start_stream(answers, batch_writer(path, lambda batch: batch), "append", checkpoint, available_now)
    finally:
        spark.conf.set(_PROVIDER, before)


def read_answers(spark, path: str) -> DataFrame:
    """``(op_id, key, ts, loc, value)`` of all gets answered so far."""
    return spark.read.parquet(path).select("op_id", "key", "ts", "loc", "value")
