"""Streams of query terms and of put operations.

Each micro-batch is written to a folder of its own, named by the batch number, so that a batch run
again after a failure replaces its first try.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.text import query_term
from sluice.operators.langmodel import suggest
from sluice.operators.lookup import BROADCAST_BYTES
from sluice.operators.oplog import kv_latest


#: Distinct terms of a batch up to which they are broadcast to the model, if they are short; beyond, both are shuffled.
BROADCAST_TERMS = 100_000


def start_stream(stream: DataFrame, write_batch, mode: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def batch_writer(path: str, answer):
    def write_batch(batch: DataFrame, number: int) -> None:
        answer(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write_batch


def write_model_table(model: DataFrame, name: str, buckets: int) -> DataFrame:
    """``model`` as a table bucketed and sorted by prefix, so that joins with it leave it where it is."""
    model.write.mode("overwrite").bucketBy(buckets, "prefix").sortBy("prefix").format("parquet").saveAsTable(name)
    return model.sparkSession.table(name)


def _answer_batch(model: DataFrame, most: int):
    def answer(batch: DataFrame) -> DataFrame:
        asked = batch.select("term").where("term is not null").distinct()
        size = asked.limit(most + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("term") * 2 + 64).alias("bytes")).first()
        if size["n"] > most or (size["bytes"] or 0) > BROADCAST_BYTES:
            return suggest(asked, model)
        asked = F.broadcast(asked.withColumn("prefix", query_term(F.col("term"))))
        return model.join(asked, "prefix").select(
            "term", "rank", F.col("word").alias("label"), F.col("prob").alias("probability")
        )

    return answer


def suggest_stream(
    terms: DataFrame,
    model: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    broadcast_terms: int = BROADCAST_TERMS,
) -> StreamingQuery:
    """Answer arriving terms from a written ``model``, as :func:`suggest` does, into ``path``.

    The terms go to the model: they are broadcast if a batch has at most ``broadcast_terms`` different ones of 8 MB together, otherwise
    they are shuffled, and a model from :func:`write_model_table` still stays in place.
    """
    answer = _answer_batch(model, broadcast_terms)
    write = batch_writer(path, answer)

    def write_batch(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            write(batch, number)
        finally:
            batch.unpersist()

    return start_stream(terms, write_batch, "append", checkpoint, available_now)


def kv_latest_stream(
    ops: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Keep the value of each key after the puts that have arrived; changed keys go to ``path``.

    The state has one row per key. Use the RocksDB state store when there are many.
    """
    latest = kv_latest(ops)
    # so that the folder has a schema before the first batch; an older start's rows stay
    nothing = ops.sparkSession.createDataFrame([], latest.schema)
    nothing.write.mode("ignore").parquet(f"{path}/batch=-1")
    return start_stream(latest, batch_writer(path, lambda batch: batch), "update", checkpoint, available_now)


def read_suggestions(spark: SparkSession, path: str) -> DataFrame:
    """All answers so far; a term asked in several batches is answered in each."""
    return spark.read.parquet(path).select("batch", "term", "rank", "label", "probability")


def _newest(changes: DataFrame) -> DataFrame:
    return changes.groupBy("key").agg(F.max_by("value", "batch").alias("value"), F.max("batch").alias("batch"))


def compact_latest(spark: SparkSession, path: str, snapshot: str, before: str | None = None) -> None:
    """Write the newest change of each key to the folder ``snapshot``, from ``path`` and the snapshot ``before``.

    Afterwards only later batches need to be read, and the folders of earlier ones may be removed.
    """
    changes = _changes(spark, path, before)
    _newest(changes).write.parquet(snapshot)


def _changes(spark: SparkSession, path: str, snapshot: str | None) -> DataFrame:
    changes = spark.read.parquet(path).select("key", "value", "batch")
    if snapshot is None:
        return changes
    old = spark.read.parquet(snapshot).select("key", "value", "batch")
    upto = old.agg(F.coalesce(F.max("batch"), F.lit(-1)).alias("upto")).first()["upto"]
    return changes.where(F.col("batch") > upto).unionByName(old)


def read_latest(spark: SparkSession, path: str, snapshot: str | None = None) -> DataFrame:
    """``(key, value)`` from the newest change of each key; with a ``snapshot``, only batches after it are read."""
    return _newest(_changes(spark, path, snapshot)).select("key", "value")
