"""A written model of which look-ups read only the files that can hold what is asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import query_term
from sluice.operators.langmodel import suggest

ROWS_PER_BUCKET = 2_000_000
MOST_BUCKETS = 4096
#: Prefixes up to which the reader is told each one, and their bytes together.
FEW_PREFIXES, FEW_BYTES = 500, 1 << 16
#: Bytes of asked terms up to which they are broadcast to the model.
BROADCAST_BYTES = 8 << 20


def bucket_of(prefix: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(prefix), F.lit(buckets)).cast("int")


def write_lookup_model(model: DataFrame, path: str, buckets: int | None = None) -> None:
    """Write ``model`` to ``path``, in a folder for each bucket of prefixes, sorted by prefix and with Bloom filters on it.

    Without ``buckets`` there are as many as hold about two million rows each, 4,096 at most.
    """
    if buckets is None:
        buckets = min(MOST_BUCKETS, 1 + model.count() // ROWS_PER_BUCKET)
    layout = model.sparkSession.range(1).select(F.lit(buckets).alias("buckets"))
    layout.write.mode("overwrite").parquet(f"{path}/layout")
    (
        model.withColumn("bucket", bucket_of(F.col("prefix"), buckets))
        .repartition("bucket")
        .sortWithinPartitions("bucket", "prefix", "rank")
        .write.mode("overwrite")
        .partitionBy("bucket")
        .option("parquet.bloom.filter.enabled#prefix", "true")
        .parquet(f"{path}/rows")
    )


def rows_for(spark: SparkSession, path: str, asked: DataFrame) -> DataFrame:
    """The rows of the model at ``path`` that may be for a ``prefix`` in ``asked``; other buckets' files are not read.

    For few prefixes the rows are those of the prefixes themselves, so that statistics and Bloom filters can
    keep the reader from most of a file.
    """
    return _rows_for(spark, path, asked, _measured(spark, path, asked))


def _measured(spark: SparkSession, path: str, asked: DataFrame) -> tuple[list[int], int, int]:
    """The buckets asked for (at most 4,096 numbers), how many rows ask, and their bytes."""
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    length = sum((F.octet_length(name) for name in asked.columns), F.lit(64))
    row = asked.agg(
        F.collect_set(bucket_of(F.col("prefix"), buckets)).alias("buckets"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(length), F.lit(0)).alias("bytes"),
    ).first()
    return sorted(row["buckets"]), row["rows"], row["bytes"]


def _rows_for(spark: SparkSession, path: str, asked: DataFrame, measured: tuple[list[int], int, int]) -> DataFrame:
    buckets, count, size = measured
    stored = spark.read.parquet(f"{path}/rows")
    rows = stored.where(F.col("bucket").isin(buckets)) if buckets else stored.limit(0)
    if 0 < count <= FEW_PREFIXES and size <= FEW_BYTES:
        rows = rows.where(F.col("prefix").isin([row["prefix"] for row in asked.select("prefix").collect()]))
    return rows.drop("bucket")


def suggest_from(terms: DataFrame, path: str) -> DataFrame:
    """``(term, rank, label, probability)`` as ``suggest`` gives it, from a model of :func:`write_lookup_model`.

    How much of the model is read follows the number of terms. Terms of few bytes are broadcast to it, more of them are
    shuffled together with the buckets they are in.
    """
    spark = terms.sparkSession
    asked = terms.select("term").where("term is not null").distinct()
    prefixes = asked.select("term", query_term(F.col("term")).alias("prefix"))
    measured = _measured(spark, path, prefixes)
    rows = _rows_for(spark, path, prefixes, measured)
    if measured[2] <= BROADCAST_BYTES:
        return rows.join(F.broadcast(prefixes), "prefix").select(
            "term", "rank", F.col("word").alias("label"), F.col("prob").alias("probability")
        )
    return suggest(asked, rows)

