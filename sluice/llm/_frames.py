"""What the operators share: written intermediate tables, null-free ids, slices of record batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import ensure_checkpoint_dir

#: Stands for a null id inside a job, so that joins and orders treat it as one id before all others.
NO_ID = -(2**63)

#: Bytes of text that a task looks at together; numpy arrays take a small multiple of eight times that.
SLICE_BYTES = 1 << 20
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder; the table goes when the session ends."""
    return written_at(df)[0]


def written_at(df: DataFrame) -> tuple[DataFrame, str]:
    """As :func:`written`, with the table's path."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    # the job's shuffle files are of no use once the table is there
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    _files(spark, path, lambda files, place: files.deleteOnExit(place))
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of :func:`written_at` that nothing reads any more."""
    _files(spark, path, lambda files, place: files.delete(place, True))


def _files(spark: SparkSession, path: str, use) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    use(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place)


def id_of(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("bigint"), F.lit(NO_ID))


def id_back(column: str | Column) -> Column:
    return F.nullif(F.col(column) if isinstance(column, str) else column, F.lit(NO_ID))


def text_slices(batches: Iterator[pa.RecordBatch], text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(byte_lengths(batch.column(text)))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(first, last - first)
            first = last


def byte_lengths(texts: pa.Array) -> np.ndarray:
    offsets, _ = text_buffer(texts)
    return np.diff(offsets)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0, one more than rows) and UTF-8 bytes of a string or binary array; null counts as empty."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint8)
    ends = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return ends - ends[0], raw[ends[0] : ends[-1]]


def spans_of(counts: np.ndarray) -> np.ndarray:
    """``0..c-1`` for each count ``c``, one after another."""
    total = int(counts.sum())
    starts = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) - np.repeat(starts, counts)


def column(batch: pa.RecordBatch, index: int) -> np.ndarray:
    return batch.column(index).to_numpy(zero_copy_only=False)


def rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, schema, strict=True)], schema=schema
    )


def row_key(text: str = "text") -> list[Column]:
    """Columns that tell rows apart by id and text; rows equal in both share a key, and so every decision."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return [id_of().alias("_id"), *[part.alias(name) for part, name in zip(hashes(value), ("_t1", "_t2"), strict=True)]]


def hashes(value: Column, salt: int = 0) -> list[Column]:
    """Two 64-bit hashes of ``value``."""
    return [F.xxhash64(F.lit(2 * salt), value), F.xxhash64(F.lit(2 * salt + 1), value)]


KEY = ["_id", "_t1", "_t2"]


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and other letters as they are."""
    # lower() is much faster than translate(), and the same where all characters are one byte
    plain = F.length(text) == F.octet_length(text)
    letter_by_letter = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(plain, F.lower(text)).otherwise(letter_by_letter)
