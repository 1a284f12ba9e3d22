"""Exact duplicates by naming: blocks become integers, then pairs of integers do, until a document is one integer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm._frames import hashes, id_back, id_of, written

BLOCK = 2048
MISSING = -1
#: A run of blanks that is not one space already.
BLANKS = "[\\x09-\\x0D][\\x20\\x09-\\x0D]*|\\x20[\\x20\\x09-\\x0D]+"


def normalised(text: Column) -> Column:
    """``text`` with each run of blanks as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def _blocks(text: Column, block: int) -> Column:
    """Pieces of ``block`` characters; the empty text is one empty piece."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    return F.when(F.length(text) <= block, F.array(text)).otherwise(pieces)


def _names(parts: DataFrame, *order: str) -> DataFrame:
    """Distinct ``parts`` with a number as ``name``: the place in the sorted distinct values of its partition.

    Equal values are taken together before they move, so a frequent one is a row a task.
    """
    return parts.distinct().sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id())


def _block_names(texts: DataFrame, block: int, salt: int = 0) -> tuple[DataFrame, int]:
    """``(h1, h2, name)`` per distinct block, and the salt of the hashes.

    Blocks are named by their whole contents. The hashes only stand for them afterwards, once it is
    certain that no two blocks share a pair; if some do, other hashes are taken.
    """
    pieces = texts.select(F.explode(_blocks(F.col("text"), block)).alias("block"))
    h1, h2 = hashes(F.col("block"), salt)
    named = _names(pieces.select(h1.alias("h1"), h2.alias("h2"), "block"), "h1", "h2", "block")
    names = written(named.select("h1", "h2", "name"))
    if names.groupBy("h1", "h2").count().where("count > 1").isEmpty():
        return names, salt
    return _block_names(texts, block, salt + 1)


def identities(texts: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``(row, id, text_sha256)`` and ``(row, level, name)`` of the rows of ``texts`` (``id``, ``text``).

    Two rows have the same level and name if and only if their texts are equal: a name stands for one
    block or one pair of names, and a text of n blocks is done at level ``ceil(log2(n))``.
    """
    names, salt = _block_names(texts, block)

    def pair_of(piece: Column) -> Column:
        h1, h2 = hashes(piece, salt)
        return F.struct(h1.alias("h1"), h2.alias("h2"))

    hashed = written(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            F.sha2("text", 256).alias("text_sha256"),
            F.transform(_blocks(F.col("text"), block), pair_of).alias("blocks"),
        )
    )
    level = 0
    parts = hashed.select("row", F.size("blocks").alias("size"), F.posexplode("blocks").alias("place", "hash"))
    parts = parts.select("row", "size", "place", "hash.h1", "hash.h2").join(names.hint("merge"), ["h1", "h2"])
    parts = written(parts.select("row", "size", "place", "name"))
    found = parts.where("size = 1").select("row", F.lit(level).alias("level"), "name")
    while not (open_ := parts.where("size > 1")).isEmpty():
        level += 1
        side = F.col("place") % 2
        pairs = (
            open_.groupBy("row", ((F.col("size") + 1) / 2).cast("int").alias("size"), (F.col("place") / 2).cast("int").alias("place"))
            .agg(
                F.max(F.when(side == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(MISSING)).alias("right"),
            )
        )
        names = written(_names(pairs.select("left", "right"), "left", "right"))
        parts = written(pairs.join(names.hint("merge"), ["left", "right"]).select("row", "size", "place", "name"))
        found = found.unionByName(parts.where("size = 1").select("row", F.lit(level).alias("level"), "name"))
    return hashed.select("row", "id", "text_sha256"), found


def dedup(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for each row of ``docs``.

    Texts are equal when they are after each run of blanks is made one space; null counts as empty.
    Of equal texts the row with the smallest id stays, a null id before all others; of rows with
    that id one stays. Other columns are not read. An empty table gives no rows.
    """
    rows, found = identities(docs.select(id_of().alias("id"), normalised(F.col("text")).alias("text")), block)
    named = rows.join(found, "row")
    groups = named.groupBy("level", "name").agg(
        F.min(F.struct("id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    return named.join(groups.hint("merge"), ["level", "name"]).select(
        id_back("id").alias("doc_id"),
        id_back("keep.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )
