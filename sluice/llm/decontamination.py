"""Benchmark passages in documents, by a hash set of the benchmark's word windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm._frames import KEY, ascii_lower, let, row_key, written

WINDOW = 13
#: Share of hit words from which a document is contaminated: one in this many.
SHARE = 20
#: Windows of all items up to which their hashes are broadcast; beyond, the join shuffles.
BROADCAST_WINDOWS = 500_000
#: What stands between words: ASCII characters other than letters and digits.
GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def _split(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def words_of(text: Column) -> Column:
    """The words of ``text`` with A-Z lower-cased; null has none."""
    return _split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))))


def _window_hash(codes: Column, at: Column, size: int) -> Column:
    """A hash of the first, middle and last word of a window; whether all words agree is seen where it hits."""
    places = sorted({0, (size - 1) // 2, size - 1})
    return F.xxhash64(*[F.get(codes, at + place) for place in places])


def _window_hashes(words: Column, size: int) -> Column:
    """The hash of each run of ``size`` words, by its start."""
    starts = F.sequence(F.lit(0), F.size(words) - size)
    coded = F.transform(words, lambda word: F.xxhash64(word))
    windows = let(coded, lambda codes: F.transform(starts, lambda at: _window_hash(codes, at, size)))
    return F.when(F.size(words) >= size, windows).otherwise(F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(item, size, window)``: every run of ``size`` words of an item, or all words of a shorter one."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words"))
    own = items.where(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(size)))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)
    windows = own.select("item", "size", "words", F.explode(starts).alias("at"))
    return windows.select("item", "size", F.slice("words", F.col("at"), F.col("size")).alias("window")).distinct()


def find_hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(_id, _t1, _t2, start, size, item)``: where windows of items occur in documents, ``start`` from 0."""
    windows = written(item_windows(benchmark, size))
    small = windows.count() <= BROADCAST_WINDOWS
    rows = docs.select(*row_key(), words_of(F.col("text")).alias("words"))
    found = None
    for row in windows.select("size").distinct().collect():  # at most `size` rows
        length = row["size"]
        codes = F.transform("window", lambda word: F.xxhash64(word))
        wanted = windows.where(F.col("size") == length).select("item", "window", codes.alias("codes"))
        wanted = wanted.select(_window_hash(F.col("codes"), F.lit(0), length).alias("hash"), "item", "window")
        hashed = F.posexplode(_window_hashes(F.col("words"), length)).alias("start", "hash")
        if small:
            starts = rows.select(*KEY, "words", hashed)
            met = starts.join(F.broadcast(wanted), "hash").where(
                F.slice("words", F.col("start") + 1, length) == F.col("window")
            )
        else:
            met = _met_by_shuffle(rows, rows.select(*KEY, hashed), wanted, length)
        part = met.select(*KEY, "start", F.lit(length).alias("size"), "item")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.where("false").select(*KEY, *[F.lit(0).alias(x) for x in ("start", "size")], F.lit("").alias("item"))
    return found


def _met_by_shuffle(rows: DataFrame, starts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The windows of ``starts`` that are in ``wanted``: by hash first, then by the words of a window each.

    A document's words move once and not with each of its windows.
    """
    hits = starts.join(wanted.select("hash").distinct().hint("merge"), "hash", "left_semi")
    hits = hits.groupBy(*KEY).agg(F.collect_set(F.struct("start", "hash")).alias("hits"))
    found = rows.join(hits.hint("merge"), KEY).select(*KEY, "words", F.explode("hits").alias("hit"))
    window = F.slice("words", F.col("hit.start") + 1, length).alias("window")
    return found.select(*KEY, "hit.start", "hit.hash", window).join(wanted.hint("merge"), ["hash", "window"])


def _covered(spans: str) -> Column:
    """The places of all words inside the spans."""
    return F.array_distinct(
        F.flatten(F.transform(spans, lambda span: F.sequence(span["start"], span["start"] + span["size"] - 1)))
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    share: int = SHARE,
    keep: Sequence[str] | None = None,
    unnamed: bool = False,
) -> DataFrame:
    """``(row, n_words, n_hit, items, contaminated)`` for each row of ``docs``; ``row`` holds its columns, or those in ``keep``.

    A word is hit inside any occurrence of a window of an item. ``items`` are the ids, as sorted strings,
    of the items that occur. A document is contaminated if at least one word in ``share`` is hit. A null
    or empty text has no words. Repeated rows are treated alike, items without a word are never found.
    With ``unnamed`` items without an id hit words like any other and are one null at the end of ``items``;
    without, they are never found. Without items nothing is hit.
    """
    wanted = benchmark if unnamed else benchmark.where(F.col("item_id").isNotNull())
    named = F.array_sort(F.collect_set("item"))
    items = F.when(F.max(F.col("item").isNull()), F.array_append(named, F.lit(None))).otherwise(named)
    hits = (
        find_hits(docs, wanted, size)
        .groupBy(*KEY)
        .agg(F.collect_set(F.struct("start", "size")).alias("spans"), items.alias("items"))
        .select(*KEY, F.size(_covered("spans")).cast("bigint").alias("hit"), "items")
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        (F.struct("*") if keep is None else F.struct(*keep)).alias("row"),
        F.size(_split(text)).cast("bigint").alias("n_words"),
        *row_key(),
    )
    n_hit = F.coalesce("hit", F.lit(0).cast("bigint"))
    return rows.join(hits, KEY, "left").select(
        "row",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean_text(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(row, kept_words)``: the words of each document that no window hits, in order."""
    hits = (
        find_hits(docs, benchmark, size)
        .groupBy(*KEY)
        .agg(F.collect_set(F.struct("start", "size")).alias("spans"))
        .select(*KEY, _covered("spans").alias("hit"))
    )
    rows = docs.select(F.struct("*").alias("row"), words_of(F.col("text")).alias("words"), *row_key())
    none = F.array().cast("array<int>")
    every = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1)).otherwise(none)
    kept = F.array_except(every, F.coalesce("hit", none))
    return rows.join(hits, KEY, "left").select(
        "row", F.transform(kept, lambda at: F.get(F.col("words"), at)).alias("kept_words")
    )
