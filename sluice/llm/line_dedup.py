"""Lines that many documents share, by levelled sorted runs of line hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm._frames import KEY, ascii_lower, hashes, row_key, written

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
#: Runs of one level that are merged into one of the next.
RUNS_PER_LEVEL = 2
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def _merged(runs: list[DataFrame]) -> DataFrame:
    return (
        reduce(DataFrame.unionByName, runs)
        .groupBy("h1", "h2")
        .agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))
    )


def _sorted_run(rows: DataFrame) -> DataFrame:
    return written(rows.sortWithinPartitions("h1", "h2"))


class LineRuns:
    """Runs of ``(h1, h2, docs, last)``, sorted by the hash pair of a line, on levels.

    Batches come in falling order of document ids, so the batch that first brings a line also holds
    the largest id with it: its run gives ``last``, and later ones only add to the number of documents.
    """

    def __init__(self, runs_per_level: int = RUNS_PER_LEVEL):
        self._most = runs_per_level
        self.levels: list[list[DataFrame]] = []

    def add(self, batch: DataFrame) -> None:
        """Take in a batch ``(id, h1, h2)``; a document may hold a line more than once."""
        mine = batch.distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("last"))
        runs = [run for level in self.levels for run in level]
        if runs:
            mine = written(mine)
            known = reduce(DataFrame.unionByName, [run.where("last is not null").select("h1", "h2") for run in runs])
            new = mine.join(known.hint("merge"), ["h1", "h2"], "left_anti")
            seen = mine.join(known.hint("merge"), ["h1", "h2"], "left_semi").withColumn("last", F.lit(None).cast("bigint"))
            mine = new.unionByName(seen)
        self._put(_sorted_run(mine), 0)

    def _put(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self._most:
            merged = _sorted_run(_merged(self.levels[level]))
            self.levels[level] = []
            self._put(merged, level + 1)

    def lines(self) -> DataFrame:
        return _merged([run for level in self.levels for run in level])


def shared_lines(lines: DataFrame, min_docs: int, batches: int, runs_per_level: int) -> DataFrame:
    """``(h1, h2, last)`` of the lines ``(id, h1, h2)`` that ``min_docs`` documents hold."""
    cuts = lines.approxQuantile("id", [k / batches for k in range(batches - 1, 0, -1)], 0.01) if batches > 1 else []
    bounds = [None, *dict.fromkeys(int(cut) for cut in cuts), None]
    runs = LineRuns(runs_per_level)
    for above, below in zip(bounds, bounds[1:], strict=False):
        part = lines
        if above is not None:
            part = part.where(F.col("id") < above)
        if below is not None:
            part = part.where(F.col("id") >= below)
        runs.add(part)
    return runs.lines().where(F.col("docs") >= min_docs).select("h1", "h2", "last")


def line_dedup(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    runs_per_level: int = RUNS_PER_LEVEL,
) -> DataFrame:
    """``(row, n_lines, n_dropped, kept_text)`` for each row of ``docs``; ``row`` holds all its columns.

    A line's key is the line without blanks at its ends and with A-Z lower-cased. Keys of at least ``min_chars``
    characters that ``min_docs`` documents hold lose all their lines but those of the largest id.
    A null or empty text is one empty line. Rows of one id are one document, each with its
    own lines; rows without an id are one document before all others. An empty table gives no rows. A text of any length is
    cut into lines within its row, and all its long lines leave it as hashes.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"), *row_key())
    lines = rows.select(*KEY, F.posexplode(_lines(F.col("text"))).alias("place", "line"))
    keyed = lines.select(*KEY, "place", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    h1, h2 = hashes(F.col("key"))
    long_lines = written(keyed.select(*KEY, "place", h1.alias("h1"), h2.alias("h2")))
    shared = shared_lines(long_lines.select(F.col("_id").alias("id"), "h1", "h2"), min_docs, batches, runs_per_level)
    dropped = (
        long_lines.join(written(shared).hint("merge"), ["h1", "h2"])
        .where("_id <> last")
        .groupBy(*KEY)
        .agg(F.collect_set("place").alias("dropped"))
    )
    parts = _lines(F.col("text"))
    places = F.sequence(F.lit(0), F.size(parts) - 1)
    kept = F.array_join(
        F.transform(F.array_except(places, F.col("dropped")), lambda place: F.get(F.col("parts"), place)), "\n"
    )
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (
        rows.join(dropped.hint("merge"), KEY, "left")
        .withColumn("parts", F.when(F.col("dropped").isNotNull(), parts))
        .select(
            "row",
            F.size(parts).cast("bigint").alias("n_lines"),
            F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
            F.when(F.col("dropped").isNull(), whole).otherwise(kept).alias("kept_text"),
        )
    )
