"""Readers: lines of text to typed rows. Lines of the wrong shape are left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import fields

LINE_BREAK = "\r\n|\r|\n"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line; ``\\r\\n``, ``\\r`` and ``\\n`` end a line."""
    return spark.read.text(path)


def split_lines(texts: DataFrame, text: str, *keep: str) -> DataFrame:
    """The lines of a text column, with the columns in ``keep``."""
    return texts.select(*keep, F.explode(F.split(F.col(text), LINE_BREAK)).alias("value"))


def _keep_valid(lines: DataFrame, valid: Column, rejects: Observation | None) -> DataFrame:
    valid = F.coalesce(valid, F.lit(False))
    if rejects is not None:
        lines = lines.observe(rejects, F.count_if(~valid).alias("rejected"))
    return lines.where(valid)


def parse_pages(lines: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """``id⇥title⇥date⇥body`` to ``(page_id, title, date, body)``.

    The body keeps its own tabs and must have one. ``rejects`` receives the number of
    lines left out as ``rejected``.
    """
    parts = F.split(F.col("value"), "\t", 4)
    valid = (F.size(parts) == 4) & F.contains(F.get(parts, F.lit(3)), F.lit("\t"))
    return _keep_valid(lines, valid, rejects).select(
        parts[0].alias("page_id"), parts[1].alias("title"), parts[2].alias("date"), parts[3].alias("body")
    )


def parse_arcs(lines: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """``src⇥dst`` to distinct ``(src, dst)``; further fields are ignored."""
    parts = fields(F.col("value"), "\t")
    return (
        _keep_valid(lines, F.size(parts) >= 2, rejects)
        .select(parts[0].alias("src"), parts[1].alias("dst"))
        .distinct()
    )


def parse_nodes(lines: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """``id⇥title`` to ``(id, title)``; further fields are ignored."""
    parts = fields(F.col("value"), "\t")
    return _keep_valid(lines, F.size(parts) >= 2, rejects).select(
        parts[0].alias("id"), parts[1].alias("title")
    )


def parse_counts(lines: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """``phrase⇥count`` to ``(phrase, cnt)``: two fields, the second a 64-bit integer."""
    parts = fields(F.col("value"), "\t")
    number = F.get(parts, F.lit(1))
    valid = (F.size(parts) == 2) & number.rlike("^[+-]?[0-9]+$") & number.try_cast("bigint").isNotNull()
    return _keep_valid(lines, valid, rejects).select(
        parts[0].alias("phrase"), number.try_cast("bigint").alias("cnt")
    )


def parse_photo_rows(lines: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """``userid,time,url`` to three strings; no quoting, empty fields at the end of the line do not count."""
    parts = fields(F.col("value"), ",")
    return _keep_valid(lines, F.size(parts) == 3, rejects).select(
        parts[0].alias("userid"), parts[1].alias("time"), parts[2].alias("url")
    )


def parse_edge_list(lines: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """Whitespace-separated ``src dst`` numbers to distinct ``(src, dst)``; ``#`` starts a comment line."""
    parts = F.split(F.trim(F.regexp_replace(F.col("value"), r"\s+", " ")), " ")
    src = parts[0].try_cast("bigint")
    dst = F.get(parts, F.lit(1)).try_cast("bigint")
    content = lines.where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return (
        _keep_valid(content, src.isNotNull() & dst.isNotNull(), rejects)
        .select(src.alias("src"), dst.alias("dst"))
        .distinct()
    )


def parse_pairs(lines: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """``src⇥dst`` numbers, nothing else on the line, to distinct ``(src, dst)``."""
    parts = F.split(F.col("value"), "\t")
    src, dst = (F.get(parts, F.lit(k)).try_cast("bigint") for k in (0, 1))
    content = lines.where(F.trim("value") != "")
    valid = (F.size(parts) == 2) & src.isNotNull() & dst.isNotNull()
    return _keep_valid(content, valid, rejects).select(src.alias("src"), dst.alias("dst")).distinct()


def parse_adjacency(lines: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """Whitespace-separated ``id degree neighbour...`` numbers to distinct ``(src, dst)``, an arc to each neighbour.

    A line is left out as a whole where the degree isn't the number of neighbours or anything is no number. A node may have
    several lines. Neighbours go from the line to rows and are never gathered by node.
    """
    spaced = F.trim(F.regexp_replace(F.col("value"), r"\s+", " "))
    fields_of = F.split(spaced, " ")
    read = lines.where(spaced != "").select(
        F.col("value"), F.transform(fields_of, lambda part: part.try_cast("bigint")).alias("numbers")
    )
    whole = ~F.exists("numbers", lambda number: number.isNull())
    valid = (F.size("numbers") >= 2) & whole & (F.get("numbers", F.lit(1)) == F.size("numbers") - 2)
    kept = _keep_valid(read, valid, rejects)
    arcs = kept.select(
        F.get("numbers", F.lit(0)).alias("src"), F.posexplode("numbers").alias("place", "dst")
    )
    return arcs.where("place >= 2").select("src", "dst").distinct()


#: Graph formats by name: distinct ``(src, dst)`` from lines.
GRAPH_FORMATS = {"snap": parse_edge_list, "tsv": parse_pairs, "adj": parse_adjacency}


def parse_graph(lines: DataFrame, format: str = "snap", rejects: Observation | None = None) -> DataFrame:
    """``(src, dst)`` from lines in a format of :data:`GRAPH_FORMATS`; ``rejects`` receives the lines left out as ``rejected``."""
    if format not in GRAPH_FORMATS:
        raise ValueError(f"format must be one of {', '.join(GRAPH_FORMATS)}, not {format!r}")
    return GRAPH_FORMATS[format](lines, rejects)


def read_graph(spark: SparkSession, path: str, format: str = "snap", rejects: Observation | None = None) -> DataFrame:
    """``(src, dst)`` from the files at ``path``."""
    return parse_graph(read_lines(spark, path), format, rejects)


def parse_seeds(lines: DataFrame) -> DataFrame:
    """Whitespace-separated numbers to distinct ``(seed)``."""
    words = lines.select(F.explode(F.split(F.col("value"), r"\s+")).alias("word"))
    return words.select(F.col("word").try_cast("bigint").alias("seed")).where("seed is not null").distinct()


def parse_friend_cells(cells: DataFrame) -> DataFrame:
    """``(userid, cell)`` with comma lists to distinct ``(userid, friend)``."""
    return cells.select("userid", F.explode(fields(F.col("cell"), ",")).alias("friend")).distinct()


def read_users(
    spark: SparkSession,
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
) -> DataFrame:
    """``(userid, password, name)`` from Parquet, or over JDBC.

    For a large table pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` among the JDBC options, so that it is read by many tasks.
    """
    if (path is None) == (jdbc is None):
        raise ValueError("give either path or jdbc")
    table = spark.read.parquet(path) if jdbc is None else spark.read.format("jdbc").options(**jdbc).load()
    return table.select("userid", "password", "name")


def read_photos(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("userid", "time", "url")
