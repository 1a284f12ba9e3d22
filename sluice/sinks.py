"""Text forms of the results, one line per row. Parquet is the better choice between jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.forms import model_row, path_line
from sluice.operators.langmodel import pack_model


def _write_lines(lines: DataFrame, path: str, mode: str) -> None:
    lines.write.mode(mode).text(path)


def write_counts(counts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``phrase⇥count``"""
    _write_lines(counts.select(F.concat_ws("\t", "phrase", F.col("cnt").cast("string"))), path, mode)


def write_model(model: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``prefix⇥word,prob⇥word,prob…``"""
    packed = pack_model(model)
    _write_lines(packed.select(F.concat_ws("\t", "prefix", model_row(F.col("suggestions")))), path, mode)


def write_ranked(ranked: DataFrame, value: str, path: str, mode: str = "errorifexists") -> None:
    """``title⇥value``"""
    _write_lines(ranked.select(F.concat_ws("\t", "title", F.col(value).cast("string"))), path, mode)


def write_paths(paths: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``id⇥seed⇥path`` in one folder per seed."""
    lines = paths.select("seed", path_line(F.col("seed"), F.col("id"), F.col("path")).alias("value"))
    lines.write.mode(mode).partitionBy("seed").text(path)


def write_items(export: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The bulk-load lines of ``photo_export``."""
    _write_lines(export.select("item"), path, mode)
