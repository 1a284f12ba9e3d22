"""Next-word language model over n-gram counts, and look-ups in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.text import last_word, query_term, words_before_last
from sluice.plans.skew import lookup_join


def prefix_rows(counts: DataFrame) -> DataFrame:
    """``(prefix, word, cnt)``: each phrase of ``counts`` under itself, without a word, and under what comes before its last word."""
    phrase = F.col("phrase")
    own = F.struct(phrase.alias("prefix"), F.lit(None).cast("string").alias("word"), "cnt")
    after = F.struct(words_before_last(phrase).alias("prefix"), last_word(phrase).alias("word"), "cnt")
    return counts.select(F.explode(F.array(own, after)).alias("row")).select("row.*").where("prefix <> ''")


def rank_words(rows: DataFrame, k: int = 5) -> DataFrame:
    """``(prefix, rank, word, cnt, prob)`` from ``(prefix, word, cnt)``: the ``k`` likeliest words of each prefix.

    A prefix's own row, which has no word, comes first, so ``k + 1`` rows are enough; Spark applies that limit before
    the shuffle as well, and a prefix with many continuations sends few rows from each task.
    """
    order = Window.partitionBy("prefix").orderBy(F.col("word").isNotNull(), F.desc("cnt"), "word")
    best = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    base = F.max(F.when(F.col("word").isNull(), F.col("cnt"))).over(Window.partitionBy("prefix"))
    ranked = best.withColumn("base", base).withColumn("rank", F.col("place") - F.col("base").isNotNull().cast("int"))
    return ranked.where(F.col("word").isNotNull() & (F.col("rank") <= k)).select(
        "prefix", "rank", "word", "cnt", F.try_divide("cnt", "base").alias("prob")
    )


def language_model(counts: DataFrame, k: int = 5, threshold: int = 2) -> DataFrame:
    """``(prefix, rank, word, cnt, prob)``: the ``k`` likeliest next words of each prefix.

    ``counts`` is ``(phrase, cnt)``, one row per phrase; only counts above ``threshold`` are used.
    ``prob`` is null where the prefix itself has no such count. Each frequent phrase gives a row under
    itself and one under its prefix; they meet in one shuffle by prefix.
    """
    return rank_words(prefix_rows(counts.where(F.col("cnt") > threshold)), k)


def pack_model(model: DataFrame) -> DataFrame:
    """``(prefix, suggestions)`` with the at most k ``(word, prob)`` of a prefix as an array in rank order."""
    entry = F.struct("rank", "word", "prob")
    packed = model.groupBy("prefix").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    return packed.select(
        "prefix",
        F.transform("entries", lambda e: F.struct(e["word"].alias("word"), e["prob"].alias("prob"))).alias(
            "suggestions"
        ),
    )


def suggest(terms: DataFrame, model: DataFrame) -> DataFrame:
    """``(term, rank, label, probability)`` for each distinct term the model knows.

    ``terms`` has a column ``term``, ``model`` is the result of :func:`language_model`. All words of
    a prefix share its count as denominator, so the model's rank is the order by probability,
    highest first, then by label. A term without a model row gives no rows.
    """
    asked = terms.select("term").where("term is not null").distinct()
    asked = asked.withColumn("prefix", query_term(F.col("term")))
    entries = model.select("prefix", "rank", F.col("word").alias("label"), F.col("prob").alias("probability"))
    return lookup_join(asked, entries, "prefix").select("term", "rank", "label", "probability")
