"""N-grams, term and document frequencies, TF-IDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import line_words, page_words
from sluice.plans.layout import cut
from sluice.plans.skew import SkewLimits, hot_keys, lookup_join
from sluice.session import shuffle_partitions

MAX_WORDS = 5
#: Bytes of lines that one task counts by itself, and of one key's lines from which they are dealt out to several.
BYTES_PER_TASK = 4 << 20
KEY_LIMITS = SkewLimits(min_rows=16 << 20)


def ngrams(lines: DataFrame, *keep: str, max_words: int = MAX_WORDS, line: str = "value") -> DataFrame:
    """Every run of 1 to ``max_words`` words of each line as ``phrase``, with the columns in ``keep``.

    Two explodes and plain concatenations: both stay in generated code and feed a following
    aggregate row by row, without a nested array per line. The outer explode keeps Spark from
    testing the array's size first, which would cut the line into words twice.
    """
    words = lines.select(*keep, line_words(F.col(line)).alias("words"))
    starts = words.select(
        *keep, "words", F.size("words").alias("total"), F.posexplode_outer("words").alias("start", "word")
    ).where("word <> ''")

    def run(size: int) -> Column:
        if size == 1:
            return F.col("word")
        tail = [F.get(F.col("words"), F.col("start") + step) for step in range(1, size)]
        fits = F.col("start") + (size - 1) < F.col("total")
        return F.when(fits, F.concat(*_with_spaces([F.col("word"), *tail])))

    runs = F.array(*[run(size) for size in range(1, max_words + 1)])
    return starts.select(*keep, F.explode(runs).alias("phrase")).where("phrase is not null")


def ngrams_by_key(
    lines: DataFrame, key: str, max_words: int = MAX_WORDS, line: str = "value", limits: SkewLimits = KEY_LIMITS
) -> DataFrame:
    """``(key, phrase, cnt)``: how often each run of 1 to ``max_words`` words is in the lines of a ``key``.

    The lines of a key, which are many times smaller than their phrases, are brought together in one task and counted there, so
    phrases are not shuffled. Only those of a key with more than ``limits`` of bytes are counted where they are and summed up.
    """
    count = F.count(F.lit(1)).alias("cnt")
    size = F.coalesce(F.octet_length(line), F.lit(0)) + 1
    weights = cut(lines.groupBy(key).agg(F.sum(size).cast("bigint").alias("weight")))
    total = weights.agg(F.sum("weight").alias("total")).first()["total"] or 0
    hot = cut(hot_keys(weights, key, "weight", limits))
    partitions = max(shuffle_partitions(lines.sparkSession), -(-total // BYTES_PER_TASK))

    def counted(rows: DataFrame) -> DataFrame:
        return ngrams(rows, key, max_words=max_words, line=line).groupBy(key, "phrase").agg(count)

    rows = lines.select(key, line)
    if hot.isEmpty():
        return counted(rows.repartition(partitions, key))
    marked = rows.withColumn("hot", F.xxhash64(key))
    usual = marked.join(F.broadcast(hot), "hot", "left_anti").select(key, line)
    large = marked.join(F.broadcast(hot), "hot", "left_semi").select(key, line)
    return counted(usual.repartition(partitions, key)).unionByName(counted(large))


def _with_spaces(words: list[Column]) -> list[Column]:
    spaced = [words[0]]
    for word in words[1:]:
        spaced += [F.lit(" "), word]
    return spaced


def page_tokens(pages: DataFrame) -> DataFrame:
    """One ``(title, word)`` per word of each page; a page without words gives one empty word."""
    return pages.select("title", F.explode(page_words(F.col("body"))).alias("word"))


def term_frequency(pages: DataFrame) -> DataFrame:
    """``(word, title, tf)``; pages of one title count as one."""
    return page_tokens(pages).groupBy("word", "title").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(pages: DataFrame) -> DataFrame:
    """``(word, df)``: in how many titles a word occurs."""
    return (
        page_tokens(pages).distinct().groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    )


def _check_mode(n_mode: str) -> None:
    if n_mode not in ("tokens", "documents"):
        raise ValueError(f"n_mode must be 'tokens' or 'documents', not {n_mode!r}")


def tfidf(pages: DataFrame, n_mode: str = "tokens") -> DataFrame:
    """``(word, title, tf, df, score)`` with score ``tf * ln(N / df)``.

    N is the number of tokens, or with ``n_mode='documents'`` the number of titles. The pages are
    read and cut into words once: word totals, N and the result all come from one shuffle of the
    term frequencies.
    """
    _check_mode(n_mode)
    tf = term_frequency(pages)
    # every title of a word adds at least one occurrence, so this filter drops nothing; it keeps
    # both aggregates in every use of the word totals, which lets Spark share their shuffle
    words = (
        tf.groupBy("word")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("occurrences"))
        .where("occurrences >= df")
    )
    if n_mode == "tokens":
        total = words.agg(F.sum("occurrences").alias("n")).scalar()
    else:
        total = tf.where("tf > 0").select("title").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    scored = lookup_join(tf, words.select("word", "df"), "word")
    return scored.select("word", "title", "tf", "df", (F.col("tf") * F.log(total / F.col("df"))).alias("score"))


def tfidf_term(pages: DataFrame, term: str, n_mode: str = "tokens") -> DataFrame:
    """``(title, score)`` of the titles that hold ``term``, best first; pages without a title are left out.

    Occurrences are counted inside each page, so one row per page is shuffled rather than one
    per word. The row per title that comes of it is written, since document frequency and N are needed
    before the scores: the pages are read once.
    """
    _check_mode(n_mode)
    words = page_words(F.col("body"))
    per_page = pages.select(
        "title",
        F.size(words).alias("words"),
        (F.size(words) - F.size(F.array_remove(words, term))).alias("hits"),
    )
    per_title = cut(per_page.groupBy("title").agg(F.sum("words").alias("words"), F.sum("hits").alias("tf")))
    totals = per_title.agg(
        F.sum("words").alias("tokens"),
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("tf") > 0).alias("df"),
    )
    n = totals.select(n_mode).scalar()
    df = totals.select("df").scalar()
    return (
        per_title.where((F.col("tf") > 0) & (F.col("title") != ""))
        .select("title", (F.col("tf") * F.log(n / df)).alias("score"))
        .orderBy(F.desc("score"), "title")
    )
