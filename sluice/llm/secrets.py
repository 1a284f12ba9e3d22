"""Secrets: exact patterns, and words that a Markov model of random strings explains better than one of identifiers."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm._frames import let

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")
# fixed patterns of the base kinds
ASSIGN = (
    r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)"
)
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"  # runs are maximal, so a shorter one cannot hide a longer one
MIN_VALUE, MIN_ACCESS = 6, 20

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WORD = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
MIN_RANDOM = 16
MIN_IDENTIFIER = 6
#: Rows that the models are learnt from, by a hash of their texts: for random strings, and for identifiers.
RANDOM_ROWS = 200_000
IDENTIFIER_ROWS = 4_000
#: Log-likelihood ratio from which a word counts as random: a thousand to one, for each 16 characters.
MIN_RATIO = math.log(1000)
#: Pairs that the share of a letter counts for beside those seen.
PRIOR_PAIRS = 50
CHUNK = 128


def _found(text: Column, pattern: str) -> Column:
    """``(start, size, value)`` of each match of ``pattern`` in ``text``, in characters.

    Gaps and matches take turns. Their lengths are added up within chunks and then over chunks, so that many
    matches in one text cost little more than few.
    """
    pieces = F.struct(
        F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values")
    )

    def add(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda total, value: total + value)

    def with_sizes(p: Column) -> Column:
        sizes = F.zip_with(
            F.slice(p["gaps"], F.lit(1), F.size(p["values"])), p["values"], lambda gap, value: F.length(gap) + F.length(value)
        )
        return F.struct(p["gaps"].alias("gaps"), p["values"].alias("values"), sizes.alias("sizes"))

    def with_chunks(p: Column) -> Column:
        last = F.floor((F.size(p["sizes"]) - 1) / CHUNK).cast("int")
        sums = F.transform(F.sequence(F.lit(0), last), lambda k: add(F.slice(p["sizes"], k * CHUNK + 1, CHUNK)))
        return let(
            sums,
            lambda s: F.struct(
                p["gaps"].alias("gaps"),
                p["values"].alias("values"),
                p["sizes"].alias("sizes"),
                F.transform(F.sequence(F.lit(0), last), lambda k: add(F.slice(s, F.lit(1), k))).alias("before"),
            ),
        )

    def spans(p: Column) -> Column:
        def span(at: Column) -> Column:
            chunk = F.floor(at / CHUNK).cast("int")
            inside = add(F.slice(p["sizes"], chunk * CHUNK + 1, at % CHUNK))
            start = F.get(p["before"], chunk) + inside + F.length(F.get(p["gaps"], at))
            value = F.get(p["values"], at)
            return F.struct(start.alias("start"), F.length(value).alias("size"), value.alias("value"))

        return F.transform(F.sequence(F.lit(0), F.size(p["values"]) - 1), span)

    found = let(pieces, lambda p: let(with_sizes(p), lambda q: let(with_chunks(q), spans)))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<start:int,size:int,value:string>>"))


def _value(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGN, 2)


def base_matches(text: Column) -> Column:
    """``(kind, start, size, value)`` of the base kinds, kind by kind; ``kind`` is a place in ``KINDS``."""
    lower = F.lower(text)
    named = reduce(Column.__or__, [F.contains(lower, F.lit(name)) for name in NAMES])
    none = F.array().cast("array<struct<start:int,size:int,value:string>>")
    assign = F.when(named, _found(text, ASSIGN)).otherwise(none)
    parts = [
        F.filter(assign, lambda m: F.length(_value(m["value"])) >= MIN_VALUE),
        F.filter(_found(text, ACCESS), lambda m: m["size"] >= MIN_ACCESS),
        _found(text, HEX),
    ]

    def of_kind(kind: int, matches: Column) -> Column:
        return F.transform(
            matches,
            lambda m: F.struct(
                F.lit(kind).alias("kind"), m["start"].alias("start"), m["size"].alias("size"), m["value"].alias("value")
            ),
        )

    return F.concat(*[of_kind(kind, part) for kind, part in enumerate(parts)])


def _pairs(word: Column) -> Column:
    """Numbers of the pairs of neighbouring letters of ``word``."""
    width = len(LETTERS)
    codes = F.transform(F.split(word, ""), lambda letter: F.instr(F.lit(LETTERS), letter) - 1)
    return let(
        codes,
        lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - 2), lambda at: F.get(c, at) * width + F.get(c, at + 1)),
    )


def _sample(docs: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows with text, by a hash of it; all if there are no more."""
    total = max(1, docs.count())
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 20))
    return docs.select(F.col("text").cast("string").alias("text")).where(
        F.col("text").isNotNull() & (place < min(1.0, rows / total) * (1 << 20))
    )


def learn(docs: DataFrame, random_rows: int = RANDOM_ROWS, identifier_rows: int = IDENTIFIER_ROWS) -> list[float]:
    """The log-likelihood ratio of each pair of letters, random strings against identifiers.

    The patterns label the samples: values of base matches are random strings, words of texts without a base
    match are identifiers. What reaches the driver are two numbers for each pair of letters.
    """
    base = F.filter(
        F.transform(
            base_matches(F.col("text")),
            lambda m: F.when(m["kind"] == 0, _value(m["value"])).otherwise(m["value"]),
        ),
        lambda value: (F.length(value) >= MIN_RANDOM) & value.rlike("[0-9]") & ~value.contains("."),
    )
    random = _sample(docs, random_rows).select(F.explode(base).alias("word"), F.lit(1).alias("random"))
    plain = _sample(docs, identifier_rows).where(F.size(base_matches(F.col("text"))) == 0)
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD % MIN_IDENTIFIER), F.lit(0))
    identifiers = plain.select(F.explode(words).alias("word"), F.lit(0).alias("random"))
    counts = (
        random.unionByName(identifiers)
        .select("random", F.explode(_pairs(F.col("word"))).alias("pair"))
        .groupBy("random", "pair")
        .count()
        .collect()
    )
    width = len(LETTERS)
    tables = [[0.0] * width * width for _ in range(2)]
    for row in counts:
        if 0 <= row["pair"] < width * width:
            tables[row["random"]][row["pair"]] += row["count"]
    identifiers, random_strings = map(_log_shares, tables)
    return [a - b for a, b in zip(random_strings, identifiers, strict=True)]


def _log_shares(counts: list[float]) -> list[float]:
    """Logarithms of how likely each letter follows another; what is seldom seen leans on how often the letter comes at all."""
    width = len(LETTERS)
    letters = [1.0 + sum(counts[second::width]) for second in range(width)]
    total = sum(letters)
    found = []
    for first in range(width):
        row = counts[first * width : (first + 1) * width]
        known = sum(row) + PRIOR_PAIRS
        found += [math.log((n + PRIOR_PAIRS * letters[k] / total) / known) for k, n in enumerate(row)]
    return found


def random_words(text: Column, ratios: list[float]) -> Column:
    """``(kind, start, size, value)`` of the words with letters and digits that the model holds for random."""
    # one literal that Spark turns into an array once, not thousands of them
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")

    def is_random(m: Column) -> Column:
        ratio = F.aggregate(_pairs(m["value"]), F.lit(0.0), lambda total, pair: total + F.get(table, pair))
        return m["value"].rlike("[0-9]") & m["value"].rlike("[A-Za-z]") & (ratio * MIN_RANDOM >= m["size"] * MIN_RATIO)

    return F.transform(
        F.filter(_found(text, WORD % MIN_RANDOM), is_random),
        lambda m: F.struct(
            F.lit(len(BASE_KINDS)).alias("kind"), m["start"].alias("start"), m["size"].alias("size"), m["value"].alias("value")
        ),
    )


def find_secrets(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """``(row, spans)`` for each row of ``docs``: ``(start, kind, end)`` in characters, sorted; ``row`` holds all its columns.

    ``kind`` is a place in ``KINDS``. The base matches are always there; a random word is added where it overlaps
    none of them. A null or empty text has no spans. Rows do not depend on each other, so repeated rows get
    the same spans and an empty table gives no rows. A long text is searched whole, within its row.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def apart(base: Column):
        return lambda m: ~F.exists(
            base, lambda b: (b["start"] < m["start"] + m["size"]) & (m["start"] < b["start"] + b["size"])
        )

    found = let(base_matches(text), lambda base: F.concat(base, F.filter(random_words(text, ratios), apart(base))))
    spans = F.transform(
        found, lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), (m["start"] + m["size"]).alias("end"))
    )
    return docs.select(F.struct("*").alias("row"), F.array_sort(spans).alias("spans"))
