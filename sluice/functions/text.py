"""Column expressions over text; all of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what counts as blank around a query term (space, tab, line feed, return, NUL, vertical tab)
TERM_BLANKS = " \t\n\r\0\x0b"

# fixed pattern: markup
MARKUP = "<[^>]*>"
# fixed value: a written-out line break
LINE_BREAK = r"\n"


def line_words(line: Column) -> Column:
    """Lower-case ASCII words of a line; a line without any gives one empty string."""
    spaced = F.regexp_replace(line, "[^a-zA-Z]+", " ")
    return F.split(F.lower(F.trim(spaced)), " ")


def page_words(body: Column) -> Column:
    """Words of a page body without markup; a body without any gives one empty string.

    Up to the last ``>`` every ``<`` is closed, and behind it none is, so markup is only looked for in front of it and no
    ``<`` is followed to the end of the text in vain. Markup and line breaks become spaces by themselves, so the pattern that meets
    every character has one class and no alternatives, which cost many times as much.
    """
    tail = F.substring_index(body, ">", -1)
    head = F.substring(body, F.lit(1), F.length(body) - F.length(tail))
    bare = F.concat(F.regexp_replace(head, MARKUP, " "), tail)
    return line_words(F.replace(bare, F.lit(LINE_BREAK), F.lit(" ")))


def last_word(phrase: Column) -> Column:
    return F.substring_index(phrase, " ", -1)


def words_before_last(phrase: Column) -> Column:
    """What stands before the last space; empty when there is no space or nothing before it."""
    return F.substring(phrase, F.lit(1), F.length(phrase) - F.length(last_word(phrase)) - 1)


def query_term(term: Column) -> Column:
    return F.lower(F.btrim(term, F.lit(TERM_BLANKS)))


def fields(line: Column, separator: str) -> Column:
    """Parts of a line between single-character separators, less the empty ones at its end."""
    parts = F.split(F.rtrim(line, F.lit(separator)), separator)
    only_separators = (F.length(line) > 0) & (F.length(F.rtrim(line, F.lit(separator))) == 0)
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(parts)
