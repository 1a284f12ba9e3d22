"""Text and JSON forms of results, one value per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNAUTHORIZED = "Unauthorized"
BAD_REQUEST = "bad request"


def _attribute(name: str, kind: str, value: Column) -> Column:
    return F.concat(F.lit(f'{name}\x03{{"{kind}":"'), value, F.lit('"}'))


def photo_item(userid: Column, time: Column, url: Column) -> Column:
    """Bulk-load line: attributes split by character 2, name and value by character 3."""
    return F.concat_ws(
        "\x02",
        _attribute("url", "s", url),
        _attribute("userid", "n", userid),
        _attribute("time", "s", time),
    )


def has_three_fields(userid: Column, time: Column, url: Column) -> Column:
    """Whether the fields, joined by tabs, split into three again; empty ones at the end do not count."""
    inner = F.concat(userid, time, url)
    return ~F.contains(inner, F.lit("\t")) & (url != "")


def response(err: Column, **members: Column) -> Column:
    """JSON object of ``members``, or of the error where there is one."""
    body = F.to_json(F.struct(*[value.alias(name) for name, value in members.items()]))
    return F.when(err.isNotNull(), F.to_json(F.struct(err.alias("err")))).otherwise(body)


def model_row(suggestions: Column) -> Column:
    """``word,prob`` pairs with tabs between them, from an array of ``(word, prob)``; a null probability is empty."""

    def pair(entry: Column) -> Column:
        return F.concat(entry["word"], F.lit(","), F.coalesce(entry["prob"].cast("string"), F.lit("")))

    return F.array_join(F.transform(suggestions, pair), "\t")


def path_line(seed: Column, vertex: Column, path: Column) -> Column:
    """``vertex``, ``seed`` and the path; the seed itself is written as a path from it to itself."""
    steps = F.when(vertex == seed, F.array(vertex, seed)).otherwise(path)
    return F.concat_ws("\t", vertex.cast("string"), seed.cast("string"), F.array_join(steps.cast("array<string>"), " "))
