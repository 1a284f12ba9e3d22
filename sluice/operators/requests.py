"""Requests as they arrive: a path with a query string, to the answer as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.forms import BAD_REQUEST
from sluice.operators.responses import friends_response, login_response, photo_response, timeline_response
from sluice.operators.social import friend_list, login, photo_lookup, timeline
from sluice.plans.layout import cut

# fixed values: the sixth character of a path names what is asked for
LOGIN, FRIENDS, PHOTO, TIMELINE = "1", "2", "3", "4"


def parameters(request: Column) -> Column:
    """The ``(name, value)`` pairs of a request's query string in order, unescaped; null where an escape is broken.

    A name may come any number of times. Without ``=`` a parameter's value is empty. What follows ``#`` does not count.
    """
    before = F.substring_index(request, "#", 1)
    asked = F.contains(before, F.lit("?"))
    path = F.substring_index(before, "?", 1)
    query = F.when(asked, F.substring(before, F.length(path) + 2, F.length(before))).when(~asked, "")
    parts = F.filter(F.split(query, "&"), lambda part: part != "")

    def pair(part: Column) -> Column:
        name = F.substring_index(part, "=", 1)
        value = F.substring(part, F.length(name) + 2, F.length(part))
        return F.struct(F.try_url_decode(name).alias("name"), F.try_url_decode(value).alias("value"))

    pairs = F.transform(parts, pair)
    broken = F.exists(pairs, lambda p: p["name"].isNull() | p["value"].isNull())
    return F.when(~broken, pairs)


def only_value(pairs: Column, name: str) -> Column:
    """The value of the parameter that is there exactly once, else null."""
    values = F.filter(pairs, lambda p: p["name"] == name)
    return F.when(F.size(values) == 1, F.get(values, F.lit(0))["value"])


def parse_requests(lines: DataFrame, request: str = "value") -> DataFrame:
    """``(request, route, userid, password)``: ids and passwords as text, null where they are missing or repeated."""
    text = F.col(request)
    read = lines.select(text.alias("request"), parameters(text).alias("pairs"))
    return read.select(
        "request",
        F.substring(F.substring_index(F.substring_index("request", "#", 1), "?", 1), 6, 1).alias("route"),
        only_value(F.col("pairs"), "id").alias("userid"),
        only_value(F.col("pairs"), "pwd").alias("password"),
    )


def _as_text(table: DataFrame) -> DataFrame:
    return table.withColumn("userid", F.col("userid").cast("string"))


def answer_requests(requests: DataFrame, users: DataFrame, cells: DataFrame, photos: DataFrame) -> DataFrame:
    """``(request, response)`` for each distinct request of :func:`parse_requests`, by its route; ``{}`` for any other route.

    An id is compared as text with the ids of the tables. A request that lacks a parameter, or has it more than once,
    is a bad request for the routes that want it; these are answered by themselves and take no part in joins.
    """
    # read seven times below
    asked = cut(requests.where("request is not null").distinct())
    users, cells, photos = _as_text(users), _as_text(cells), _as_text(photos)
    wants_password = F.col("route").isin(LOGIN, TIMELINE)
    known = F.col("route").isin(LOGIN, FRIENDS, PHOTO, TIMELINE)
    complete = F.col("userid").isNotNull() & (F.col("password").isNotNull() | ~wants_password)
    refused = asked.where(~known | ~complete).select(
        "request",
        F.when(known, F.to_json(F.struct(F.lit(BAD_REQUEST).alias("err")))).otherwise(F.lit("{}")).alias("response"),
    )
    good = asked.where(known & complete)

    def of(route: str) -> DataFrame:
        return good.where(F.col("route") == route).select("request", "userid", "password")

    def back(route: str, answers: DataFrame, *keys: str) -> DataFrame:
        return of(route).join(answers.select(*keys, "response").hint("merge"), list(keys)).select("request", "response")

    entries = timeline(of(TIMELINE), users, cells, photos)
    return (
        refused.unionByName(back(LOGIN, login_response(login(of(LOGIN), users)), "userid", "password"))
        .unionByName(back(FRIENDS, friends_response(of(FRIENDS), friend_list(cells, of(FRIENDS))), "userid"))
        .unionByName(back(PHOTO, photo_response(photo_lookup(of(PHOTO), photos)), "userid"))
        .unionByName(
            back(TIMELINE, timeline_response(login(of(TIMELINE), users), entries), "userid", "password")
        )
    )
