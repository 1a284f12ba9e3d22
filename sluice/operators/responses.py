"""The flat answers as JSON, one row per request.

A user's friends and photos become one array here. The flat rows of the operators are the form for lists of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.forms import BAD_REQUEST, UNAUTHORIZED, response
from sluice.plans.skew import lookup_join


def login_response(answers: DataFrame) -> DataFrame:
    """``(userid, password, response)`` from the result of ``login``: ``{name}`` or ``{err}``."""
    return answers.select("userid", "password", response(F.col("err"), name=F.col("name")).alias("response"))


def _sorted_list(*fields: Column) -> Column:
    """An array of the rows of a group in the order of ``fields``."""
    return F.array_sort(F.collect_list(F.struct(*fields)))


def friends_response(requests: DataFrame, friends: DataFrame) -> DataFrame:
    """``(userid, response)`` per distinct user asked for: ``{friends: [{userid}]}`` in string order, or ``{err}``.

    ``friends`` is the result of ``friend_list``. A user without friends has an empty list.
    """
    lists = friends.groupBy("userid").agg(_sorted_list(F.col("friend").alias("userid")).alias("friends"))
    asked = requests.select("userid").distinct()
    none = F.array().cast("array<struct<userid:string>>")
    return lookup_join(asked, lists, "userid", how="left").select(
        "userid", response(_missing("userid"), friends=F.coalesce("friends", none)).alias("response")
    )


def photo_response(lookups: DataFrame) -> DataFrame:
    """``(userid, response)`` from the result of ``photo_lookup``: ``{time, url}`` or ``{err}``."""
    return lookups.select("userid", response(F.col("err"), time=F.col("time"), url=F.col("url")).alias("response"))


def timeline_response(answers: DataFrame, entries: DataFrame) -> DataFrame:
    """``(userid, password, response)`` from the results of ``login`` and ``timeline``.

    ``{name, photos: [{url, time, name}]}`` by time and name for a user who logs in, ``{name}`` for others, or ``{err}``.
    """
    photo = _sorted_list(F.col("time"), F.col("name"), F.col("url"))
    lists = entries.groupBy("userid").agg(photo.alias("sorted"))
    lists = lists.select(
        "userid",
        F.transform("sorted", lambda p: F.struct(p["url"].alias("url"), p["time"].alias("time"), p["name"].alias("name"))).alias("photos"),
    )
    none = F.array().cast("array<struct<url:string,time:string,name:string>>")
    photos = F.when(F.col("name") != UNAUTHORIZED, F.coalesce("photos", none))
    return lookup_join(answers, lists, "userid", how="left").select(
        "userid", "password", response(F.col("err"), name=F.col("name"), photos=photos).alias("response")
    )


def suggest_response(suggestions: DataFrame) -> DataFrame:
    """``(term, response)`` from the result of ``suggest``: ``[{label, probability}]``, the likeliest first."""
    entry = _sorted_list(F.col("rank"), F.col("label"), F.col("probability"))
    entries = F.transform(entry, lambda e: F.struct(e["label"].alias("label"), e["probability"].alias("probability")))
    return suggestions.groupBy("term").agg(F.to_json(entries).alias("response"))


def _missing(name: str) -> Column:
    return F.when(F.col(name).isNull(), F.lit(BAD_REQUEST))
