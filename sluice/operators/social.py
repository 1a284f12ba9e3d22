"""Login, friend lists, photo look-ups, the photo timeline and the photo bulk export.

A table of requests is a set: each distinct request is answered once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.forms import BAD_REQUEST, UNAUTHORIZED, has_three_fields, photo_item
from sluice.plans.skew import lookup_join
from sluice.sources.text import parse_friend_cells

#: Rows of equal copies that one task writes out.
COPIES_PER_CHUNK = 100_000


def _error(*needed: str):
    missing = F.lit(False)
    for name in needed:
        missing = missing | F.col(name).isNull()
    return F.when(missing, F.lit(BAD_REQUEST)).alias("err")


def _latest_photos(photos: DataFrame) -> DataFrame:
    """One photo per user: of several, the latest."""
    item = F.max(F.struct("time", "url"))
    return photos.groupBy("userid").agg(item.alias("photo")).select("userid", "photo.time", "photo.url")


def login(requests: DataFrame, users: DataFrame) -> DataFrame:
    """``(userid, password, name, err)`` for each distinct ``(userid, password)`` asked.

    ``name`` is ``Unauthorized`` unless the password is the user's. A request without id or password
    has an ``err`` and no name. The join is on id and password together, so many tries for one
    user do not meet in one task.
    """
    asked = requests.select("userid", "password").distinct()
    accounts = users.groupBy("userid", "password").agg(F.max("name").alias("name"))
    return asked.join(accounts, ["userid", "password"], "left").select(
        "userid",
        "password",
        F.when(
            F.col("userid").isNotNull() & F.col("password").isNotNull(),
            F.coalesce("name", F.lit(UNAUTHORIZED)),
        ).alias("name"),
        _error("userid", "password"),
    )


def friend_list(cells: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """``(userid, friend)``: the distinct friends of each user in string order, one row each.

    Rows, not one array per user: a list may be of any length, and sorting by user and friend
    can split it over several tasks. With ``requests`` only the users asked for are listed.
    """
    friends = parse_friend_cells(cells)
    if requests is not None:
        asked = requests.select("userid").where("userid is not null").distinct()
        friends = lookup_join(friends, asked, "userid")
    return friends.select("userid", "friend").orderBy("userid", "friend")


def photo_lookup(requests: DataFrame, photos: DataFrame) -> DataFrame:
    """``(userid, time, url, err)``: the photo of each distinct user asked for, empty strings where there is none."""
    asked = requests.select("userid").distinct()
    return asked.join(_latest_photos(photos), "userid", "left").select(
        "userid",
        F.when(F.col("userid").isNotNull(), F.coalesce("time", F.lit(""))).alias("time"),
        F.when(F.col("userid").isNotNull(), F.coalesce("url", F.lit(""))).alias("url"),
        _error("userid"),
    )


def timeline(
    requests: DataFrame,
    users: DataFrame,
    cells: DataFrame,
    photos: DataFrame,
) -> DataFrame:
    """``(userid, time, name, url)``: the photos of the friends of each user who logs in, by time and name.

    A friend unknown to ``users`` is called ``Unauthorized``, one without a photo has empty strings. Of
    entries with equal time and name, that of the friend whose id is smallest as a string is kept.
    Users and photos are first joined with each other, where ids are unique, so that the
    friendships, in which one id may be very frequent, are joined once.
    """
    admitted = (
        login(requests, users)
        .where(F.col("err").isNull() & (F.col("name") != UNAUTHORIZED))
        .select("userid")
        .distinct()
    )
    names = users.groupBy("userid").agg(F.max("name").alias("name"))
    profiles = names.join(_latest_photos(photos), "userid", "full").withColumnRenamed("userid", "friend_id")
    key_type = profiles.schema["friend_id"].dataType
    friends = lookup_join(parse_friend_cells(cells), admitted, "userid")
    # ids that are no key of the type become null: they match nobody, and are kept apart from the
    # join so that they do not meet in one task
    friends = friends.withColumn("friend_id", F.col("friend").try_cast(key_type))
    known = lookup_join(friends.where("friend_id is not null"), profiles, "friend_id", how="left")
    strange = friends.where("friend_id is null").select(
        "userid", "friend", *[F.lit(None).cast("string").alias(name) for name in ("name", "time", "url")]
    )
    entries = (
        known.select("userid", "friend", "name", "time", "url")
        .unionByName(strange)
        .select(
            "userid",
            "friend",
            F.coalesce("name", F.lit(UNAUTHORIZED)).alias("name"),
            F.coalesce("time", F.lit("")).alias("time"),
            F.coalesce("url", F.lit("")).alias("url"),
        )
    )
    return (
        entries.groupBy("userid", "time", "name")
        .agg(F.min_by("url", "friend").alias("url"))
        .orderBy("userid", "time", "name")
    )


def photo_export(rows: DataFrame, copies_per_chunk: int = COPIES_PER_CHUNK) -> DataFrame:
    """``(userid, item)``: one bulk-load line per ``(userid, time, url)`` row, clustered and sorted by user.

    A row whose fields hold a tab, or whose url is empty, is no line of three tab-separated fields and is left out.

    Ranges of user, time and url cut a frequent user over several tasks. Equal rows are counted and
    cut into chunks first, since ranges could not part them, and written out again afterwards.
    """
    valid = rows.where(has_three_fields(F.col("userid"), F.col("time"), F.col("url")))
    counted = valid.groupBy("userid", "time", "url").agg(F.count(F.lit(1)).alias("copies"))
    chunks = counted.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.ceil(F.col("copies") / copies_per_chunk) - 1))
    )
    order = ["userid", "time", "url", "chunk"]
    ranged = chunks.repartitionByRange(*order).sortWithinPartitions(*order)
    in_chunk = F.least(F.lit(copies_per_chunk), F.col("copies") - F.col("chunk") * copies_per_chunk)
    return ranged.select(
        "userid",
        photo_item(F.col("userid"), F.col("time"), F.col("url")).alias("item"),
        F.explode(F.sequence(F.lit(1), in_chunk)).alias("copy"),
    ).drop("copy")
