"""The driver's tables seen as the inputs of the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.operators.textstats import ngrams
from sluice.sources.text import split_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")


def lines(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return split_lines(documents(spark, sf_dir), "text", *keep)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("title"), F.col("text").alias("body"))


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated page records; every seventh lacks the tab its body must have."""
    docs = documents(spark, sf_dir)
    head = F.concat_ws("\t", F.col("doc_id").cast("string"), "source", "lang")
    body = F.when(F.col("doc_id") % 7 == 0, F.col("text")).otherwise(F.concat(F.lit("\t"), "text"))
    return docs.select(F.concat_ws("\t", head, body).alias("value"))


def asked_terms(benchmark: DataFrame) -> DataFrame:
    """Every run of one to four words of the benchmark texts, the first word of each padded, and unknown terms."""
    words = F.split("text", " ")
    runs = ngrams(split_lines(benchmark, "text"), max_words=4).select(F.col("phrase").alias("term"))
    padded = F.concat(F.lit(" \t"), F.upper(words[0]), F.lit(" "))
    unknown = F.concat(F.lit("qzx "), F.col("item_id").cast("string"))
    return runs.unionByName(benchmark.select(F.explode(F.array(padded, unknown)).alias("term")))


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asked_terms(table(spark, sf_dir, "benchmark")).distinct()


def arcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From each order line's part to that of the next line of the order."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_partkey").alias("src"), F.lead("l_partkey").over(order).alias("dst"))
        .where("dst is not null")
        .distinct()
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))


def adjacency_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line for each order: a node, its degree, and the parts as neighbours; of every seventh order the degree is wrong,
    and of every eleventh one neighbour is no number."""
    listed = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("lines"))
    )
    key = F.col("l_orderkey")
    degree = F.size("lines") + F.when(key % 7 == 0, 1).otherwise(0)
    parts = F.transform("lines", lambda line: line["l_partkey"].cast("string"))
    neighbours = F.when(key % 11 == 0, F.concat(F.slice(parts, 1, F.size("lines") - 1), F.array(F.lit("x")))).otherwise(parts)
    return listed.select(F.concat(key.cast("string"), F.lit("  "), degree.cast("string"), F.lit("\t"), F.array_join(neighbours, " ")).alias("value"))


def many_seeds(links: DataFrame) -> DataFrame:
    """The 64 targets with most in-arcs."""
    return seeds(links, 64)


def seeds(links: DataFrame, most: int = 2) -> DataFrame:
    """The ``most`` targets with most in-arcs."""
    return (
        links.groupBy(F.col("dst").alias("seed"))
        .agg(F.count(F.lit(1)).alias("degree"))
        .orderBy(F.desc("degree"), "seed")
        .limit(most)
        .select("seed")
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("userid"), F.col("c_mktsegment").alias("password"), F.col("c_name").alias("name")
    )


def login_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the passwords wrong, unknown users, and requests without id or password."""
    customer = table(spark, sf_dir, "customer")
    tried = F.when(F.col("c_custkey") % 3 == 0, F.lit("guess")).otherwise(F.col("c_mktsegment"))
    real = customer.select(F.col("c_custkey").alias("userid"), tried.alias("password"))
    unknown = customer.select((F.col("c_custkey") + 10_000_000_000).alias("userid"), F.lit("x").alias("password"))
    broken = customer.select(
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).alias("userid"),
        F.when(F.col("c_custkey") % 2 == 1, F.col("c_mktsegment")).alias("password"),
    )
    return real.unionByName(unknown).unionByName(broken)


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each customer a request to each route: plain, with an id twice, without one, with an empty one, escaped, with a broken escape,
    among other parameters, or with a name only; some passwords are wrong and some come twice."""
    customer = table(spark, sf_dir, "customer")
    key, word = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    routes = customer.select("c_custkey", "c_mktsegment", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("route"))
    kind = (F.col("c_custkey") + F.col("route")) % 8
    asked = (
        F.when(kind == 0, F.concat(F.lit("id="), key))
        .when(kind == 1, F.concat(F.lit("id="), key, F.lit("&id="), key))
        .when(kind == 2, F.lit("x=2"))
        .when(kind == 3, F.lit("id="))
        .when(kind == 4, F.concat(F.lit("%69d="), F.regexp_replace(key, "([0-9])", "%3$1")))
        .when(kind == 5, F.concat(F.lit("id=%zz"), key))
        .when(kind == 6, F.concat(F.lit("&&x=1&id="), key, F.lit("&=3&id2=7")))
        .otherwise(F.lit("id"))
    )
    tried = F.when(F.col("c_custkey") % 3 == 0, F.lit("guess")).otherwise(word)
    escaped = F.concat(F.lit("%"), F.hex(F.substring(tried, 1, 1)), F.substring(tried, 2, 100))
    password = F.concat(F.lit("&pwd="), F.when(kind == 4, escaped).otherwise(tried))
    twice = F.when(F.col("c_custkey") % 11 == 0, F.lit("&pwd=")).otherwise(F.lit(""))
    end = F.when(kind == 6, F.lit("#id=5")).otherwise(F.lit(""))
    return routes.select(
        F.concat(F.lit("/step"), F.col("route").cast("string"), F.lit("?"), asked, password, twice, end).alias("value")
    )


def friend_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order one cell of two friends, with empty parts at its end for every other order.

    Friends range over a few more ids than there are customers, so that some are unknown.
    """
    ids = table(spark, sf_dir, "customer").agg((F.count(F.lit(1)) + 10).alias("ids")).scalar()
    first = (F.col("o_orderkey") % ids).cast("string")
    second = ((F.col("o_orderkey") + F.col("o_custkey") * 7) % ids).cast("string")
    tail = F.when(F.col("o_orderkey") % 2 == 0, F.lit(",,")).otherwise(F.lit(""))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("userid"), F.concat(first, F.lit(","), second, tail).alias("cell")
    )


def photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("userid"))
        .agg(F.max("o_orderdate").alias("date"), F.max("o_orderkey").alias("number"))
        .select("userid", F.date_format("date", "yyyy-MM-dd").alias("time"), F.col("number").cast("string").alias("url"))
    )


def photo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV line per order; some with a field too few or too many, some with empty fields at the end."""
    line = F.concat_ws(
        ",",
        F.col("o_custkey").cast("string"),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.col("o_orderkey").cast("string"),
    )
    kind = F.col("o_orderkey") % 10
    value = (
        F.when(kind == 0, F.concat_ws(",", F.col("o_custkey").cast("string"), F.lit("t"), F.lit("")))
        .when(kind == 1, F.concat(line, F.lit(",,")))
        .when(kind == 2, F.concat(line, F.lit(",x")))
        .otherwise(line)
    )
    return table(spark, sf_dir, "orders").select(value.alias("value"))


def operations(events: DataFrame) -> DataFrame:
    """Purchases and sign-ups store a value under the user's id, all other events read it."""
    stores = F.col("event_type").isin("purchase", "signup")
    return events.select(
        F.col("event_id").alias("op_id"),
        "ts",
        F.col("user_id").alias("key"),
        F.when(stores, F.lit("put")).otherwise(F.lit("get")).alias("op"),
        F.when(stores, F.col("value")).alias("value"),
        (F.col("event_id") % 3 + 1).cast("int").alias("loc"),
    )


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's file as a stream."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
