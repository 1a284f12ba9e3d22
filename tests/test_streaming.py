import sluice


def in_files(spark, df, path, files=3):
    df.repartition(files).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def model_of(table):
    return sluice.language_model(
        table("phrase string, cnt bigint", ("a", 10), ("a b", 4), ("a c", 5), ("z y", 5), ("b", 3), ("b x", 3))
    )


def test_suggestions_as_in_batch(spark, table, tmp_path, result):
    terms = table("term string", *[(t,) for t in ("a", " A ", "z", "b", "nope", None, "a", "q")])
    expected = result(sluice.suggest(terms, model_of(table)))
    stored = sluice.write_model_table(model_of(table), "next_words", 4)
    for most in (1000, 0):
        out, progress = str(tmp_path / f"out{most}"), str(tmp_path / f"progress{most}")
        stream = in_files(spark, terms, str(tmp_path / f"terms{most}"))
        sluice.suggest_stream(stream, stored, out, progress, available_now=True, broadcast_terms=most).awaitTermination()
        assert result(sluice.read_suggestions(spark, out).drop("batch").distinct()) == expected
        # a second start with nothing new adds nothing
        sluice.suggest_stream(stream, stored, out, progress, available_now=True, broadcast_terms=most).awaitTermination()
        assert result(sluice.read_suggestions(spark, out).drop("batch").distinct()) == expected


def test_latest_values_as_in_batch(spark, table, tmp_path, result):
    ops = table(
        "op_id bigint, ts bigint, key string, op string, value string, loc int",
        *[(i, i // 2, f"k{i % 5}", "put" if i % 3 else "get", f"v{i}", 1) for i in range(40)],
    )
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    stream = in_files(spark, ops, str(tmp_path / "ops"), 4)
    sluice.kv_latest_stream(stream, out, progress, available_now=True).awaitTermination()
    expected = result(sluice.kv_latest(ops))
    assert result(sluice.read_latest(spark, out)) == expected

    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    sluice.compact_latest(spark, out, first)
    assert result(sluice.read_latest(spark, out, first)) == expected
    more = table(ops.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", "), (99, 99, "k0", "put", "new", 1))
    more.write.mode("append").parquet(str(tmp_path / "ops"))
    sluice.kv_latest_stream(stream, out, progress, available_now=True).awaitTermination()
    expected = result(sluice.kv_latest(ops.union(more)))
    assert result(sluice.read_latest(spark, out, first)) == expected
    sluice.compact_latest(spark, out, second, before=first)
    assert result(sluice.read_latest(spark, out, second)) == expected


def test_latest_before_any_batch(spark, table, tmp_path, result):
    path = str(tmp_path / "ops")
    table("op_id bigint, ts bigint, key string, op string, value string, loc int").write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    out = str(tmp_path / "out")
    sluice.kv_latest_stream(stream, out, str(tmp_path / "progress"), available_now=True).awaitTermination()
    assert result(sluice.read_latest(spark, out)) == []


OPS = "op_id bigint, ts timestamp, key string, op string, value string, loc int"


def operations(seed, n=60):
    import datetime as dt
    import random

    random.seed(seed)
    begin = dt.datetime(2026, 1, 1)
    rows = []
    for k in range(n):
        at = begin + dt.timedelta(seconds=random.randrange(40), microseconds=random.choice([0, 0, 1, 999_999]))
        op = random.choice(["put", "get", "get"])
        rows.append((k, at, f"k{k % 4}", op, random.choice([f"v{k}", None]) if op == "put" else None, k % 3))
    return rows


def test_reads_in_time_order_of_shuffled_input(spark, table, tmp_path, result):
    import datetime as dt

    rows = operations(1)
    # what pushes the watermark past all others comes last
    end = dt.datetime(2026, 1, 2)
    ops, last = table(OPS, *rows), table(OPS, (999, end, "end", "get", None, 0), (998, None, "k1", "put", "x", 0), (997, end, None, "get", None, 0))
    path, out, progress = (str(tmp_path / name) for name in ("ops", "out", "progress"))
    stream = in_files(spark, ops, path, 4)

    def run():
        sluice.kv_read_asof_stream(stream, out, progress, "1 minute", available_now=True).awaitTermination()

    run()
    # nothing is older than the watermark yet
    assert result(sluice.read_answers(spark, out)) == []
    last.coalesce(1).write.mode("append").parquet(path)
    run()
    assert result(sluice.read_answers(spark, out)) == result(sluice.kv_read_asof(ops).select("op_id", "key", "ts", "loc", "value"))


def test_late_operations_are_left_out(spark, table, tmp_path, result):
    import datetime as dt

    at = lambda s: dt.datetime(2026, 1, 1, 0, 0, s)
    path, out, progress = (str(tmp_path / name) for name in ("ops", "out", "progress"))
    table(OPS, (1, at(1), "k", "put", "a", 1), (2, at(20), "k", "get", None, 1)).coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)

    def run(*rows):
        if rows:
            table(OPS, *rows).coalesce(1).write.mode("append").parquet(path)
        query = sluice.kv_read_asof_stream(stream, out, progress, "0 seconds", available_now=True)
        query.awaitTermination()
        return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])

    assert run() == 0
    assert result(sluice.read_answers(spark, out), "op_id", "value") == [(2, "a")]
    # the watermark has reached 20 seconds: a put and a get before it, and a get after it
    assert run((3, at(5), "k", "put", "late", 1), (4, at(6), "k", "get", None, 1), (5, at(30), "k", "get", None, 1)) == 2
    assert result(sluice.read_answers(spark, out), "op_id", "value") == [(2, "a"), (5, "a")]


def test_waiting_operations_share_rows_of_the_state():
    import datetime
    import pickle
    from types import SimpleNamespace

    from sluice.streaming import asof

    class State:
        def __init__(self):
            self.rows = []

        def appendList(self, rows):
            self.rows += rows

        def get(self):
            return iter(self.rows)

    state, timers = State(), []
    handle = SimpleNamespace(
        getListState=lambda name, schema: state, getValueState=lambda name, schema: None, registerTimer=timers.append
    )
    reads = asof._Reads(None)
    reads.init(handle)
    ts = datetime.datetime(2024, 1, 1)
    assert list(reads.handleInputRows((1,), iter([(k, 1, ts, 5000 + k, k % 2 == 0, None, 1) for k in range(5000)]), None)) == []
    assert len(state.rows) == 2 and timers == [5]
    assert [op[0] for (ops,) in state.rows for op in pickle.loads(ops)] == list(range(5000))
