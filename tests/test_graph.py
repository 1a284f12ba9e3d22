import random

import pytest

import sluice
from sluice.plans.skew import SkewLimits

TINY = SkewLimits(max_hot=10, min_rows=5)


def small_graph(table):
    arcs = table("src string, dst string", ("a", "b"), ("a", "b"), ("a", "c"), ("b", "c"))
    nodes = table("id string, title string", *[(x, x.upper()) for x in "abcd"])
    return arcs, nodes


@pytest.mark.parametrize(
    ("steps", "expected"),
    [(1, {"b": 1.0, "c": 1.85}), (2, {"c": 1.393125}), (3, {})],
)
def test_pagerank_passes_on_what_was_received(table, result, steps, expected):
    arcs, nodes = small_graph(table)
    assert dict(result(sluice.pagerank(arcs, nodes, iterations=steps))) == pytest.approx(expected)


def test_pagerank_standard_keeps_all_nodes(table, result):
    arcs, nodes = small_graph(table)
    found = dict(result(sluice.pagerank(arcs, nodes, iterations=1, mode="standard")))
    assert found == pytest.approx({"a": 0.575, "b": 1.0, "c": 1.85, "d": 0.575})


def test_pagerank_wants_nodes_once(table):
    arcs, nodes = small_graph(table)
    with pytest.raises(ValueError, match="once"):
        sluice.pagerank(arcs, nodes.union(nodes))
    with pytest.raises(ValueError, match="mode"):
        sluice.pagerank(arcs, nodes, mode="other")


def test_pagerank_top(table, result):
    ranks = table("id string, rank double", ("b", 1.0), ("a", 1.0), ("x", 9.0), ("c", 0.5))
    nodes = table("id string, title string", ("a", "A"), ("b", "B"), ("c", "C"))
    assert [tuple(r) for r in sluice.pagerank_top(ranks, nodes, k=2).collect()] == [("A", 1.0), ("B", 1.0)]


def test_shortest_paths(table, result):
    arcs = table("src bigint, dst bigint", (3, 9), (5, 9), (7, 5), (7, 3), (9, 7), (8, 8))
    found = result(sluice.shortest_paths_to(arcs, table("seed bigint", (9,), (9,), (77,))))
    assert found == [
        (9, 3, 2, 9, [3, 9]), (9, 5, 2, 9, [5, 9]), (9, 7, 3, 3, [7, 3, 9]), (9, 9, 1, None, [9]),
    ]


def test_shortest_paths_without_a_known_seed(table, result):
    arcs = table("src bigint, dst bigint", (1, 2))
    assert result(sluice.shortest_paths_to(arcs, table("seed bigint", (5,)))) == []


def skewed_arcs(table):
    random.seed(4)
    rows = {(random.randrange(60), random.randrange(60)) for _ in range(150)}
    rows |= {(0, k) for k in range(60)} | {(k, 1) for k in range(60)}
    return table("src bigint, dst bigint", *rows)


def test_hot_nodes_change_nothing(table, result):
    arcs = skewed_arcs(table)
    nodes = table("id bigint, title string", *[(k, str(k)) for k in range(60)])
    for mode in ("reference", "standard"):
        usual = dict(result(sluice.pagerank(arcs, nodes, iterations=3, mode=mode)))
        assert dict(result(sluice.pagerank(arcs, nodes, iterations=3, mode=mode, limits=TINY))) == pytest.approx(usual)
    seeds = table("seed bigint", (1,), (7,))
    usual = result(sluice.shortest_paths_to(arcs, seeds))
    assert result(sluice.shortest_paths_to(arcs, seeds, limits=TINY)) == usual


def test_levels_written_together_change_nothing(table, result):
    chain = table("src bigint, dst bigint", *[(k + 1, k) for k in range(12)])
    seeds = table("seed bigint", (0,))
    usual = result(sluice.shortest_paths_to(chain, seeds))
    assert result(sluice.shortest_paths_to(chain, seeds, levels_per_block=3)) == usual
    assert usual[-1][4] == [9, 8, 7, 6, 5, 4, 3, 2, 1, 0]


def plain_paths(rows, seeds):
    """For each seed and node the shortest path, among equals the one with the smaller next id at each step."""
    into = {}
    for src, dst in rows:
        into.setdefault(dst, set()).add(src)
    known = {x for row in rows for x in row}
    out = []
    for seed in set(seeds) & known:
        level, paths = [seed], {seed: [seed]}
        out.append((seed, seed, 1, None, [seed]))
        while level:
            offers = {}
            for node in level:
                for src in into.get(node, ()):
                    if src not in paths:
                        offers[src] = min(node, offers.get(src, node))
            paths |= {src: [src, *paths[node]] for src, node in offers.items()}
            out += [(seed, src, len(paths[src]), node, paths[src]) for src, node in offers.items()]
            level = list(offers)
    return sorted(out, key=repr)


@pytest.mark.parametrize("limits", [SkewLimits(), TINY])
def test_many_seeds_share_rows(table, result, limits):
    random.seed(12)
    rows = {(random.randrange(90), random.randrange(90)) for _ in range(260)} | {(3, k) for k in range(90)} | {(k, 4) for k in range(90)}
    # more than 64, some not in the graph
    seeds = [*range(0, 100), 500]
    found = sluice.shortest_paths_to(
        table("src bigint, dst bigint", *rows), table("seed bigint", *[(s,) for s in seeds]), limits=limits
    )
    assert result(found) == plain_paths(rows, seeds)


def test_ids_may_be_text(table, result):
    rows = [("b", "a"), ("c", "a"), ("d", "c"), ("d", "b"), ("é", "d")]
    found = sluice.shortest_paths_to(table("src string, dst string", *rows), table("seed string", ("a",), ("d",)))
    assert result(found) == plain_paths(rows, ["a", "d"])


def jobs_of(spark, work):
    spark.sparkContext.setJobGroup("counted", "")
    try:
        out = work()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_long_paths_take_few_jobs(spark, result):
    chain = spark.range(1000).selectExpr("0L as seed", "id", "int(id + 1) as len", "if(id = 0, null, id - 1) as parent")
    found, jobs = jobs_of(spark, lambda: sluice.paths_of(chain))
    last = found.where("id = 999").first()
    assert last["path"] == list(range(999, -1, -1)) and found.where("size(path) <> len").count() == 0
    # ten steps of a few jobs, not a thousand
    assert jobs < 80


def test_seeds_share_the_state_of_a_node(table):
    from sluice.operators.graph import _first_of_each_bit

    # two parents offer overlapping seeds: the smaller one gets those both have, and a row is left for each that gains some
    offers = table("id bigint, block bigint, parent bigint, bits bigint", (1, 0, 5, 0b0110), (1, 0, 3, 0b0011), (1, 0, 9, 0b0001), (1, 1, 9, 0b1), (1, 0, None, 0b1000))
    gains = {(r["block"], r["parent"]): r["gain"] for r in _first_of_each_bit(offers, "id", "block").collect()}
    assert gains == {(0, None): 0b1000, (0, 3): 0b0011, (0, 5): 0b0100, (0, 9): 0, (1, 9): 1}


def test_packed_offers_gain_the_same_bits(spark):
    import numpy as np

    from sluice.operators.graph import _first_gains, _first_of_each_bit

    random.seed(3)
    rows = sorted({(random.randrange(6), random.randrange(40)) for _ in range(120)})
    bits = [random.getrandbits(64) - (1 << 63) for _ in rows]
    bits = [b & random.getrandbits(63) if k % 3 else b for k, b in enumerate(bits)]
    frame = spark.createDataFrame([(i, p, b) for (i, p), b in zip(rows, bits)], "id bigint, parent bigint, bits bigint")
    gains = {(r["id"], r["parent"]): r["gain"] for r in _first_of_each_bit(frame, "id").collect()}
    packed, _ = _first_gains(np.array([i for i, _ in rows]), np.array(bits))
    assert dict(zip(rows, packed.tolist())) == gains


def test_a_search_moves_packed_rows(spark, table, result):
    """Neither the arcs nor the paths of a dense graph are rows of a shuffle once the arcs are laid out."""
    from sluice.operators.graph import _Reverse

    random.seed(8)
    rows = {(random.randrange(300), random.randrange(300)) for _ in range(9000)}
    arcs = table("src bigint, dst bigint", *rows)
    layout = _Reverse(arcs, SkewLimits())
    moved = []
    step = layout.step
    layout.step = lambda state: moved.append(step(state)) or moved[-1]
    seeds = spark.createDataFrame([(seed, seed) for seed in range(64)], "seed bigint, number bigint")
    found = result(layout.search(seeds, 16))
    layout.release()
    assert found == plain_paths(rows, range(64))
    assert sum(frame.where("other is null").count() for frame in moved) <= 32 * len(moved)
    # pairs of blocks and parts of the seeds, against 64 times 300 paths
    assert max(frame.count() for frame in moved) <= 32 + 4 * 32 * 32 < len(found) / 4


def test_searches_one_after_another(table, result, monkeypatch):
    from sluice.operators import graph

    monkeypatch.setattr(graph, "SEEDS_PER_SEARCH", 64)
    random.seed(21)
    rows = {(random.randrange(-50, 90), random.randrange(-50, 90)) for _ in range(300)}
    found = sluice.shortest_paths_to(table("src int, dst int", *rows), table("seed bigint", *[(s,) for s in range(-40, 90)]))
    assert found.schema["path"].dataType.simpleString() == "array<int>" and found.schema["id"].dataType.simpleString() == "int"
    assert result(found) == plain_paths(rows, range(-40, 90))


def test_ranks_within_a_tolerance(spark, table, result):
    import duckdb
    import oracles

    data = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("lineitem", "part"):
        con.execute(f"create view {name} as select * from '{data}/{name}.parquet'")
    exact = dict(con.execute(oracles._pagerank(100, True) + " select id, rank from r100").fetchall())
    from sluice import workload

    for tolerance in (0.1, 0.001):
        sent = []
        ranks = sluice.pagerank_within(workload.arcs(spark, data), workload.nodes(spark, data), tolerance, sent=sent)
        found = dict(result(ranks))
        assert found.keys() == exact.keys()
        assert max(abs(found[k] / exact[k] - 1) for k in exact) <= tolerance
        # fewer and fewer nodes have anything to pass on
        half = len(sent) // 2
        assert sent[0] == max(sent) and sum(sent[half:]) < sum(sent[: len(sent) - half]) and sent[-1] < sent[0] / 4


def test_ranks_with_nodes_that_pass_nothing_on(table, result):
    arcs, nodes = small_graph(table)
    plain = dict(result(sluice.pagerank(arcs, nodes, iterations=60, mode="standard")))
    found = dict(result(sluice.pagerank_within(arcs, nodes, 1e-4)))
    assert found == pytest.approx(plain, rel=1e-4)
    assert result(sluice.pagerank_within(arcs.limit(0), nodes, 0.01)) == [(x, pytest.approx(1.0)) for x in "abcd"]
    assert result(sluice.pagerank_within(arcs.limit(0), nodes.limit(0))) == []
    with pytest.raises(ValueError, match="once"):
        sluice.pagerank_within(arcs, nodes.union(nodes))


def test_a_step_moves_packed_rows(spark, table, result):
    from sluice.operators import graph

    random.seed(7)
    rows = {(random.randrange(400), random.randrange(400)) for _ in range(6000)} | {(0, k) for k in range(400)} | {(k, 1) for k in range(400)}
    arcs, nodes = table("src bigint, dst bigint", *rows), table("id bigint, title string", *[(k, "") for k in range(0, 450)])
    # ten arcs for a slot at most, so that blocks are split
    limits = SkewLimits(max_hot=100_000, min_rows=1)
    for some in (limits, SkewLimits()):
        blocks = graph._Blocks(arcs, nodes, some)
        try:
            sizes = [len(row["sources"]) // 4 for row in blocks._tiles.select("sources").collect()]
            tiles = blocks._tiles.select("block", "other").distinct().count()
            assert sum(sizes) == len(rows) and max(sizes) <= 10 * some.slot_rows(len(rows)) and tiles <= graph.LEAST_BLOCKS**2 < len(rows) / 5
            assert (blocks.start.agg({"fan": "max"}).first()[0] > 1) == (some is limits)
        finally:
            blocks.release()
    rank, degree = {k: 1.0 for k in range(450)}, {}
    for src, _ in rows:
        degree[src] = degree.get(src, 0) + 1
    for _ in range(2):
        mass = sum(x for k, x in rank.items() if k not in degree)
        got = {}
        for src, dst in rows:
            if src in rank:
                got[dst] = got.get(dst, 0.0) + rank[src] / degree[src]
        rank = {k: 0.15 + 0.85 * (x + mass / 450) for k, x in got.items()}
    assert dict(result(sluice.pagerank(arcs, nodes, 2, limits=limits))) == pytest.approx(rank)
