"""PageRank and shortest paths to seeds, as loops over DataFrames.

The arcs are laid out once, packed as tiles between blocks of nodes, and stay where they are; each
step moves only the state and packed rows for the tiles. The arcs of a block with too many are split over slots, and its state row is
repeated for each of them. Every step ends in a checkpoint in the shared folder. PageRank numbers the
nodes first; a search keeps their ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType

from sluice.plans.layout import cut, keep_sorted
from sluice.plans.skew import DEFAULT_LIMITS, SkewLimits, every_slot, lookup_join, slot_of

#: Levels of a search that are written together once there are so many.
LEVELS_PER_BLOCK = 16


def _distinct_arcs(arcs: DataFrame) -> DataFrame:
    return cut(arcs.select("src", "dst").where("src is not null and dst is not null").distinct())


def _numbers(data: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), kind)


def _rows(schema: str, *columns: list) -> pa.Table:
    kinds = {"bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    names = [field.split(" ") for field in schema.split(", ")]
    return pa.table({name: pa.array(column, kinds[kind]) for (name, kind), column in zip(names, columns, strict=True)})


#: Arcs that leave a block of nodes, about, and least number of blocks.
ARCS_PER_BLOCK = 1_000_000
LEAST_BLOCKS = 32
_TILE = "block bigint, other bigint, sources binary, targets binary, firsts binary"
_STATE = "block bigint, fan bigint, degree binary, rank binary, residual binary, going bigint, arcs bigint, mass double"
_MESSAGE = "block bigint, targets binary, shares binary"


class _Blocks:
    """Arcs as tiles between blocks of numbered nodes, so that a step moves a packed row for each tile and not one for each arc.

    A node's block is a hash of its id, its place there the order of the ids. A tile holds the arcs from one block to another, by target; the tiles
    lie where their sources' block is sent to. Blocks with too many arcs are split over slots.
    """

    def __init__(self, arcs: DataFrame, nodes: DataFrame, limits: SkewLimits):
        links = _distinct_arcs(arcs)
        known = cut(_known(nodes, links))
        total = known.agg(F.coalesce(F.sum("degree"), F.lit(0)).alias("total")).first()["total"]
        blocks = max(LEAST_BLOCKS, -(-total // ARCS_PER_BLOCK))
        slot_rows = int(10 * limits.slot_rows(total))
        placed = known.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
        order = Window.partitionBy("block").orderBy("id")
        self.ids = cut(placed.withColumn("place", F.row_number().over(order) - 1))
        self.start = cut(self.ids.select("block", "place", "degree", "start").groupBy("block").applyInArrow(_first_state(slot_rows), _STATE))
        source = self.ids.select(F.col("id").alias("src"), F.col("block"), F.col("place").alias("source"))
        target = self.ids.select(F.col("id").alias("dst"), F.col("block").alias("other"), F.col("place").alias("target"))
        placed = lookup_join(lookup_join(links, source, "src"), target, "dst")
        placed = placed.select((F.col("block") * blocks + F.col("other")).alias("tile"), "source", "target")
        tiles = placed.groupBy("tile").applyInArrow(_tiles(blocks, slot_rows), _TILE)
        tiles = tiles.join(F.broadcast(self.start.select("block", "fan")), "block").withColumn("slot", slot_of(F.col("fan"), ["other"]))
        self._tiles = keep_sorted(tiles.drop("fan"), ["block", "slot"], total)

    def step(self, state: DataFrame, spread, gather) -> DataFrame:
        """The next state: ``spread`` makes a block's row into what each node sends along each of its arcs, ``gather`` takes what comes."""
        sending = state.withColumn("slot", every_slot(F.col("fan").cast("int"))).groupBy("block", "slot")
        messages = sending.cogroup(self._tiles.groupBy("block", "slot")).applyInArrow(_messages(spread), _MESSAGE)
        # a cogroup of both would square the size that the planner expects, with each step again
        both = state.unionByName(messages, allowMissingColumns=True)
        return cut(both.groupBy("block").applyInArrow(_received(gather), _STATE))

    def ranks(self, state: DataFrame) -> DataFrame:
        """``(id, degree, rank)`` of all nodes that have a rank."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                    rank = _numbers(data, np.float64)
                    place = np.flatnonzero(~np.isnan(rank))
                    columns = [np.full(len(place), block), place.astype(np.int32), rank[place]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["block", "place", "rank"])

        rows = state.select("block", "rank").mapInArrow(run, "block bigint, place int, rank double")
        return self.ids.join(rows.hint("merge"), ["block", "place"]).select("id", "degree", "rank")

    def release(self) -> None:
        self._tiles.unpersist()


def _state(block: int, fan: int, degree: np.ndarray, rank: np.ndarray, residual: np.ndarray, bound: float) -> pa.Table:
    """A row of ``_STATE``: ``going`` nodes have a residual above ``bound``, with ``arcs`` in all; ``mass`` is the rank of nodes without any."""
    going = residual > bound
    mass = float(np.nansum(rank[degree == 0]))
    columns = [block, fan, degree.tobytes(), rank.tobytes(), residual.tobytes(), int(going.sum()), int(degree[going].sum()), mass]
    return _rows(_STATE, *([x] for x in columns))


def _first_state(slot_rows: int):
    """Nodes that ``start`` have rank 1, others none; nothing waits."""

    def run(rows: pa.Table) -> pa.Table:
        place = rows["place"].to_numpy()
        degree, rank = np.zeros(len(place), np.int64), np.full(len(place), np.nan)
        degree[place] = rows["degree"].fill_null(0).to_numpy()
        rank[place[rows["start"].to_numpy()]] = 1.0
        fan = max(1, -(-int(degree.sum()) // slot_rows))
        return _state(rows["block"][0].as_py(), fan, degree, rank, np.zeros(len(place)), 0.0)

    return run


def _tiles(blocks: int, most: int):
    """The arcs from one block to another as rows of at most ``most``, sorted by target: sources, each target once, and where it begins."""

    def run(arcs: pa.Table) -> pa.Table:
        source, target = (arcs[name].to_numpy().astype(np.uint32) for name in ("source", "target"))
        order = np.argsort(target, kind="stable")
        parts = [order[at : at + most] for at in range(0, len(order), most)]
        found = [(source[part], *np.unique(target[part], return_index=True)) for part in parts]
        packed = [[x.astype(np.uint32).tobytes() for x in column] for column in zip(*found)]
        keys = [[key] * len(parts) for key in divmod(arcs["tile"][0].as_py(), blocks)]
        return _rows(_TILE, *keys, *packed)

    return run


def _messages(spread):
    """For each tile its targets and the sums of what their sources send; a source that is not a number sends nothing."""

    def run(state: pa.Table, tiles: pa.Table) -> pa.Table:
        out = []
        share = spread(state) if len(tiles) and len(state) else None
        if share is not None and not np.isnan(share).all():
            for other, *packed in zip(tiles["other"].to_pylist(), tiles["sources"], tiles["targets"], tiles["firsts"]):
                source, target, first = (_numbers(x, np.uint32) for x in packed)
                sent = share[source]
                here = ~np.isnan(sent)
                some = np.logical_or.reduceat(here, first)
                sums = np.add.reduceat(np.where(here, sent, 0.0), first)
                if some.any():
                    out.append((other, target[some].tobytes(), sums[some].tobytes()))
        return _rows(_MESSAGE, *(zip(*out) if out else ([], [], [])))

    return run


def _received(gather):
    """A block's next row: ``gather`` gets its row, the sum of what each node got, and which nodes got something."""

    def run(rows: pa.Table) -> pa.Table:
        state, messages = (rows.filter(pc.is_valid(rows[name])) for name in ("degree", "targets"))
        size = len(_numbers(state["degree"][0], np.int64))
        target = np.frombuffer(b"".join(messages["targets"].to_pylist()), np.uint32).astype(np.int64)
        share = np.frombuffer(b"".join(messages["shares"].to_pylist()), np.float64)
        got = np.bincount(target, share, size)
        return gather(state, got, np.bincount(target, minlength=size) > 0)

    return run


def _known(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``(id, degree, start)`` of all nodes; ``degree`` is null without out-arcs, ``start`` false for nodes only arcs lead to."""
    none = F.lit(None).cast("bigint")
    rows = nodes.select("id", none.alias("degree"), F.lit(True).alias("start"))
    rows = rows.unionByName(links.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree")).withColumn("start", F.lit(True)))
    rows = rows.unionByName(links.select(F.col("dst").alias("id")).distinct().select("id", none.alias("degree"), F.lit(False).alias("start")))
    return rows.groupBy("id").agg(F.max("degree").alias("degree"), F.max("start").alias("start"))


def _columns(state: pa.Table) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
    vectors = (("degree", np.int64), ("rank", np.float64), ("residual", np.float64))
    return state["block"][0].as_py(), state["fan"][0].as_py(), *(_numbers(state[name][0], kind) for name, kind in vectors)


def pagerank(
    arcs: DataFrame,
    nodes: DataFrame,
    iterations: int = 10,
    damping: float = 0.85,
    mode: str = "reference",
    limits: SkewLimits = DEFAULT_LIMITS,
) -> DataFrame:
    """``(id, rank)`` after ``iterations`` steps from rank 1 everywhere.

    ``arcs`` is ``(src, dst)``, ``nodes`` has one row per ``id``. The rank of nodes without out-arcs
    is shared out evenly in each step. In mode ``reference`` only nodes that received something in a
    step go on to the next; in mode ``standard`` all nodes do.
    """
    if mode not in ("reference", "standard"):
        raise ValueError(f"mode must be 'reference' or 'standard', not {mode!r}")
    count = _count_once(nodes)
    blocks = _Blocks(arcs, nodes, limits)
    teleport = float(1 - Decimal(str(damping)))
    state = blocks.start

    def spread(row: pa.Table) -> np.ndarray:
        _, _, degree, rank, _ = _columns(row)
        return np.divide(rank, degree, out=np.full(len(rank), np.nan), where=degree > 0)

    def gather_with(even: float):
        def gather(row: pa.Table, got: np.ndarray, some: np.ndarray) -> pa.Table:
            block, fan, degree, rank, residual = _columns(row)
            stays = some if mode == "reference" else some | ~np.isnan(rank)
            return _state(block, fan, degree, np.where(stays, teleport + (got + even) * damping, np.nan), residual, 0.0)

        return gather

    try:
        for _ in range(iterations):
            dangling = state.agg(F.coalesce(F.sum("mass"), F.lit(0.0)).alias("mass")).first()["mass"]
            state = blocks.step(state, spread, gather_with(dangling / count if count else 0.0))
    finally:
        blocks.release()
    return blocks.ranks(state).select("id", "rank")


def _count_once(nodes: DataFrame) -> int:
    """How many nodes there are; none may come twice."""
    sizes = (
        nodes.groupBy("id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n"), F.max("copies").alias("most"))
        .first()
    )
    if (sizes["most"] or 0) > 1:
        raise ValueError("nodes must hold each id once")
    return sizes["n"]


def pagerank_top(ranks: DataFrame, nodes: DataFrame, k: int = 100) -> DataFrame:
    """``(title, rank)`` of the ``k`` highest ranked titled nodes; the smaller id goes first among equals."""
    return (
        ranks.join(nodes.select("id", "title"), "id")
        .orderBy(F.desc("rank"), "id")
        .limit(k)
        .select("title", "rank")
    )


def pagerank_within(
    arcs: DataFrame,
    nodes: DataFrame,
    tolerance: float = 1e-3,
    damping: float = 0.85,
    limits: SkewLimits = DEFAULT_LIMITS,
    sent: list[int] | None = None,
) -> DataFrame:
    """``(id, rank)``: what mode ``standard`` of :func:`pagerank` tends to, each rank within ``tolerance`` of itself.

    Every node holds a rank and a residual, which is what it hasn't passed on yet. A step adds the residuals above a
    bound to their nodes' ranks and sends them along the arcs; smaller ones wait until they have grown. When none
    is above the bound, what is left can't change a rank by more than the tolerance. The rank of nodes without
    out-arcs, which all nodes share, makes all ranks larger by one factor, known at the end. ``sent`` gets the number of rows sent in
    each step.
    """
    count = _count_once(nodes)
    blocks = _Blocks(arcs, nodes, limits)
    teleport = float(1 - Decimal(str(damping)))
    bound = tolerance * teleport * teleport

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, fan, degree, rank, _ = _columns(pa.Table.from_batches([batch.slice(row, 1)]))
                state = _state(block, fan, degree, np.zeros(len(rank)), np.full(len(rank), teleport), bound)
                yield from state.to_batches()

    def spread(row: pa.Table) -> np.ndarray:
        _, _, degree, _, residual = _columns(row)
        return np.divide(residual * damping, degree, out=np.full(len(residual), np.nan), where=(degree > 0) & (residual > bound))

    def gather(row: pa.Table, got: np.ndarray, some: np.ndarray) -> pa.Table:
        block, fan, degree, rank, residual = _columns(row)
        sends = residual > bound
        return _state(block, fan, degree, rank + np.where(sends, residual, 0.0), np.where(sends, 0.0, residual) + got, bound)

    state = blocks.start.mapInArrow(begin, _STATE)
    try:
        while True:
            going = state.agg(F.sum("going").alias("n"), F.sum("arcs").alias("rows")).first()
            if not going["n"]:
                break
            if sent is not None:
                sent.append(going["rows"])
            state = blocks.step(state, spread, gather)
    finally:
        blocks.release()
    dangling = state.agg(F.coalesce(F.sum("mass"), F.lit(0.0)).alias("mass")).first()["mass"]
    factor = 1 / (1 - dangling * damping / (teleport * max(count, 1)))
    return blocks.ranks(state).select("id", (F.col("rank") * factor).alias("rank"))


def shortest_paths_to(
    arcs: DataFrame,
    seeds: DataFrame,
    limits: SkewLimits = DEFAULT_LIMITS,
    levels_per_block: int = LEVELS_PER_BLOCK,
) -> DataFrame:
    """``(seed, id, len, parent, path)``: a shortest path along the arcs from each node to each seed.

    Of equally short paths the one whose steps have the smaller ids is taken. ``len`` counts nodes,
    ``parent`` is the next step (null for the seed). Nodes that cannot reach a seed give no row, nor do
    seeds that are on no arc. Up to 512 seeds are searched at once, one level of distance per step, and 64 of them share a
    row. The search carries ids only; the paths are put together afterwards, by levels, or twice as long with each step if there
    are ``levels_per_block`` levels or more.
    """
    links = arcs.select("src", "dst")
    id_type = links.select("src").union(links.select("dst")).schema["src"].dataType
    seeds = seeds.select(F.col("seed").cast(id_type).alias("seed"))
    if not isinstance(id_type, IntegralType):
        return _search_named(links, seeds, limits, levels_per_block)
    links = links.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"))
    found = _search(links, seeds.select(F.col("seed").cast("bigint").alias("seed")), limits, levels_per_block)
    cast = [F.col(name).cast(id_type).alias(name) for name in ("seed", "id", "parent")]
    return found.select(*cast[:2], "len", cast[2], F.col("path").cast(ArrayType(id_type)).alias("path"))


def paths_of(found: DataFrame) -> DataFrame:
    """``found`` (``seed``, ``id``, ``len``, ``parent``) with ``path``, the ids from ``id`` along the parents to the seed.

    Every row holds the beginning of its path and the node after it. Joined with themselves the beginnings become twice as long, so a
    path of n nodes takes about log2(n) steps.
    """
    rows = cut(found.select("seed", "id", "len", "parent", F.array("id").alias("path"), F.col("parent").alias("next")))
    longest = rows.agg(F.max("len").alias("len")).first()["len"] or 1
    for _ in range((longest - 1).bit_length()):
        ends = rows.select("seed", F.col("id").alias("next"), F.col("path").alias("on"), F.col("next").alias("after"))
        longer = (
            rows.where("next is not null")
            .join(ends.hint("merge"), ["seed", "next"])
            .select("seed", "id", "len", "parent", F.concat("path", "on").alias("path"), F.col("after").alias("next"))
        )
        rows = cut(rows.where("next is null").unionByName(longer))
    return rows.drop("next")


#: Seeds that share a row of the search, as bits, and a row of the paths; seeds that are searched at once.
SEEDS_PER_ROW = 64
SEEDS_PER_PART = 16
SEEDS_PER_SEARCH = 512
_ARCS = "block bigint, slot bigint, other bigint, sources binary, targets binary, places binary"
_OFFER = "block bigint, seeds bigint, other bigint, ids binary, parents binary, bits binary"
_REACHED = _OFFER + ", fresh binary, going bigint"
_PATH = "block bigint, part bigint, len bigint, places binary, path binary"


def _block(column: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks))


def _whole(column: pa.ChunkedArray, kind: type = np.int64) -> np.ndarray:
    """The numbers of all rows of a binary column, one row after another."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _first_of_each_bit(offers: DataFrame, *keys: str) -> DataFrame:
    """``offers`` (``keys``, ``parent``, ``bits``) with ``gain``: the bits that no smaller parent of the same key offers."""
    smaller = Window.partitionBy(*keys).orderBy(F.col("parent").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.bit_or("bits").over(smaller), F.lit(0).cast("bigint"))
    return offers.withColumn("gain", F.col("bits").bitwiseAND(F.bitwise_not(before)))


def _first_gains(keys: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_first_of_each_bit` for packed offers, sorted by key and parent: the gains, and all bits of the key so far."""
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    longest = int(np.diff(np.append(heads, len(keys))).max(initial=0))
    sofar = bits.copy()
    step = 1
    while step < longest:
        sofar[step:] |= np.where(keys[step:] == keys[:-step], sofar[:-step], 0)
        step *= 2
    before = np.zeros_like(bits)
    before[1:] = np.where(keys[1:] == keys[:-1], sofar[:-1], 0)
    return bits & ~before, sofar


def _arc_tiles(arcs: pa.Table) -> pa.Table:
    """A block's arcs as a row for each block they come from, by source, then target: sources, the different targets, and each arc's place there."""
    source, target, other = (arcs[name].to_numpy() for name in ("src", "dst", "other"))
    order = np.lexsort((target, source, other))
    others, first = np.unique(other[order], return_index=True)
    found = []
    for part in np.split(order, first[1:]):
        targets, places = np.unique(target[part], return_inverse=True)
        found.append([x.tobytes() for x in (source[part], targets, places.astype(np.uint32))])
    keys = [[arcs[name][0].as_py()] * len(found) for name in ("block", "slot")]
    return _rows(_ARCS, *keys, others, *zip(*found))


def _offers(state: pa.Table, tiles: pa.Table) -> pa.Table:
    """What the nodes reached last offer along the arcs of each tile; of equal offers to a node only the one of the smallest parent."""
    out = []
    for block, seeds, *reached in zip(state["block"].to_pylist(), state["seeds"].to_pylist(), state["ids"], state["fresh"]):
        ids, fresh = (_numbers(x, np.int64) for x in reached)
        ids, fresh = ids[fresh != 0], fresh[fresh != 0]
        for other, *packed, places in zip(tiles["other"].to_pylist(), tiles["sources"], tiles["targets"], tiles["places"]):
            source, target = (_numbers(x, np.int64) for x in packed)
            at = np.minimum(np.searchsorted(ids, target), len(ids) - 1)
            sent = np.where(ids[at] == target, fresh[at], 0)
            if sent.any():
                place = _numbers(places, np.uint32)
                bits = sent[place]
                some = np.flatnonzero(bits)
                gain, _ = _first_gains(source[some], bits[some])
                some, gain = some[gain != 0], gain[gain != 0]
                out.append((other, seeds, block, source[some].tobytes(), target[place[some]].tobytes(), gain.tobytes()))
    return _rows(_OFFER, *(zip(*out) if out else [[]] * 6))


def _reach(rows: pa.Table) -> pa.Table:
    """A block's next row from its last one and the offers to it, and rows of what was reached, for each block of parents and each part of the seeds."""
    block, seeds = rows["block"][0].as_py(), rows["seeds"][0].as_py()
    state, offers = rows.filter(pc.is_null(rows["other"])), rows.filter(pc.is_valid(rows["other"]))
    ids, visited = _whole(state["ids"]), _whole(state["bits"])
    child, parent, bits = (_whole(offers[name]) for name in ("ids", "parents", "bits"))
    origin = np.repeat(offers["other"].to_numpy(), pc.binary_length(offers["ids"]).to_numpy() // 8)
    order = np.lexsort((parent, child))
    child, parent, bits, origin = child[order], parent[order], bits[order], origin[order]
    everyone = np.union1d(ids, child)
    now, fresh = np.zeros(len(everyone), np.int64), np.zeros(len(everyone), np.int64)
    now[np.searchsorted(everyone, ids)] = visited
    place = np.searchsorted(everyone, child)
    gain, sofar = _first_gains(child, bits & ~now[place])
    # later offers of a node hold the earlier ones' bits as well, and the last one stays
    fresh[place] = sofar
    out = [(block, seeds, None, everyone.tobytes(), None, (now | fresh).tobytes(), fresh.tobytes(), int((fresh != 0).sum()))]
    parts = SEEDS_PER_ROW // SEEDS_PER_PART
    for part in range(parts):
        some_bits = gain & np.uint64((1 << SEEDS_PER_PART) - 1 << part * SEEDS_PER_PART).astype(np.int64)
        some = np.flatnonzero(some_bits)
        some = some[np.argsort(origin[some], kind="stable")]
        others, first = np.unique(origin[some], return_index=True)
        for other, mine in zip(others.tolist(), np.split(some, first[1:])):
            packed = (x[mine].tobytes() for x in (child, parent, some_bits))
            # these go to the parents' block
            out.append((other, seeds * parts + part, block, *packed, None, None))
    return _rows(_REACHED, *zip(*out))


def _ones(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of each bit that is set."""
    return np.nonzero(np.unpackbits(bits.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))


def _extended(rows: pa.Table) -> pa.Table:
    """Paths of one length and the nodes that go on to their beginnings: the paths that are longer by one."""
    known, found = rows.filter(pc.is_valid(rows["path"])), rows.filter(pc.is_valid(rows["parents"]))
    out = []
    if len(known) and len(found):
        length, part = known["len"][0].as_py(), known["part"][0].as_py()
        path = _whole(known["path"]).reshape(-1, length)
        begins, row = np.unique(path[:, 0], return_inverse=True)
        where = np.zeros(len(begins) * SEEDS_PER_ROW, np.int64)
        where[row * SEEDS_PER_ROW + _whole(known["places"], np.uint8)] = np.arange(len(path))
        for other, *packed in zip(found["other"].to_pylist(), found["ids"], found["parents"], found["bits"]):
            child, parent, bits = (_numbers(x, np.int64) for x in packed)
            at, place = _ones(bits)
            longer = np.empty((len(at), length + 1), np.int64)
            longer[:, 0] = child[at]
            longer[:, 1:] = path[where[np.searchsorted(begins, parent)[at] * SEEDS_PER_ROW + place]]
            out.append((other, part, length + 1, place.astype(np.uint8).tobytes(), longer.tobytes()))
    return _rows(_PATH, *(zip(*out) if out else [[]] * 5))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for length, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            path = _numbers(data, np.int64).reshape(-1, length)
            offsets = pa.array(np.arange(0, path.size + 1, length).astype(np.int32))
            columns = [
                pa.array(path[:, -1]),
                pa.array(path[:, 0]),
                pa.array(np.full(len(path), length, np.int32)),
                pa.array(path[:, 1]) if length > 1 else pa.nulls(len(path), pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(path.reshape(-1))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["seed", "id", "len", "parent", "path"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(number, id, len, parent)`` of rows of what was reached."""
    for batch in batches:
        for part, length, *packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *batch.columns[2:]):
            child, parent, bits = (_numbers(x, np.int64) for x in packed)
            at, place = _ones(bits)
            number = part // (SEEDS_PER_ROW // SEEDS_PER_PART) * SEEDS_PER_ROW + place
            columns = [number, child[at], np.full(len(at), length, np.int32), parent[at]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["number", "id", "len", "parent"])


class _Reverse:
    """Arcs as tiles between blocks of nodes, which lie where their targets' block is sent to.

    A node's block is a hash of its id. A step of a search moves a packed row for each tile and not one for each arc. Blocks with too many
    arcs are split over slots.
    """

    def __init__(self, links: DataFrame, limits: SkewLimits):
        total = links.count()
        self.blocks = max(LEAST_BLOCKS, -(-total // ARCS_PER_BLOCK))
        slot_rows = int(10 * limits.slot_rows(total))
        placed = links.select(_block(F.col("dst"), self.blocks).alias("block"), _block(F.col("src"), self.blocks).alias("other"), "src", "dst")
        sizes = placed.groupBy("block").agg(F.count(F.lit(1)).alias("arcs"))
        self._fans = cut(sizes.select("block", F.ceil(F.col("arcs") / slot_rows).cast("int").alias("fan")))
        placed = placed.join(F.broadcast(self._fans), "block").withColumn("slot", F.pmod(F.xxhash64("src"), "fan")).drop("fan")
        tiles = cut(placed.groupBy("block", "slot").applyInArrow(_arc_tiles, _ARCS))
        self._tiles = keep_sorted(tiles.withColumn("slot", F.col("slot").cast("int")), ["block", "slot"], self.blocks**2)

    def step(self, state: DataFrame) -> DataFrame:
        """The next state of each block and the rows of what it reached."""
        sending = state.where("going > 0").join(F.broadcast(self._fans), "block").withColumn("slot", every_slot(F.col("fan")))
        sending = sending.select("block", "slot", "seeds", "ids", "fresh").groupBy("block", "slot")
        offers = sending.cogroup(self._tiles.groupBy("block", "slot")).applyInArrow(_offers, _OFFER)
        # a cogroup of both would square the size that the planner expects, with each step again
        both = state.unionByName(offers, allowMissingColumns=True)
        return cut(both.groupBy("block", "seeds").applyInArrow(_reach, _REACHED))

    def search(self, seeds: DataFrame, levels_per_block: int) -> DataFrame:
        """``(seed, id, len, parent, path)`` of all nodes that reach one of ``seeds`` (``seed``, ``number``).

        The state of a block has for each of its nodes, and 64 seeds, which it has reached and which of them in the last step.
        If there are few levels, the paths of each are sent to the nodes of the next one, so each path moves once; else they are put together by
        :func:`paths_of`, in fewer steps than there are levels.
        """
        first = seeds.select(_block(F.col("seed"), self.blocks).alias("block"), F.col("seed").alias("id"), "number")
        row = F.expr(f"number div {SEEDS_PER_ROW}")
        state = cut(first.groupBy("block", row.alias("seeds")).applyInArrow(_first_reached, _REACHED))
        levels: list[DataFrame] = []
        written: list[DataFrame] = []
        distance = 1
        while not state.where("going > 0").isEmpty():
            distance += 1
            step = self.step(state)
            state = step.where("other is null")
            found = step.where("other is not null").withColumnRenamed("seeds", "part").drop("fresh", "going")
            levels.append(found.withColumn("len", F.lit(distance).cast("bigint")))
            if len(levels) >= levels_per_block:
                written.append(cut(_union_all(levels)))
                levels = []
        if written:
            numbers = _union_all(written + levels).select("part", "len", "ids", "parents", "bits")
            found = numbers.mapInArrow(_pairs, "number bigint, id bigint, len int, parent bigint").join(seeds, "number")
            own = seeds.select("seed", F.col("seed").alias("id"), F.lit(1).alias("len"), F.lit(None).cast("bigint").alias("parent"))
            return paths_of(own.unionByName(found.select("seed", "id", "len", "parent")))
        part = F.expr(f"number div {SEEDS_PER_PART}")
        paths = [cut(first.groupBy("block", part.alias("part")).applyInArrow(_first_paths, _PATH))]
        for found in levels:
            both = paths[-1].unionByName(found.drop("len"), allowMissingColumns=True)
            paths.append(cut(both.groupBy("block", "part").applyInArrow(_extended, _PATH)))
        return _union_all(paths).select("len", "path").mapInArrow(
            _unpacked, "seed bigint, id bigint, len int, parent bigint, path array<bigint>"
        )

    def release(self) -> None:
        self._tiles.unpersist()


def _sorted_seeds(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids, numbers = rows["id"].to_numpy(), rows["number"].to_numpy()
    order = np.argsort(ids)
    return ids[order], numbers[order] % SEEDS_PER_ROW


def _first_reached(rows: pa.Table) -> pa.Table:
    ids, place = _sorted_seeds(rows)
    bits = np.left_shift(np.uint64(1), place.astype(np.uint64)).astype(np.int64).tobytes()
    block, seeds = _block_of(rows, "seeds", SEEDS_PER_ROW)
    return _rows(_REACHED, [block], [seeds], [None], [ids.tobytes()], [None], [bits], [bits], [len(ids)])


def _first_paths(rows: pa.Table) -> pa.Table:
    ids, place = _sorted_seeds(rows)
    block, part = _block_of(rows, "part", SEEDS_PER_PART)
    return _rows(_PATH, [block], [part], [1], [place.astype(np.uint8).tobytes()], [ids.tobytes()])


def _block_of(rows: pa.Table, name: str, together: int) -> tuple[int, int]:
    return rows["block"][0].as_py(), rows["number"][0].as_py() // together


def _search(arcs: DataFrame, seeds: DataFrame, limits: SkewLimits, levels_per_block: int) -> DataFrame:
    """``(seed, id, len, parent, path)`` over arcs and seeds (``seed``) of bigint ids."""
    links = _distinct_arcs(arcs)
    known = links.select(F.col("src").alias("seed")).union(links.select("dst")).distinct()
    asked = cut(known.join(seeds.select("seed").distinct(), "seed"))
    numbered = _numbered(asked, "seed", "number")
    searches = numbered.select(F.expr(f"number div {SEEDS_PER_SEARCH}").alias("first")).distinct().collect()
    layout = _Reverse(links, limits)
    try:
        found = [
            layout.search(numbered.where(F.expr(f"number div {SEEDS_PER_SEARCH}") == row["first"]), levels_per_block)
            for row in searches
        ]
    finally:
        layout.release()
    own = [F.col("seed"), F.col("seed").alias("id"), F.lit(1).alias("len"), F.lit(None).cast("bigint").alias("parent"), F.array("seed").alias("path")]
    return _union_all(found) if found else asked.select(*own)


def _numbered(rows: DataFrame, key: str, number: str) -> DataFrame:
    """Different keys with numbers in their order, not without gaps."""
    rows = cut(rows)
    parts = 1 + rows.count() // (1 << 16)
    return cut(rows.repartitionByRange(parts, key).sortWithinPartitions(key).withColumn(number, F.monotonically_increasing_id()))


def _search_named(arcs: DataFrame, seeds: DataFrame, limits: SkewLimits, levels_per_block: int) -> DataFrame:
    """:func:`_search` for ids that aren't whole numbers: nodes are numbered in the order of their ids first."""
    links = _distinct_arcs(arcs)
    names = _numbered(links.select(F.col("src").alias("name")).union(links.select("dst")).distinct(), "name", "number")
    source = names.select(F.col("name").alias("src"), F.col("number").alias("source"))
    target = names.select(F.col("name").alias("dst"), F.col("number").alias("target"))
    placed = lookup_join(lookup_join(links, source, "src"), target, "dst").select(F.col("source").alias("src"), F.col("target").alias("dst"))
    asked = names.join(seeds.select(F.col("seed").alias("name")).distinct(), "name").select(F.col("number").alias("seed"))
    found = cut(_search(placed, asked, limits, levels_per_block))
    steps = found.select("seed", "id", "len", F.posexplode("path").alias("place", "number")).hint("merge").join(names.hint("merge"), "number")
    paths = steps.groupBy("seed", "id", "len").agg(F.array_sort(F.collect_list(F.struct("place", "name"))).alias("steps"))
    path = paths.select("len", F.col("steps.name").alias("path"))
    return path.select(
        F.element_at("path", -1).alias("seed"), F.element_at("path", 1).alias("id"), "len", F.get("path", F.lit(1)).alias("parent"), "path"
    )


def _union_all(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
