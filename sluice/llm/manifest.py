"""A Merkle tree over a dataset, and a recursive query that climbs from every row to the root.

Rows are leaves, sorted by source and id. In each source's tree every three neighbours have one parent; the roots of the
sources are the leaves of one more such tree. All node digests are SHA-256, of digests as hex text.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm._frames import discard, id_back, id_of, written, written_at
from sluice.llm._order import numbered
from sluice.plans.layout import ROWS_PER_PARTITION
from sluice.plans.skew import lookup_join
from sluice.session import ensure_checkpoint_dir, shuffle_partitions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
#: Levels that one task builds at once over a block of neighbours, and that block's leaves.
BLOCK_LEVELS = 5
BLOCK = ARITY**BLOCK_LEVELS
#: A node's number: first leaf of its block, tier (five levels), place in the block.
_PLACE_BITS, _TIER_BITS = 8, 6
_MOST_TIERS = 8

_STEPS = "array<struct<before:binary,after:binary>>"
_RAISED = f"tree bigint, nodes bigint, block bigint, place bigint, steps {_STEPS}, top binary"
_PAIR = pa.struct([("before", pa.binary()), ("after", pa.binary())])
_RAISED_TYPES = pa.schema(
    [(name, pa.int64()) for name in ("tree", "nodes", "block", "place")] + [("steps", pa.list_(_PAIR)), ("top", pa.binary())]
)
_FLUSH = 10_000


def digest(*fields: Column) -> Column:
    """SHA-256 over each field's byte count, a colon and its text, or ``-`` for null; as 32 bytes."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def as_hex(value: Column | str) -> Column:
    return F.lower(F.hex(value))


def _powers() -> Column:
    return F.array(*[F.lit(BLOCK**k).cast("bigint") for k in range(_MOST_TIERS)])


def _tiers(nodes: str) -> Column:
    """Tiers above the leaves of a tree with so many leaves."""
    return F.size(F.filter(_powers(), lambda power: power < F.col(nodes)))


def _node_number(block: Column, tier: Column, place: Column) -> Column:
    shifted = F.shiftleft(block, _PLACE_BITS + _TIER_BITS)
    return shifted + tier.cast("bigint") * (1 << _PLACE_BITS) + place


def _raise_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(tree, nodes, block, place, hash)``, sorted by block and place, with their way up to the top of their block.

    ``steps`` has, level by level, the digests before and after a node among its parent's children. The highest node of the block
    comes in ``top`` with the block's place among the blocks of its tree. In a tree of several blocks all go up equally far.
    """
    out: list[tuple] = []

    def build(tree: int, nodes: int, block: int, first: int, level: list[str]) -> None:
        steps: list[list[dict]] = [[] for _ in level]
        width = 1
        while len(level) > 1 or (nodes > BLOCK and width < BLOCK):
            above = []
            for start in range(0, len(level), ARITY):
                run = level[start : start + ARITY]
                for k in range(len(run)):
                    beside = {"before": bytes.fromhex("".join(run[:k])), "after": bytes.fromhex("".join(run[k + 1 :]))}
                    for way in steps[(start + k) * width : (start + k + 1) * width]:
                        way.append(beside)
                above.append(hashlib.sha256("".join(run).encode()).hexdigest())
            level, width = above, width * ARITY
        if width > 1:
            out.extend((tree, nodes, block, first + k, way, None) for k, way in enumerate(steps))
        out.append((tree, nodes, block, (block - tree) // BLOCK, None, bytes.fromhex(level[0])))

    def table() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[] for _ in _RAISED_TYPES]
        arrays = [pa.array(values, field.type) for values, field in zip(columns, _RAISED_TYPES, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(arrays, schema=_RAISED_TYPES)

    open_, hashes = None, []
    for batch in batches:
        for tree, nodes, block, place, value in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if open_ is None or open_[2] != block:
                if open_ is not None:
                    build(*open_, hashes)
                open_, hashes = (tree, nodes, block, place), []
            hashes.append(value.hex())
            if len(out) >= _FLUSH:
                yield table()
    if open_ is not None:
        build(*open_, hashes)
    yield table()


def _grow(leaves: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The trees over ``leaves`` (``tree``, ``nodes``, ``place``, ``hash``), where ``tree`` is a number with room for its leaves after it.

    ``(lowest, upper, roots)``: the ways and tops of the blocks of leaves, ``(tree, tier, place, steps)`` of the nodes above
    these blocks that lower ones link to, ``(tree, hash)`` of each tree's root.
    """
    block = F.expr(f"tree + place div {BLOCK} * {BLOCK}")
    rest, tier, tiers, roots = leaves, 0, [], []
    while not tiers or not rest.isEmpty():
        raised = written(
            rest.select("tree", "nodes", block.alias("block"), "place", "hash")
            .repartition("block")
            .sortWithinPartitions("block", "place")
            .mapInArrow(_raise_blocks, _RAISED)
        )
        tiers.append(raised.where("top is null").select("tree", F.lit(tier).alias("tier"), "place", "steps"))
        tops = raised.where("top is not null").withColumnRenamed("top", "hash")
        roots.append(tops.where(F.col("nodes") <= BLOCK).select("tree", "hash"))
        if tier == 0:
            lowest = raised
        rest = tops.where(F.col("nodes") > BLOCK).select(
            "tree", F.expr(f"(nodes + {BLOCK - 1}) div {BLOCK}").alias("nodes"), "place", "hash"
        )
        tier += 1
    return lowest, _union(tiers[1:] or [tiers[0].limit(0)]), _union(roots)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (``position``, ``node``, ``tree``, ``block``, the id as ``_id``, ``leaf``, ``altered``), ``nodes`` (``node``, ``parent``,
    ``steps``), ``trees`` (``tree``, ``subroot``) and the ``root``, None for a table without rows."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: bytes | None


def build(docs: DataFrame, altered: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS) -> Manifest:
    """The manifest of ``docs``: every row a leaf, by ``source`` (null first) and ``doc_id`` (null first).

    ``fields`` are hashed in their order; other columns are not read. ``altered`` gives, by field, what a second digest of
    each row is taken from, for :func:`climb`. Rows with one id are ordered by their digests; equal
    rows are leaves next to each other. A node row has the digests beside its way up to its block's top, five levels
    above, and links to the row of that top. A row above a block of 243 leaves is stored once for each
    block below it, so that no node row is looked for by more than 243 leaves.
    """
    altered = altered or {}
    values = {name: F.col(name) for name in fields}
    # sources as strings that sort alike, null before all
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    hashed, path = written_at(
        docs.select(
            source.alias("source"),
            id_of("doc_id").alias("_id"),
            digest(*values.values()).alias("leaf"),
            digest(*{**values, **altered}.values()).alias("altered"),
        )
    )
    placed = numbered(hashed, "source", "_id", "leaf")
    discard(docs.sparkSession, path)
    # written, so that the join that follows may split a frequent source
    sources = written(placed.groupBy("source").agg(F.min("position").alias("tree"), F.count(F.lit(1)).alias("nodes")))
    # a source's first place is its number: sources ascend with it
    leaves = written(
        lookup_join(placed, sources, "source")
        .withColumn("place", F.col("position") - F.col("tree"))
        .withColumn("block", F.expr(f"tree + place div {BLOCK} * {BLOCK}"))
        .withColumn("node", _node_number(F.col("block"), F.lit(0), F.expr(f"place % {BLOCK}")))
        .drop("source")
    )
    lowest, upper, subroots = _grow(leaves.withColumnRenamed("leaf", "hash"))
    ranked = written(numbered(written(subroots.withColumnRenamed("hash", "subroot")), "tree", name="rank"))
    count = ranked.count()
    tops, top_upper, root = _grow(
        ranked.select(
            F.lit(0).cast("bigint").alias("tree"), F.lit(count).cast("bigint").alias("nodes"),
            F.col("rank").alias("place"), F.col("subroot").alias("hash"),
        )
    )
    top_nodes = tops.where("top is null").select(F.lit(0).alias("tier"), "place", "steps").unionByName(top_upper.drop("tree"))
    nodes = _linked(lowest, upper, ranked.select("tree", "rank"), top_nodes, count)
    found = root.first()
    return Manifest(leaves, nodes, ranked.select("tree", "subroot"), found and bytes(found["hash"]))


def _linked(lowest: DataFrame, upper: DataFrame, ranks: DataFrame, top_nodes: DataFrame, trees: int) -> DataFrame:
    """All node rows ``(node, parent, steps)``, those above a block of leaves for each block."""
    whole = lambda a, k: F.floor((a - a % k) / k).cast("bigint")
    power = lambda k: F.element_at(_powers(), (k + 1).cast("int"))
    nothing = F.lit(0).cast("bigint")
    inside = lowest.where("top is null").select(
        "block", F.lit(0).alias("tier"), (F.col("place") - (F.col("block") - F.col("tree"))).alias("place"), "steps"
    )
    blocks = written(
        lookup_join(lowest.where("top is not null").select("tree", "nodes", "block", "place"), ranks, "tree")
        .withColumn("tiers", _tiers("nodes"))
    )
    above = (
        blocks.where(F.col("tiers") > 1)
        .select("tree", "block", "place", F.explode(F.sequence(F.lit(1), F.col("tiers") - 1)).alias("tier"))
        .withColumn("place", whole(F.col("place"), power(F.col("tier") - 1)))
        .join(upper.hint("merge"), ["tree", "tier", "place"])
        .select("block", "tier", nothing.alias("place"), "steps")
    )
    top_tiers = sum(BLOCK**k < trees for k in range(_MOST_TIERS))
    over = blocks.select("block", "tiers", "rank", F.explode(F.sequence(F.lit(0), F.lit(max(top_tiers, 1) - 1))).alias("tier"))
    over = (
        over.withColumn("place", whole(F.col("rank"), power(F.col("tier"))))
        .join(top_nodes.hint("merge"), ["tier", "place"])
        .select("block", (F.col("tiers") + F.col("tier")).alias("tier"), nothing.alias("place"), "steps")
    )
    return _union([inside, above, over]).select(
        _node_number(F.col("block"), F.col("tier"), F.col("place")).alias("node"),
        _node_number(F.col("block"), F.col("tier") + 1, nothing).alias("parent"),
        "steps",
    )


# one step takes a row to the top of its block, folding level by level
_FOLD = """
aggregate(n.steps, c.folded, (h, s) -> unhex(sha2(concat(lower(hex(s.before)), lower(hex(h)), lower(hex(s.after))), 256)))"""
_SIBLINGS = "aggregate(n.steps, cast('' as binary), (all, s) -> concat(all, s.before, s.after))"
_CLIMB = f"""
with recursive climb(position, node, step, folded, siblings, row) as (
  select position, node, 0, folded, cast('' as binary), row from {{leaves}}
  union all
  select c.position, n.parent, c.step + 1, {_FOLD}, case when c.step = 0 then {_SIBLINGS} end, null
  from (select position, node, step, folded from climb) c join {{nodes}} n on n.node = c.node
)
select position, shiftright(node, {_PLACE_BITS + _TIER_BITS}) as block, step, folded, siblings, row from climb"""
# what is beside the way above a block is the same for all its leaves
_CLIMB_OF_BLOCKS = f"""
with recursive climb(block, node, step, siblings) as (
  select block, node, 1, cast('' as binary) from {{blocks}}
  union all
  select c.block, n.parent, c.step + 1, concat(c.siblings, {_SIBLINGS})
  from climb c join {{nodes}} n on n.node = c.node
)
select block, step, siblings from climb"""
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


@contextmanager
def _bucketed(nodes: DataFrame, rows: int) -> Iterator[str]:
    """``nodes`` as a table in buckets of node numbers, so that no step of a query moves them."""
    spark = nodes.sparkSession
    name = f"manifest_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark)}/{name}"
    parts = max(shuffle_partitions(spark), -(-rows // ROWS_PER_PARTITION))
    laid_out = nodes.repartition(parts, "node").write.format("parquet").option("path", path)
    laid_out.bucketBy(parts, "node").sortBy("node").saveAsTable(name)
    try:
        yield name
    finally:
        spark.sql(f"drop table {name}")
        discard(spark, path)


@contextmanager
def _any_number_of_rows(spark: SparkSession) -> Iterator[None]:
    """Recursive queries may give any number of rows."""
    limit = spark.conf.get(_ROW_LIMIT)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.set(_ROW_LIMIT, limit)


def climb(manifest: Manifest, folded: str = "altered") -> DataFrame:
    """``(position, _id, leaf, subroot, below, above, folded)`` of each leaf: the digests beside its way, up to its block's top and from
    there on, and what its column ``folded`` becomes at the root.

    A recursive query takes all leaves up, five levels a step, by a join on the node's number; another one takes the
    blocks up, so that the digests above a block, which its leaves share, are gathered once for all of them.
    """
    spark = manifest.leaves.sparkSession
    leaves = lookup_join(manifest.leaves, manifest.trees, "tree").select(
        "position", "node", F.col(folded).alias("folded"), F.struct("_id", "leaf", "subroot").alias("row")
    )
    # a leaf that has no neighbour begins where its block's own way begins
    first = _node_number(F.col("block"), F.lit(1), F.lit(0).cast("bigint"))
    blocks = manifest.leaves.select("block", first.alias("node")).distinct()
    with _bucketed(manifest.nodes, manifest.leaves.count()) as nodes, _any_number_of_rows(spark):
        above = spark.sql(_CLIMB_OF_BLOCKS.format(nodes=nodes, blocks="{blocks}"), blocks=blocks).groupBy("block")
        above = written(above.agg(F.max_by("siblings", "step").alias("above")))
        steps = spark.sql(_CLIMB.format(nodes=nodes, leaves="{leaves}"), leaves=leaves).groupBy("position", "block")
        found = steps.agg(
            F.max_by("folded", "step").alias("folded"),
            F.max_by("siblings", F.when(F.col("step") < 2, F.col("step"))).alias("below"),
            F.any_value("row", True).alias("row"),
        )
        found = written(found.select("position", "block", "row.*", "folded", "below"))
    return lookup_join(found, above, "block").drop("block")


def verify(docs: DataFrame, altered: dict[str, Column], fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof, folded_root, verified)`` for each row of ``docs``, digests as 32 bytes, ``proof`` as hex text.

    ``folded_root`` is the root that the row's ``altered`` values give together with the digests stored
    beside its way; ``verified`` says whether it is the root. Nulls in any field count as null, not as empty; an empty
    text is a text. A null id or source comes before all others. Rows with one id are all leaves, ordered by
    digest; rows equal in all fields are neighbours with proofs of their own. A text of any length is hashed
    in its row and not moved. An empty table gives no rows. Columns besides ``fields`` may have any names.
    """
    manifest = build(docs, altered, fields)
    root = F.lit(manifest.root)
    return climb(manifest).select(
        id_back("_id").alias("doc_id"),
        "leaf",
        "subroot",
        root.alias("root"),
        F.concat(as_hex("below"), as_hex("above")).alias("proof"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )
