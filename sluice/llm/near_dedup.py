"""Near copies: a multi-index join of short MinHash signatures under a Hamming threshold, confirmed on whole sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm._frames import KEY, column, id_back, row_key, spans_of, text_buffer, text_slices, written
from sluice.llm._words import lower_ascii, mix, run_hashes, word_hashes, word_spans
from sluice.llm.components import components
from sluice.llm.passages import CROWDED, MEETING, meet, meeting_rows

WORDS = 5
THRESHOLD = 80
#: Symbols of a signature, each the low 16 bits of one minimum, and the chunks they are split into. By the pigeonhole
#: principle two signatures with less than ``2 * CHUNKS`` different symbols have a chunk with at most one, and
#: so a key in common.
SYMBOLS = 32
CHUNKS = 8
#: Members of a bucket that are compared with as many others in one group, and their shingles.
BLOCK = 2048
BLOCK_SHINGLES = 1 << 21
#: Shingles that are brought together in one slice.
SLICE_SHINGLES = 1 << 20


def shingle_sets(batch: pa.RecordBatch, text: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """``(counts, hashes)``: how many distinct shingles each text has, and all of them, sorted in each text.

    A text of fewer words than ``words``, but not none, has all its words as its one shingle.
    """
    offsets, raw = text_buffer(batch.column(text))
    data = lower_ascii(raw)
    starts, ends, counts = word_spans(offsets, data)
    coded = word_hashes(data, starts, ends)
    runs = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    first_word = np.cumsum(counts) - counts
    begin = np.repeat(first_word, runs) + spans_of(runs)
    size = np.repeat(np.minimum(counts, words), runs)
    hashed = run_hashes(coded, begin, begin + size)
    row = np.repeat(np.arange(len(counts)), runs)
    order = np.lexsort((hashed, row))
    hashed, row = hashed[order], row[order]
    fresh = np.ones(len(hashed), bool)
    fresh[1:] = (hashed[1:] != hashed[:-1]) | (row[1:] != row[:-1])
    return np.bincount(row[fresh], minlength=len(counts)), hashed[fresh]


def _signatures(counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A row of ``SYMBOLS`` 16-bit symbols for each set that is not empty."""
    some = counts[counts > 0]
    starts = np.cumsum(some) - some
    found = np.empty((len(some), SYMBOLS), np.uint16)
    for k in range(SYMBOLS):
        salt = mix(np.array([k + 1], np.uint64))[0]
        least = np.minimum.reduceat((hashes ^ salt) * np.uint64(0xFF51AFD7ED558CCD), starts) if len(some) else hashes
        found[:, k] = (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return found


def _keys(signatures: np.ndarray) -> np.ndarray:
    """For each chunk and each symbol that may be wrong in it, a hash of the chunk's other symbols."""
    size = SYMBOLS // CHUNKS
    found = np.empty((len(signatures), SYMBOLS), np.int64)
    for chunk in range(CHUNKS):
        part = signatures[:, chunk * size : (chunk + 1) * size].astype(np.uint64)
        for wrong in range(size):
            coded = np.full(len(part), chunk * size + wrong + 1, np.uint64)
            for place in range(size):
                if place != wrong:
                    coded = mix(coded + part[:, place] * np.uint64(0x9E3779B97F4A7C15))
            found[:, chunk * size + wrong] = coded.view(np.int64)
    return found


def _measure(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, len(KEY)):
            counts, hashes = shingle_sets(batch, len(KEY), words)
            some = counts > 0
            starts = (np.cumsum(counts) - counts)[some]
            prints = np.zeros((2, len(counts)), np.uint64)
            for k in range(2):
                if len(starts):
                    prints[k, some] = np.add.reduceat(mix(hashes + np.uint64(k + 1)), starts)
            raw = np.zeros((len(counts), SYMBOLS), np.uint16)
            raw[some] = _signatures(counts, hashes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(len(KEY))]
                + [pa.array(counts, pa.int64()), pa.array(prints[0].view(np.int64)), pa.array(prints[1].view(np.int64))]
                + [pa.array([x.tobytes() for x in raw], pa.binary())],
                names=[*KEY, "n_shingles", "s1", "s2", "signature"],
            )

    return run


def _add_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = b"".join(batch.column(2).to_pylist())
        keys = _keys(np.frombuffer(raw, np.uint16).reshape(-1, SYMBOLS))
        ends = pa.array(np.arange(len(keys) + 1) * SYMBOLS, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))],
            names=["node", "n", "keys"],
        )


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            counts, hashes = shingle_sets(batch, 1, words)
            ends = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, pa.array(hashes.view(np.int64)))], names=["node", "shingles"]
            )

    return run


def _find_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each node, to meet those of others."""
    for batch in batches:
        lists = batch.column(1)
        ends = lists.offsets.to_numpy()
        hashes = lists.values.to_numpy()
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE_SHINGLES, side="right")) - 1)
            owner = np.repeat(column(batch, 0)[first:last], np.diff(ends[first : last + 1]))
            yield meeting_rows(hashes[ends[first] : ends[last]], owner)
            first = last


def _links_of_blocks(threshold: int):
    """Links between members of a group, by their whole sets: as many as it takes to connect what is linked.

    Each member of one side looks up its shingles among those of the other side, which counts what it has in common
    with each of them. Members that are connected already are not told apart any more.
    """

    def run(group: pa.Table) -> pa.Table:
        node, n, root, side = (group.column(k).to_numpy() for k in ("node", "n", "root", "side"))
        sets = group.column("shingles").combine_chunks()
        ends, hashes = sets.offsets.to_numpy(), sets.values.to_numpy()
        sizes = np.diff(ends)
        left, right = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
        place = np.repeat(np.arange(len(right)), sizes[right])
        values = hashes[np.repeat(ends[right], sizes[right]) + spans_of(sizes[right])]
        order = np.argsort(values, kind="stable")
        values, place = values[order], place[order]
        part = np.unique(root, return_inverse=True)[1]
        a, b = [], []
        for one in left:
            own = hashes[ends[one] : ends[one + 1]]
            first = np.searchsorted(values, own, side="left")
            count = np.searchsorted(values, own, side="right") - first
            both = np.bincount(place[np.repeat(first, count) + spans_of(count)], minlength=len(right))
            # within one block each pair is seen from both sides
            near = 100 * both >= threshold * (n[right] + n[one] - both)
            near &= (side[right] > 0) | (right > one)
            other = right[near]
            other = other[part[other] != part[one]]
            joined, at = np.unique(part[other], return_index=True)
            for two in node[other[at]]:
                a.append(min(node[one], two))
                b.append(max(node[one], two))
            part[np.isin(part, joined)] = part[one]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets are as similar as asked."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    met = pairs.join(two.hint("merge"), "b").join(one.hint("merge"), "a")
    both = F.size(F.array_intersect("sa", "sb"))
    similar = 100 * both >= threshold * (F.size("sa") + F.size("sb") - both)
    return written(met.where(similar).select("a", "b"))


def near_copies(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """``(_id, _t1, _t2, n_shingles, component, root, kept)`` for each row of ``docs`` (``doc_id``, ``text``).

    Documents are linked when ``100 * |A ∩ B| >= threshold * |A ∪ B|`` for their sets of shingles of ``words`` words,
    with A-Z lower-cased. ``component`` is the least id that a document reaches over links, a null
    id before all others; ``kept`` marks the rows with that id. ``root`` tells components of the same
    least id apart; documents without words have none.

    Equal sets are one node from the start. Nodes with a common key are candidates; each is first
    checked against the node of its bucket that meets most others. Then, in buckets that still hold several
    components, members of different components are compared by their whole sets, block by block, and
    each block gives the links that connect its components, not all its pairs. How many shingles a node has in common with any other candidate bounds its
    similarity to each, so most members of a loose group need no check, and no link between components is lost.
    Documents without words are linked with nothing. Rows of one id are told apart by their texts.
    """
    keyed = docs.select(*row_key(), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    measured = written(
        keyed.mapInArrow(
            _measure(words),
            "_id bigint, _t1 bigint, _t2 bigint, n_shingles bigint, s1 bigint, s2 bigint, signature binary",
        )
    )
    some = measured.where("n_shingles > 0")
    first = F.min(F.struct(*KEY, "n_shingles", "signature")).alias("first")
    nodes = written(
        some.groupBy("s1", "s2")
        .agg(first)
        .select("s1", "s2", "first.*", F.monotonically_increasing_id().alias("node"))
    )
    members = _members_of_buckets(nodes)
    sets = _sets_of(members.select("node").distinct(), nodes, keyed, words)
    common = meet(sets.mapInArrow(_find_shingles, MEETING), CROWDED).where("not crowded")
    common = written(common.groupBy(F.col("owner").alias("node")).agg(F.count(F.lit(1)).alias("common")))
    # a node that shares no shingle with any other cannot be linked
    members = written(members.join(common.hint("merge"), "node"))

    # the text that copies were made of meets more nodes than any of these
    centre = F.min(F.struct((-F.col("met")).alias("met"), "node", "n")).alias("centre")
    starred = members.join(members.groupBy("key").agg(centre).hint("merge"), "key")
    stars = starred.where((F.col("node") != F.col("centre.node")) & _may_link(F.col("centre.n"), threshold))
    ends = F.col("centre.node"), F.col("node")
    stars = written(stars.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct())
    links = _confirmed(stars, sets, threshold)
    roots = written(components(links))
    more = written(_links_between_components(members, roots, sets, threshold))
    if not more.isEmpty():
        known = roots.select(F.col("root").alias("a"), F.col("node").alias("b"))
        roots = components(known.unionByName(more))
    return _components_of_rows(measured, nodes, roots)


def _may_link(other_size: Column, threshold: int) -> Column:
    """Whether a node of ``n`` shingles, ``common`` of which others have, may be as similar to one of ``other_size``."""
    return (100 + threshold) * F.least("common", other_size) >= threshold * (F.col("n") + other_size)


def _members_of_buckets(nodes: DataFrame) -> DataFrame:
    """``(key, node, n, met)`` for the keys that several nodes have; ``met`` sums up the sizes of all buckets of a node."""
    indexed = written(
        nodes.select("node", F.col("n_shingles").alias("n"), "signature").mapInArrow(
            _add_keys, "node bigint, n bigint, keys array<bigint>"
        )
    )
    members = indexed.select("node", "n", F.explode("keys").alias("key"))
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = written(members.join(buckets.hint("merge"), "key").select("key", "node", "n", "size"))
    met = shared.groupBy("node").agg(F.sum("size").alias("met"))
    return shared.drop("size").join(met.hint("merge"), "node")


def _sets_of(wanted: DataFrame, nodes: DataFrame, keyed: DataFrame, words: int) -> DataFrame:
    """``(node, shingles)`` of the nodes in ``wanted``."""
    keys = nodes.select("node", *KEY).join(wanted.hint("merge"), "node")
    texts = keyed.join(keys.hint("merge"), KEY).select("node", "text")
    # rows equal in id and text give a node's text more than once
    return written(texts.mapInArrow(_sets(words), "node bigint, shingles array<bigint>").dropDuplicates(["node"]))


def _links_between_components(members: DataFrame, roots: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links ``(a, b)`` that connect the components of each bucket as far as its members are similar."""
    own = members.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = members.groupBy("key").agg(F.min("n").alias("least"))
    # of all sizes in the bucket that of its common shingles suits a node best, or the least one above it
    best = F.greatest("least", "common")
    own = own.join(least.hint("merge"), "key").where(_may_link(best, threshold))
    own = written(own.select("key", "node", "n", "common", "root"))
    mixed = own.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles")
    )
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    mixed = mixed.where("low <> high").select("key", blocks.alias("blocks"))
    compared = own.join(mixed.hint("merge"), "key").join(sets.hint("merge"), "node")
    spread = compared.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    spread = spread.select("*", F.explode(other).alias("other")).select(
        "key",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        *["node", "n", "root", "shingles"],
        F.signum(F.col("block") - F.col("other")).cast("int").alias("side"),
    )
    return spread.groupBy("key", "i", "j").applyInArrow(_links_of_blocks(threshold), "a bigint, b bigint").distinct()


def _components_of_rows(measured: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    in_node = nodes.select("s1", "s2", "node", F.col("_id").alias("least"))
    known = in_node.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    classes = written(known.join(least.hint("merge"), "root").select("s1", "s2", "component", "root"))
    some = measured.where("n_shingles > 0").join(classes.hint("merge"), ["s1", "s2"])
    none = measured.where("n_shingles = 0").withColumn("component", F.col("_id"))
    none = none.withColumn("root", F.lit(None).cast("bigint"))
    columns = [*KEY, "n_shingles", "component", "root"]
    rows = some.select(*columns).unionByName(none.select(*columns))
    return rows.withColumn("kept", F.col("_id") == F.col("component"))


def near_dedup(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs``; see :func:`near_copies`."""
    return near_copies(docs, words, threshold).select(
        id_back("_id").alias("doc_id"), "n_shingles", id_back("component").alias("component_id"), "kept"
    )


def drop_near_copies(
    docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD, one_row: bool = False
) -> DataFrame:
    """The rows of ``docs`` with the least id of their component, with all their columns.

    With ``one_row`` one row of each component stays, the least by id and text hash; of rows equal in both any one.
    Documents without words are linked with nothing, so all of them stay.
    """
    found = near_copies(docs, words, threshold)
    rows = docs.select(F.struct("*").alias("row"), *row_key())
    if not one_row:
        return rows.join(found.where("kept").select(*KEY).distinct().hint("merge"), KEY, "left_semi").select("row.*")
    least = found.where("root is not null").groupBy("root").agg(F.min(F.struct(*KEY)).alias("least")).select("least.*")
    empty = found.where("root is null").select(*KEY).distinct()
    kept = least.withColumn("linked", F.lit(True)).unionByName(empty.withColumn("linked", F.lit(False)))
    # equal rows with words share a tie, any other row has its own
    tied = rows.withColumn("place", F.monotonically_increasing_id()).join(kept.hint("merge"), KEY)
    tied = tied.withColumn("tie", F.when(F.col("linked"), F.lit(-1)).otherwise(F.col("place")))
    return tied.dropDuplicates([*KEY, "tie"]).select("row.*")
