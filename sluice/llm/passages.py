"""Where windows of fixed length occur more than once: candidates are brought together by minimizers.

A window is a run of ``window`` units (bytes or words) of one text. Its minimizer is the run of
``gram`` units in it with the least hash, the leftmost of equals, so equal windows have equal minimizers. Windows
that follow each other and have their minimizer at the same place make a *segment*. Two equal
windows lie in two segments with the same key, the minimizer's hash, and at the same distance from it; inside one segment all
windows differ. A segment whose key comes once in all texts holds no repeat and is dropped early.

What is left is grouped by key. An index of the caller's choosing is built over the distinct segments of
each group and says for each window which segment has it first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm._frames import column, hashes, id_of, spans_of, text_buffer, text_slices, written
from sluice.llm._words import _powers_for, byte_values, mix, run_hashes, word_hashes, word_spans

#: Units that are looked at together. A place in them takes the low bits of a minimizer's rank.
CHUNK_BITS = 20
CHUNK = 1 << CHUNK_BITS
#: A key in more slices of text than this is *crowded*: its windows are met one by one instead.
CROWDED = 1024
#: Bytes of segments that are indexed together; a group is never cut.
COLLECTION_BYTES = 1 << 20
_GRAM_STEP = 0xA0761D6478BD642F
_SECOND = np.uint64(0xE7037ED1A0B428DB)


@dataclass(frozen=True)
class Grain:
    """Units of a text, and the windows over them."""

    window: int
    gram: int
    words: bool

    def units(self, texts: pa.Array) -> _Units:
        offsets, data = text_buffer(texts)
        if not self.words:
            starts = np.arange(len(data) + 1)
            return _Units(byte_values()[data], np.diff(offsets), data, starts[:-1], starts[1:])
        starts, ends, counts = word_spans(offsets, data)
        return _Units(word_hashes(data, starts, ends), counts, data, starts, ends)


@dataclass
class _Units:
    """Hashes of the units of several texts, one text after another, and the bytes of each unit."""

    values: np.ndarray
    counts: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def contents(self, first: np.ndarray, size: np.ndarray) -> list[bytes]:
        """The bytes from unit ``first`` on, ``size`` units long."""
        raw = self.data.tobytes()
        begins, finishes = self.starts[first], self.ends[first + size - 1]
        return [raw[a:b] for a, b in zip(begins.tolist(), finishes.tolist(), strict=True)]


@dataclass
class Segments:
    """``text`` is a place in the batch, ``first`` a unit of it, ``at`` the same unit among all units."""

    text: np.ndarray
    key: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    at: np.ndarray


def segments(units: _Units, grain: Grain) -> Segments:
    ends = np.cumsum(units.counts)
    begins = ends - units.counts
    total = int(ends[-1]) if len(ends) else 0
    parts: list[tuple[np.ndarray, ...]] = []
    step = CHUNK - grain.window
    for low in range(0, total, step):
        high = min(total, low + step + grain.window - 1)
        part = _chunk_segments(units.values[low:high], low, min(step, total - low), begins, ends, grain)
        if part is not None:
            parts.append(part)
    empty = np.zeros(0, np.int64)
    joined = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [empty, empty.astype(np.uint64), empty, empty]
    text, key, at, windows = joined
    return Segments(text, key.view(np.int64), at - begins[text], windows, at)


def _chunk_segments(values, low: int, count: int, begins, ends, grain: Grain):
    """Segments of the windows that start at the first ``count`` units of a chunk that begins at unit ``low``."""
    if len(values) < grain.window:
        return None
    powers, inverses = _powers_for(_GRAM_STEP, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=sums[1:])
    grams = sums[grain.gram :] - sums[: -grain.gram]
    grams *= inverses[: len(grams)]
    grams = mix(grams)
    ranks = (grams & ~np.uint64(CHUNK - 1)) | np.arange(len(grams), dtype=np.uint64)
    width, span = grain.window - grain.gram + 1, 1
    while span * 2 <= width:
        ranks = np.minimum(ranks[:-span], ranks[span:])
        span *= 2
    if span < width:
        ranks = np.minimum(ranks[: len(ranks) - (width - span)], ranks[width - span :])
    ranks = ranks[:count]
    fresh = np.ones(len(ranks), bool)
    fresh[1:] = ranks[1:] != ranks[:-1]
    first_text = np.searchsorted(ends, low, side="right")
    last_text = np.searchsorted(begins, low + len(ranks), side="left")
    heads = begins[first_text:last_text] - low
    fresh[heads[(heads >= 0) & (heads < len(ranks))]] = True
    start = np.flatnonzero(fresh)
    stop = np.append(start[1:], len(ranks))
    text = np.searchsorted(ends, start + low, side="right")
    stop = np.minimum(stop, ends[text] - low - grain.window + 1)
    keep = stop > start
    start, stop, text = start[keep], stop[keep], text[keep]
    place = (ranks[start] & np.uint64(CHUNK - 1)).astype(np.int64)
    return text, grams[place], start + low, stop - start


#: A document: its id, and a hash of its text that tells rows of one id apart.
DOCUMENT = ["_id", "_t1"]


def document_key() -> list[Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [id_of().alias("_id"), hashes(text)[0].alias("_t1")]


# kinds of a row: a key that a slice has once, one that it has several times, a decided document of the latter
LONE, ANNOUNCED, DECIDED = range(3)
MEETING = "route bigint, key bigint, owner bigint, kind tinyint"
MET = "key bigint, owner bigint, crowded boolean"


def meeting_rows(key: np.ndarray, owner: np.ndarray, within: bool = False) -> pa.RecordBatch:
    """Rows by which the owners of a key in this slice meet those in others.

    A key that the slice has once is sent as it is. One that it has several times is decided here and goes out once, whatever
    its number, so no key has more rows than there are slices. ``within`` counts every occurrence, otherwise
    owners are counted.
    """
    order = np.lexsort((owner, key))
    key, owner = key[order], owner[order]
    heads = np.ones(len(key), bool)
    heads[1:] = key[1:] != key[:-1]
    fresh = heads.copy()
    fresh[1:] |= owner[1:] != owner[:-1]
    group = np.cumsum(heads) - 1
    times = np.bincount(group, weights=None if within else fresh)
    announced = key[heads][times > 1]
    local = (times[group] > 1)[fresh]
    key, owner = key[fresh], owner[fresh]
    none = np.zeros(len(announced), np.int64)
    sizes = (int((~local).sum()), len(announced), int(local.sum()))
    columns = (
        [key[~local], announced, owner[local]],
        [key[~local], announced, key[local]],
        [owner[~local], none, owner[local]],
        [np.full(n, kind, np.int8) for kind, n in enumerate(sizes)],
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(parts)) for parts in columns], names=["route", "key", "owner", "kind"]
    )


def meet(rows: DataFrame, crowded: int) -> DataFrame:
    """``(key, owner, crowded)``: the owners of keys that two owners have, and each key of more than ``crowded`` slices by itself."""
    return rows.repartition("route").sortWithinPartitions("key").mapInArrow(_meet_keys(crowded), MET)


def _find_keys(grain: Grain, within: bool):
    """From ``(owner, text)``: the keys of the segments of each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            found = segments(grain.units(batch.column(1)), grain)
            yield meeting_rows(found.key, column(batch, 0)[found.text], within)

    return run


def _meet_keys(crowded: int):
    """From rows sorted by key: what is decided, and the documents of keys that two slices have.

    A key of more than ``crowded`` slices is named once more, as crowded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (key, owner, kind, passed on) of the last row so far
        times = 0  # rows of its key so far
        for batch in batches:
            key, owner, kind = column(batch, 1), column(batch, 2), column(batch, 3)
            out_key, out_owner = [key[kind == DECIDED]], [owner[kind == DECIDED]]
            some = kind != DECIDED
            key, owner, kind = key[some], owner[some], kind[some]
            names = []
            if len(key):
                done = np.zeros(len(key), bool)
                if held is not None:
                    key = np.append(held[0], key)
                    owner = np.append(held[1], owner)
                    kind = np.append(held[2], kind)
                    done = np.append(held[3], done)
                equal = key[1:] == key[:-1]
                met = np.zeros(len(key), bool)
                met[1:] |= equal
                met[:-1] |= equal
                met |= done
                go = met & ~done & (kind == LONE)
                out_key.append(key[go])
                out_owner.append(owner[go])
                heads = np.flatnonzero(np.append(True, ~equal))
                sizes = np.diff(np.append(heads, len(key)))
                if held is not None:
                    sizes[0] += times - 1
                names = key[heads[:-1]][sizes[:-1] > crowded]
                held, times = (key[-1], owner[-1], kind[-1], bool(met[-1])), int(sizes[-1])
            keys, owners = np.concatenate(out_key), np.concatenate(out_owner)
            yield _found_rows(keys, owners, names)
        if held is not None and times > crowded:
            yield _found_rows(np.zeros(0, np.int64), np.zeros(0, np.int64), np.array([held[0]]))

    return run


def _found_rows(keys: np.ndarray, owners: np.ndarray, names) -> pa.RecordBatch:
    names = np.asarray(names, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.append(keys, names)),
            pa.array(np.append(owners, np.zeros(len(names), np.int64))),
            pa.array(np.append(np.zeros(len(keys), bool), np.ones(len(names), bool))),
        ],
        names=["key", "owner", "crowded"],
    )


TEXT, KEYS = 2, 3


def _wanted(batch: pa.RecordBatch, grain: Grain) -> tuple[_Units, Segments]:
    """The segments of a slice of ``(_id, _t1, text, keys)`` whose key is among the row's ``keys``."""
    units = grain.units(batch.column(TEXT))
    found = segments(units, grain)
    lists = batch.column(KEYS)
    wanted = lists.flatten().to_numpy()
    row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    # pairs of text and key, matched by a sort of both
    both_row = np.concatenate([row, found.text])
    both_key = np.concatenate([wanted, found.key])
    asks = np.arange(len(both_row)) >= len(row)
    order = np.lexsort((asks, both_key, both_row))
    heads = np.ones(len(order), bool)
    heads[1:] = _differ(order, both_row, both_key)
    has = ~asks[order][heads]
    keep = np.zeros(len(order), bool)
    keep[order] = has[np.cumsum(heads) - 1]
    mask = keep[len(row) :]
    return units, Segments(*[getattr(found, name)[mask] for name in ("text", "key", "first", "windows", "at")])


def _differ(order: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """For all but the first in ``order``: whether it differs from the one before in any of ``columns``."""
    found = np.zeros(max(len(order) - 1, 0), bool)
    for values in columns:
        ordered = values[order]
        found |= ordered[1:] != ordered[:-1]
    return found


def _names_of(units: _Units, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the ``size`` units from ``at`` on."""
    one = run_hashes(units.values, at, at + size)
    two = run_hashes(mix(units.values ^ _SECOND), at, at + size)
    return one.view(np.int64), two.view(np.int64)


# kinds of a place: windows that occur earlier, and a segment that may have some
SPAN, OPEN = 0, 1
_PLACE_NAMES = ["kind", "key", "c1", "c2", "_id", "_t1", "low", "high"]
PLACES = "kind tinyint, key bigint, c1 bigint, c2 bigint, _id bigint, _t1 bigint, low bigint, high bigint"


def _decide(key, one, two, ids, texts, low, within: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(order, first, later)``: an order by content and place, the head of each content in it, and which occur earlier for sure."""
    order = np.lexsort((low, texts, ids, two, one, key))
    first = np.ones(len(order), bool)
    first[1:] = _differ(order, key, one, two)
    if within:
        same = np.zeros(len(order), bool)
        same[1:] = ~first[1:] & ~_differ(order, ids, texts, low)
        return order, first, ~first & ~same
    ordered = ids[order]
    least = ordered[first][np.cumsum(first) - 1]
    return order, first, ordered > least


def _place_rows(kind: int, columns: list[np.ndarray]) -> list[np.ndarray]:
    return [np.full(len(columns[0]), kind, np.int8), *columns]


def _merged_spans(ids, texts, low, high) -> list[np.ndarray]:
    """Spans of neighbouring windows as one."""
    order = np.lexsort((low, texts, ids))
    ids, texts, low, high = ids[order], texts[order], low[order], high[order]
    heads = np.ones(len(order), bool)
    heads[1:] = (ids[1:] != ids[:-1]) | (texts[1:] != texts[:-1]) | (low[1:] > high[:-1] + 1)
    tails = np.append(heads[1:], True)[: len(heads)]
    none = np.zeros(int(heads.sum()), np.int64)
    return [none, none, none, ids[heads], texts[heads], low[heads], high[tails]]


def _places(grain: Grain, within: bool):
    """The segments of each slice: one place for each content, and what occurs earlier in the same slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, TEXT):
            units, found = _wanted(batch, grain)
            one, two = _names_of(units, found.at, found.windows + grain.window - 1)
            ids, texts = column(batch, 0)[found.text], column(batch, 1)[found.text]
            order, _, later = _decide(found.key, one, two, ids, texts, found.first, within)
            high = found.first + found.windows - 1
            gone, left = order[later], order[~later]
            spans = _place_rows(SPAN, _merged_spans(ids[gone], texts[gone], found.first[gone], high[gone]))
            open_ = _place_rows(OPEN, [x[left] for x in (found.key, one, two, ids, texts, found.first, high)])
            columns = [np.concatenate(pair) for pair in zip(spans, open_, strict=True)]
            # copies of one text go apart
            route = np.concatenate([spans[4] ^ spans[5], open_[1]])
            yield pa.RecordBatch.from_arrays([pa.array(route), *map(pa.array, columns)], names=["route", *_PLACE_NAMES])

    return run


def _merge_places(within: bool):
    """From rows sorted by key: spans, those of places that others precede, and open places whose key has several contents."""

    def answer(columns: list[np.ndarray]) -> list[np.ndarray]:
        key, one, two, ids, texts, low, high = columns
        order, first, later = _decide(key, one, two, ids, texts, low, within)
        ordered = key[order]
        heads = np.ones(len(order), bool)
        heads[1:] = ordered[1:] != ordered[:-1]
        group = np.cumsum(heads) - 1
        several = np.bincount(group, weights=first)[group] > 1
        gone, left = order[later], order[~later & several]
        spans = _place_rows(SPAN, _merged_spans(ids[gone], texts[gone], low[gone], high[gone]))
        open_ = _place_rows(OPEN, [x[left] for x in columns])
        return [np.concatenate(pair) for pair in zip(spans, open_, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            columns = [column(batch, k + 1) for k in range(len(_PLACE_NAMES))]
            decided = columns[0] == SPAN
            yield _batch([x[decided] for x in columns])
            fresh = [x[~decided] for x in columns[1:]]
            held = fresh if held is None else [np.append(a, b) for a, b in zip(held, fresh, strict=True)]
            if len(held[0]):
                # the last group may go on in the next batch
                cut = int(np.searchsorted(held[0], held[0][-1]))
                yield _batch(answer([x[:cut] for x in held]))
                held = [x[cut:] for x in held]
        if held is not None:
            yield _batch(answer(held))

    return run


def _batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=_PLACE_NAMES)


def _contents(grain: Grain):
    """From ``(_id, _t1, text, places)``: each open place with its content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, TEXT):
            units = grain.units(batch.column(TEXT))
            lists = batch.column(KEYS)
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            key, one, two, low, high = (x.to_numpy() for x in lists.flatten().flatten())
            at = (np.cumsum(units.counts) - units.counts)[row] + low
            raw = units.contents(at, high - low + grain.window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (key, one, two, column(batch, 0)[row], column(batch, 1)[row], low, high)]
                + [pa.array(raw, pa.binary())],
                names=[*_PLACE_NAMES[1:], "content"],
            )

    return run


@dataclass
class Collection:
    """Segments sorted by key; ``document`` ranks their documents by id, ``first`` is the place in it."""

    key: np.ndarray
    document: np.ndarray
    ids: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    contents: list[bytes]


#: From a collection: the runs of windows ``(segment, from, to)`` that another segment has earlier.
Index = Callable[[Collection], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _indexed(index: Index):
    """Collections of whole groups from rows sorted by key, each given to ``index``."""

    def answer(columns: list[np.ndarray], contents: list[bytes]) -> pa.RecordBatch:
        key, one, two, ids, texts, low, high = columns
        # a document that the table holds twice gives its places twice
        order = np.lexsort((low, texts, ids, two, one, key))
        fresh = np.ones(len(order), bool)
        fresh[1:] = _differ(order, key, one, two, ids, texts, low)
        pick = order[fresh]
        key, ids, texts, low, high = (x[pick] for x in (key, ids, texts, low, high))
        documents = np.lexsort((texts, ids))
        steps = np.zeros(len(documents), bool)
        steps[1:] = _differ(documents, ids, texts)
        rank = np.empty(len(documents), np.int64)
        rank[documents] = np.cumsum(steps)
        found = Collection(key, rank, ids, low, high - low + 1, [contents[k] for k in pick.tolist()])
        segment, start, stop = index(found)
        begin = low[segment]
        spans = _merged_spans(ids[segment], texts[segment], begin + start, begin + stop)
        return pa.RecordBatch.from_arrays(list(map(pa.array, spans[3:])), names=[*DOCUMENT, "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        contents: list[bytes] = []
        for batch in batches:
            fresh = [column(batch, k) for k in range(len(_PLACE_NAMES) - 1)]
            held = [np.append(a, b) for a, b in zip(held, fresh, strict=True)] if contents else fresh
            contents += batch.column(len(_PLACE_NAMES) - 1).to_pylist()
            if sum(map(len, contents)) < COLLECTION_BYTES:
                continue
            # the last group may go on in the next batch
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if cut:
                yield answer([x[:cut] for x in held], contents[:cut])
                held, contents = [x[cut:] for x in held], contents[cut:]
        if contents:
            yield answer(held, contents)

    return run


def _window_places(grain: Grain):
    """Every single window of the wanted segments, by two hashes of its content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, TEXT):
            units, found = _wanted(batch, grain)
            step = spans_of(found.windows)
            at = np.repeat(found.at, found.windows) + step
            one, two = _names_of(units, at, np.full(len(at), grain.window))
            text = np.repeat(found.text, found.windows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (one, two, column(batch, 0)[text], column(batch, 1)[text])]
                + [pa.array(np.repeat(found.first, found.windows) + step)],
                names=["c1", "c2", *DOCUMENT, "low"],
            )

    return run


@dataclass
class Repeats:
    """``texts`` (DOCUMENT, text) that may hold repeats, and ``spans`` (DOCUMENT, low, high): windows to remove, by their first unit."""

    texts: DataFrame
    spans: DataFrame


def repeated_windows(docs: DataFrame, grain: Grain, index: Index, within: bool, crowded: int = CROWDED) -> Repeats:
    """The windows of ``docs`` (``doc_id``, ``text``) that occur earlier.

    With ``within``, earlier is a smaller id, or the same document and an earlier start. Without, it is a smaller id alone.
    Of equal segments only the first place is open (without ``within``, all places of the first id); the others are
    decided. An open place whose key has other contents too goes to ``index`` with its content.
    """
    rows = docs.select(*document_key(), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("owner", F.xxhash64(*DOCUMENT))
    met = written(meet(rows.select("owner", "text").mapInArrow(_find_keys(grain, within), MEETING), crowded))
    names = met.where("crowded").select("key").distinct()
    owned = met.where("not crowded")
    lists = owned.groupBy("owner").agg(F.collect_set("key").alias("keys"), F.array().cast("array<bigint>").alias("crowds"))
    is_crowded = not names.isEmpty()
    if is_crowded:
        split = owned.distinct().join(names.withColumn("crowd", F.lit(True)).hint("merge"), "key", "left")
        lists = split.groupBy("owner").agg(
            F.collect_list(F.when(F.col("crowd").isNull(), F.col("key"))).alias("keys"),
            F.collect_list(F.when(F.col("crowd"), F.col("key"))).alias("crowds"),
        )
    texts = written(rows.join(lists.hint("merge"), "owner").select(*DOCUMENT, "text", "keys", "crowds"))

    places = (
        texts.select(*DOCUMENT, "text", "keys")
        .mapInArrow(_places(grain, within), f"route bigint, {PLACES}")
        .repartition("route")
        .sortWithinPartitions("key")
        .mapInArrow(_merge_places(within), PLACES)
    )
    places = written(places)
    open_ = places.where(F.col("kind") == OPEN).groupBy(*DOCUMENT)
    open_ = open_.agg(F.collect_list(F.struct("key", "c1", "c2", "low", "high")).alias("places"))
    indexed = (
        texts.select(*DOCUMENT, "text")
        .join(open_.hint("merge"), DOCUMENT)
        .select(*DOCUMENT, "text", "places")
        .mapInArrow(_contents(grain), PLACES.removeprefix("kind tinyint, ") + ", content binary")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_indexed(index), "_id bigint, _t1 bigint, low bigint, high bigint")
    )
    spans = places.where(F.col("kind") == SPAN).select(*DOCUMENT, "low", "high").unionByName(written(indexed))
    if is_crowded:
        spans = spans.unionByName(_crowded_spans(texts, grain, within))
    return Repeats(texts.select(*DOCUMENT, "text"), spans)


def _crowded_spans(texts: DataFrame, grain: Grain, within: bool) -> DataFrame:
    """The windows of crowded segments that occur earlier, each met by its own content."""
    single = written(
        texts.select(*DOCUMENT, "text", F.col("crowds").alias("keys")).mapInArrow(
            _window_places(grain), "c1 bigint, c2 bigint, _id bigint, _t1 bigint, low bigint"
        )
    )
    place = F.struct(*DOCUMENT, "low")
    least = single.groupBy("c1", "c2").agg(F.min(place).alias("least"))
    later = place > F.col("least") if within else F.col("_id") > F.col("least._id")
    found = single.join(least.hint("merge"), ["c1", "c2"]).where(later)
    return found.select(*DOCUMENT, "low", F.col("low").alias("high"))
