"""Byte passages that occur earlier, by the sorted suffixes of many strings, built one symbol of each string at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._frames import id_back
from sluice.llm.passages import CROWDED, DOCUMENT, Collection, Grain, document_key, repeated_windows

WINDOW = 100
GRAM = 32


def sorted_suffixes(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(string, length, common)`` of all suffixes in sorted order, with the length of each one's common prefix with the one before.

    Built column by column from the right: round ``j`` finds how many suffixes of the rounds before lie before the suffix of length ``j`` of
    every string. ``shorter`` leads from each suffix to the place of the one without its first symbol, which is the strings'
    Burrows-Wheeler transform so far, read backwards. Among suffixes with one first symbol it ascends, so that number
    is found by halving. ``shorter`` is written anew after every eighth round: what came in eight rounds is put in order by eight symbols, and
    by the place of what follows them. Whose suffix lies where is read from the whole transform in the end, and common prefixes
    are those of neighbours in the strings, eight symbols at a time. An end of a string is less than every symbol
    and equal to no other end. The symbol 0 must not occur.
    """
    count = len(strings)
    sizes = np.fromiter(map(len, strings), np.int64, count)
    data = np.frombuffer(b"".join(x for string in strings for x in (string, bytes(ROUNDS))), np.uint8)
    ends = np.cumsum(sizes + ROUNDS) - ROUNDS
    total = int(sizes.sum())
    # written over each time: new memory for each array costs more than what is written to it
    held, room, moved = np.empty(total, np.int64), np.empty(total, np.int64), np.arange(count + total)
    marks = np.empty(total, bool)
    shorter = held[:0]  # of the suffixes after the ``count`` empty ones
    begins = np.zeros(257, np.int64)  # how many of them begin with a smaller symbol
    places = np.repeat(np.arange(count), ROUNDS).reshape(count, ROUNDS)  # of each string's last eight suffixes
    for done in range(0, int(sizes.max(initial=0)), ROUNDS):
        active = np.flatnonzero(sizes > done)
        place, found = places[active, done - 1 & ROUNDS - 1], []
        for size in range(done + 1, done + ROUNDS + 1):
            more = sizes[active] >= size
            active, place = active[more], place[more]
            place = count + _before(shorter, begins, data[ends[active] - size], place)
            found.append((active, np.full(len(active), size - done - 1), place - count))
        string, step, before = (np.concatenate(x) for x in zip(*found))
        start = ends[string] - step - done - 1
        order = np.lexsort((places[string, step], _eights(data, ">u8")[start].astype(np.uint64)))
        at = np.empty(len(order), np.int64)
        at[order] = before[order] + np.arange(len(order))
        was, now = len(shorter), len(shorter) + len(at)
        # where each suffix goes to: one on for each new one up to it
        moves = moved[count : count + was]
        moves.fill(1)
        np.add.at(moves, before[before < was], 1)
        moves[:1] += count - 1
        np.cumsum(moves, out=moves)
        np.take(moved, shorter, out=room[:was], mode="clip")
        tail = moved[places[string, step - 1]]
        places[string, step] = at + count
        later = step > 0
        tail[later] = places[string[later], step[later] - 1]
        old = marks[:now]
        old.fill(True)
        old[at] = False
        shorter = held[:now]
        shorter[old] = room[:was]
        shorter[at] = tail
        begins[1:] += np.cumsum(np.bincount(data[start], minlength=256))
    owner, length = _owners(shorter, count)
    return owner, length, _common(data, ends[owner] - length, length)


#: Rounds after which the transform is written anew, as many as there are symbols in a number.
ROUNDS = 8
#: Neighbours that are compared together.
_COMPARED = 1 << 15


def _eights(data: np.ndarray, kind: str) -> np.ndarray:
    """The eight symbols from each place on as a number."""
    return np.ndarray((len(data) - 7,), kind, data, strides=(1,)) if len(data) else np.zeros(0, kind)


def _before(shorter: np.ndarray, begins: np.ndarray, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
    """How many suffixes lie before ``symbol`` with the suffix at ``place`` after it."""
    order = np.argsort(symbol, kind="stable")
    groups = np.append(0, np.cumsum(np.bincount(symbol, minlength=256)))
    place, found = place[order], np.empty(len(order), np.int64)
    for first in np.flatnonzero(np.diff(groups)):
        some = slice(groups[first], groups[first + 1])
        low, high = begins[first], begins[first + 1]
        found[order[some]] = low + np.searchsorted(shorter[low:high], place[some])
    return found


def _owners(shorter: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``(string, length)`` of all suffixes: from each string's end to its longer and longer suffixes."""
    longer = np.full(count + len(shorter), -1)
    longer[shorter] = np.arange(count, count + len(shorter))
    owner, length = np.empty(len(longer), np.int32), np.empty(len(longer), np.uint16)
    string, place, size = np.arange(count), np.arange(count), 0
    while len(place):
        owner[place], length[place] = string, size
        on = longer[place]
        string, place, size = string[on >= 0], on[on >= 0], size + 1
    return owner, length


def _common(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """How many symbols each suffix shares with the one before; ``data`` goes on for eight symbols after the last one."""
    eights = _eights(data, "<u8")
    found = np.zeros(len(start), np.uint16)
    for low in range(1, len(start), _COMPARED):
        part = slice(low, low + _COMPARED)
        before, after = start[low - 1 : low - 1 + _COMPARED][: len(start[part])], start[part]
        most = np.minimum(length[part], length[low - 1 : low - 1 + _COMPARED][: len(after)]).astype(np.int64)
        shared, open_, size = np.zeros(len(after), np.int64), np.flatnonzero(most), 0
        while len(open_):
            differ = eights[before[open_] + size] ^ eights[after[open_] + size]
            # the lowest bit that differs lies in the first symbol that does
            same = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3
            shared[open_] = np.minimum(size + same, most[open_])
            size += 8
            open_ = open_[(differ == 0) & (most[open_] > size)]
        found[part] = shared
    return found


def _earlier_windows(window: int):
    """An index over a collection: the windows that another segment has earlier, by the order of all suffixes."""

    def index(found: Collection) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # no byte of a text in UTF-8 is 0xFF, so all may be shifted by one to leave 0 free
        owner, length, common = sorted_suffixes([content.translate(_UP) for content in found.contents])
        whole = length >= window
        group = np.cumsum(common < window)[whole]
        segment = owner[whole].astype(np.int64)
        offset = found.windows[segment] + window - 1 - length[whole]
        start = found.first[segment] + offset
        order = np.lexsort((start, found.document[segment], group))
        first = np.ones(len(order), bool)
        first[1:] = group[order][1:] != group[order][:-1]
        later = order[~first]
        return runs(segment[later], offset[later])

    return index


_UP = bytes([*range(1, 256), 255])


def runs(segment: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(segment, from, to)``: neighbouring windows of a segment as one run."""
    order = np.lexsort((offset, segment))
    segment, offset = segment[order], offset[order]
    heads = np.ones(len(segment), bool)
    heads[1:] = (segment[1:] != segment[:-1]) | (offset[1:] != offset[:-1] + 1)
    tails = np.append(heads[1:], True) if len(heads) else heads
    return segment[heads], offset[heads], offset[tails]


def covered(low: np.ndarray, high: np.ndarray, window: int, size: int) -> np.ndarray:
    """A mask over ``size`` units: those inside a window that starts from ``low`` to ``high``."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, low, 1)
    np.add.at(change, np.minimum(high + window, size), -1)
    return np.cumsum(change[:-1]) > 0


def _cut_bytes(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, spans = [], [], []
            for text, lists in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                low, high = (np.array([x[k] for x in lists], np.int64) for k in ("low", "high"))
                gone = covered(low, high, window, len(data))
                kept.append(data[~gone].tobytes())
                removed.append(int(gone.sum()))
                spans.append(int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(2)]
                + [pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=[*DOCUMENT, "n_removed", "n_spans", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """``(_id, _t1, n_removed, n_spans, kept)`` of the documents of ``docs`` that lose bytes; ``kept`` is what stays.

    A byte is removed when a string of ``window`` bytes covers it that also starts earlier: in a document with a smaller
    id (a null id is before all others), or in the same one. Strings do not cross documents and
    are judged on the input. What stays may not be valid UTF-8. A null text is empty. Of one id, rows are told
    apart by their texts; rows equal in both are one document. An empty table gives no rows. A long text is cut into
    segments for the index, and held whole by the tasks that measure and cut it.
    """
    found = repeated_windows(docs, Grain(window, gram, False), _earlier_windows(window), True, crowded)
    lists = found.spans.groupBy(*DOCUMENT).agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    texts = found.texts.join(lists.hint("merge"), DOCUMENT).select(*DOCUMENT, "text", "spans")
    schema = "_id bigint, _t1 bigint, n_removed bigint, n_spans bigint, kept binary"
    return texts.mapInArrow(_cut_bytes(window), schema)


def suffix_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for each row of ``docs``; see :func:`remove_repeats`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*document_key(), F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    removed = remove_repeats(docs, window, gram, crowded)
    removed = removed.select(*DOCUMENT, "n_removed", "n_spans", F.sha2("kept", 256).alias("sha")).dropDuplicates(DOCUMENT)
    zero = F.lit(0).cast("bigint")
    return rows.join(removed.hint("merge"), DOCUMENT, "left").select(
        id_back("_id").alias("doc_id"),
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("sha", "whole").alias("kept_sha256"),
    )


