"""Word passages that occur in earlier documents, by backward search in FM-indexes over wavelet matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._frames import id_back, spans_of
from sluice.llm.passages import CROWDED, DOCUMENT, Collection, Grain, document_key, repeated_windows
from sluice.llm.suffix_dedup import covered, runs

WINDOW = 13
GRAM = 5


class WaveletMatrix:
    """A sequence of small numbers as one row of bits for each binary place, with counts at every 64th bit."""

    def __init__(self, values: np.ndarray, bits: int):
        self._bits = bits
        self._rows: list[np.ndarray] = []
        self._sums: list[np.ndarray] = []
        self._zeros: list[int] = []
        for place in reversed(range(bits)):
            ones = ((values >> place) & 1).astype(bool)
            words = np.packbits(np.append(ones, np.zeros(64 + -len(ones) % 64, bool)), bitorder="little").view(np.uint64)
            self._rows.append(words)
            self._sums.append(np.append(0, np.cumsum(np.bitwise_count(words), dtype=np.int64))[:-1])
            self._zeros.append(int(len(ones) - ones.sum()))
            values = np.concatenate([values[~ones], values[ones]])
        # where each number's block begins in the last order
        self._starts = np.searchsorted(_reversed_bits(values, bits), _reversed_bits(np.arange(1 << bits), bits))

    def rank(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` numbers are ``value``."""
        start = self._starts[value]
        for row, (words, sums, zeros) in enumerate(zip(self._rows, self._sums, self._zeros, strict=True)):
            one = (value >> (self._bits - 1 - row)) & 1
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = sums[at >> 6] + np.bitwise_count(words[at >> 6] & mask)
            at = np.where(one == 1, zeros + ones, at - ones)
        return at - start


def _reversed_bits(values: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros_like(values)
    for place in range(bits):
        out |= ((values >> place) & 1) << (bits - 1 - place)
    return out


def suffix_array(values: np.ndarray, most: int) -> np.ndarray:
    """Suffixes of ``values`` in the order of their first ``most`` numbers, by doubling."""
    rank = np.unique(values, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    span = 1
    while span < most:
        later = np.zeros(len(rank), np.int64)
        later[: len(rank) - span] = rank[span:] + 1
        both = rank * (len(rank) + 2) + later
        order = np.argsort(both, kind="stable")
        ordered = both[order]
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(np.append(0, ordered[1:] != ordered[:-1]))
        if rank[order[-1]] == len(rank) - 1:
            break
        span *= 2
    return order


class FmIndex:
    """Backward search for runs of numbers from 1 on; 0 ends each string and begins the whole."""

    def __init__(self, values: np.ndarray, longest: int):
        # suffixes need no finer order than the longest pattern; equal ones are told apart by what goes before,
        # so each pattern's matches are one interval
        self.order = suffix_array(values, len(values))
        before = values[self.order - 1]
        bits = max(1, int(values.max(initial=1)).bit_length())
        self._matrix = WaveletMatrix(before, bits)
        self._first = np.append(0, np.cumsum(np.bincount(values, minlength=1 << bits)))
        self.longest = longest

    def intervals(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ``symbols``: the suffixes that begin with it, from the first to behind the last."""
        low = np.zeros(len(symbols), np.int64)
        high = np.full(len(symbols), len(self.order), np.int64)
        for step in reversed(range(symbols.shape[1])):
            symbol = symbols[:, step]
            low = self._first[symbol] + self._matrix.rank(symbol, low)
            high = self._first[symbol] + self._matrix.rank(symbol, high)
        return low, high


def _coded(contents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 1 on for the words of all contents, and the number of words of each."""
    split = pc.ascii_split_whitespace(pa.array(contents, pa.binary()).cast(pa.string()))
    words = split.flatten().dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    return words, np.diff(split.offsets.to_numpy())


def _earlier_windows(window: int):
    """An index over a collection: the windows that a segment of a smaller id has, found by backward search."""

    def index(found: Collection) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words, sizes = _coded(found.contents)
        # one 0 in front, and one after each string
        place = np.arange(len(words)) + np.repeat(np.arange(len(sizes)), sizes) + 1
        values = np.zeros(len(words) + len(sizes) + 1, np.int64)
        values[place] = words
        fm = FmIndex(values, window)
        segment = np.repeat(np.arange(len(sizes)), found.windows)
        offset = spans_of(found.windows)
        begin = (np.cumsum(sizes) - sizes)[segment] + offset
        low, high = fm.intervals(words[begin[:, None] + np.arange(window)])
        owner = np.zeros(len(values), np.int64)
        owner[place] = np.repeat(found.ids, sizes)
        # intervals of windows are equal or apart
        heads, which = np.unique(low, return_inverse=True)
        tails = np.empty(len(heads), np.int64)
        tails[which] = high
        bounds = np.empty(2 * len(heads), np.int64)
        bounds[0::2], bounds[1::2] = heads, tails
        least = np.minimum.reduceat(np.append(owner[fm.order], 0), bounds)[0::2][which]
        later = least < found.ids[segment]
        return runs(segment[later], offset[later])

    return index


def _cut_words(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed = [], []
            for text, lists in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words = text.encode().split()
                low, high = (np.array([x[k] for x in lists], np.int64) for k in ("low", "high"))
                gone = covered(low, high, window, len(words))
                kept.append(b" ".join([word for word, out in zip(words, gone.tolist(), strict=True) if not out]).decode())
                removed.append(int(gone.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(2)] + [pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=[*DOCUMENT, "n_removed", "kept"],
            )

    return run


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [text.encode().split() for text in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(k) for k in range(2)]
            + [pa.array([len(x) for x in words], pa.int64()), pa.array([b" ".join(x).decode() for x in words])],
            names=[*DOCUMENT, "n_words", "whole"],
        )


def remove_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """``(_id, _t1, n_removed, kept)`` of the documents of ``docs`` that lose words; ``kept`` joins the others by a space.

    A word is removed when a run of ``window`` words covers it that also starts in a document with a smaller id (a
    null id is before all others). Runs do not cross documents and are judged on the input. A null text has no
    words. Rows of one id do not count against each other. An empty table gives no rows. A long text is cut into
    segments for the index, and held whole by the tasks that measure and cut it.
    """
    found = repeated_windows(docs, Grain(window, gram, True), _earlier_windows(window), False, crowded)
    lists = found.spans.groupBy(*DOCUMENT).agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    texts = found.texts.join(lists.hint("merge"), DOCUMENT).select(*DOCUMENT, "text", "spans")
    return texts.mapInArrow(_cut_words(window), "_id bigint, _t1 bigint, n_removed bigint, kept string")


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` for each row of ``docs``; see :func:`remove_passages`."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*document_key(), text.alias("text")).mapInArrow(
        _count_words, "_id bigint, _t1 bigint, n_words bigint, whole string"
    )
    rows = rows.select(*DOCUMENT, "n_words", F.sha2("whole", 256).alias("whole"))
    removed = remove_passages(docs, window, gram, crowded)
    removed = removed.select(*DOCUMENT, "n_removed", F.sha2("kept", 256).alias("sha")).dropDuplicates(DOCUMENT)
    return rows.join(removed.hint("merge"), DOCUMENT, "left").select(
        id_back("_id").alias("doc_id"),
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("sha", "whole").alias("kept_sha256"),
    )
