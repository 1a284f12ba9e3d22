"""Bounded-space packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._frames import column, text_buffer, text_slices, written

WINDOW = 2048
OPEN_WINDOWS = 64
MIN_CUT = 64
END_ID = 1
#: Leftover windows that one task of the last merge takes.
MERGE_WINDOWS = 4096
#: Bytes that a task keeps of words and their ids, and what each such word takes besides.
CACHED_BYTES = 48 << 20
_ENTRY_BYTES = 160

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)
_SCHEMA = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.binary())]
)

# classes of characters in the vocabulary's split pattern
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
# fixed values: what the split pattern takes together after an apostrophe
_SHORT_ENDS = ("s", "t", "m", "d")
_LONG_ENDS = ("re", "ve", "ll")


def _character_classes() -> np.ndarray:
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    classes = np.zeros(0x110000, np.uint8)
    for pattern, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (r"\s+", _SPACE)):
        found = "".join(regex.findall(pattern, every))
        classes[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return classes


def _byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: itself if printable, else the next free one."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(byte): byte for byte in plain}
    for place, byte in enumerate(sorted(set(range(256)) - set(plain))):
        letters[chr(256 + place)] = byte
    return letters


def _ranks(path: str) -> dict[bytes, int]:
    """The vocabulary's tokens as bytes. Its merges must make the tokens in the order of their ids."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    made = [model["vocab"]["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]]
    if made != sorted(made):
        raise ValueError(f"{path}: merges and ids differ in order")
    letters = _byte_letters()
    return {
        bytes(letters[letter] for letter in token): number
        for token, number in model["vocab"].items()
        if all(letter in letters for letter in token) and not (token.startswith("<|") and token.endswith("|>"))
    }


def _added_tokens(path: str) -> dict[bytes, int]:
    """The ids of the vocabulary's added tokens by content. Only tokens that are met anywhere as they stand are known."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    for token in added:
        if any(token.get(name) for name in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: added token {token['content']!r} isn't met as it stands")
    return {token["content"].encode(): token["id"] for token in added if token["content"]}


class Encoder:
    """Token ids of many texts: the words of all texts are told apart at once, and each distinct word is encoded once.

    The vocabulary's split pattern cuts a text into words that are encoded by themselves, so the ids
    are those of the whole text. With ``added`` the vocabulary's added tokens are met first, wherever they stand in
    a text, and what lies between them is encoded like texts of their own; without, they are spelled out.
    """

    def __init__(self, path: str, cached_bytes: int = CACHED_BYTES, added: bool = False):
        import tiktoken

        self._encode = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=_ranks(path), special_tokens={})
        self._added = _added_tokens(path) if added else {}
        # where several begin at one place the longest is met
        contents = sorted(self._added, key=len, reverse=True)
        self._markers = re.compile(b"|".join(map(re.escape, contents))) if contents else None
        self._classes = _character_classes()
        self._cached_bytes = cached_bytes
        self._known: dict[bytes, bytes] = {}
        self._known_bytes = 0

    def _starts(self, points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
        """Where words begin, as a mask over the characters of all texts."""
        kinds = self._classes[points]
        first = np.zeros(len(points), bool)
        first[text_starts] = True
        begins = first.copy()
        begins[1:] |= kinds[1:] != kinds[:-1]
        space = kinds == _SPACE
        last = np.ones(len(points), bool)  # of its run, with more of the same text after it
        last[:-1] = begins[1:]
        ends_text = np.ones(len(points), bool)
        ends_text[:-1] = first[1:]
        before_word = space & last & ~ends_text
        # the last space of a run goes with the word after it, any other last blank is a word
        begins[before_word] = True
        joined = np.flatnonzero(before_word & (points == 0x20)) + 1
        begins[joined] = False
        quotes = np.flatnonzero((points == 0x27) & begins & last & ~ends_text)
        if len(quotes):
            self._apostrophes(points, kinds, begins, ends_text, quotes)
        return begins

    @staticmethod
    def _apostrophes(points, kinds, begins, ends_text, quotes) -> None:
        padded = np.append(points, [0, 0])
        one, two = padded[quotes + 1], padded[quotes + 2]
        two = np.where(ends_text[np.minimum(quotes + 1, len(points) - 1)], 0, two)
        short = np.isin(one, [ord(x) for x in _SHORT_ENDS])
        long = np.zeros(len(quotes), bool)
        for a, b in _LONG_ENDS:
            long |= (one == ord(a)) & (two == ord(b))
        for at, size in ((quotes[short], 1), (quotes[long & ~short], 2)):
            begins[at + 1] = False
            after = at + size + 1
            inside = after < len(points)
            inside[inside] &= ~ends_text[after[inside] - 1]
            begins[after[inside]] = True

    def _marked(self, offsets: np.ndarray, raw: bytes) -> np.ndarray:
        """``(start, end)`` of each added token inside a text, in bytes."""
        if not self._markers or not self._markers.search(raw):
            return np.zeros((0, 2), np.int64)
        bounds = offsets.tolist()
        found = [m.span() for a, b in zip(bounds, bounds[1:]) for m in self._markers.finditer(raw, a, b)]
        return np.array(found, np.int64).reshape(-1, 2)

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(counts, ids)``: the number of ids of each text, and all ids one after another."""
        texts = len(offsets) - 1
        if not len(data):
            return np.zeros(texts, np.int64), np.zeros(0, np.uint32)
        raw = data.tobytes()
        at = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        marked = self._marked(offsets, raw)
        cuts = np.concatenate([offsets[:-1][np.diff(offsets) > 0], marked[:, 0], marked[marked[:, 1] < len(data), 1]])
        begins = self._starts(points, np.searchsorted(at, cuts))
        for first, last in np.searchsorted(at, marked).tolist():
            begins[first + 1 : last] = False  # an added token is one word
        starts = at[begins]
        bounds = np.append(starts, len(data)).astype(np.int32)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
        coded = words.dictionary_encode()
        sizes, ids = self._ids(coded.dictionary.to_pylist())
        which = coded.indices.to_numpy()
        word_sizes = sizes[which]
        ends = np.zeros(len(which) + 1, np.int64)
        np.cumsum(word_sizes, out=ends[1:])
        # from each id's place among all to its place among the ids of the distinct words
        shift = (np.cumsum(sizes) - sizes)[which] - ends[:-1]
        word_ids = ids[np.arange(ends[-1]) + np.repeat(shift, word_sizes)]
        return np.diff(ends[np.searchsorted(starts, offsets)]), word_ids

    def _ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        known = self._known
        encode, added = self._encode._core_bpe.encode_single_piece, self._added
        found = []
        for word in words:
            ids = known.get(word)
            if ids is None:
                # words between added tokens never hold one
                ids = array("I", [added[word]] if word in added else encode(word)).tobytes()
                size = _ENTRY_BYTES + len(word) + len(ids)
                if self._known_bytes + size > self._cached_bytes:
                    known.clear()
                    self._known_bytes = 0
                if size <= self._cached_bytes:
                    known[word] = ids
                    self._known_bytes += size
            found.append(ids)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return sizes, np.frombuffer(b"".join(found), "<u4")


class _Windows:
    """A fixed number of open windows; the one that fits best takes a piece, the fullest goes when none fits."""

    def __init__(self, size: int, most: int, min_cut: int):
        self._size, self._most, self._min_cut = size, most, min_cut
        self._gaps: list[tuple[int, int]] = []  # (room, number), in order
        self._pieces: dict[int, list[tuple]] = {}
        self._next = 0

    def _new(self) -> int:
        self._next += 1
        return self._next - 1

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple[int, list[tuple]]]:
        """Place a document; the windows that are closed by it come back as ``(number, pieces)``."""
        total, start = len(ids), 0
        while total - start >= self._size:
            yield self._new(), [(doc, start, ids[start : start + self._size], total)]
            start += self._size
        while start < total:
            fit = bisect_left(self._gaps, (total - start, -1))
            if fit < len(self._gaps):
                room, number = self._gaps.pop(fit)
            elif len(self._gaps) < self._most:
                room, number = self._size, self._new()
                self._pieces[number] = []
            else:
                room, number = self._gaps.pop(0)
                if room < self._min_cut:
                    yield number, self._pieces.pop(number)
                    continue
            take = min(room, total - start)
            self._pieces[number].append((doc, start, ids[start : start + take], total))
            start += take
            if take == room:
                yield number, self._pieces.pop(number)
            else:
                insort(self._gaps, (room - take, number))

    def rest(self) -> Iterator[tuple[int, list[tuple]]]:
        for _, number in self._gaps:
            yield number, self._pieces[number]


def _table(windows: list[tuple[int, list[tuple]]], keep_ids: bool) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in _SCHEMA]
    for sequence, pieces in windows:
        offset = 0
        for doc, start, ids, total in pieces:
            raw = ids.astype("<u4").tobytes()
            values = (doc, start, len(ids), zlib.crc32(raw), total, sequence, offset, raw if keep_ids else None)
            for values_of, value in zip(columns, values, strict=True):
                values_of.append(value)
            offset += len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA
    )


def _pack_partition(path: str, window: int, open_windows: int, min_cut: int, added_tokens: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        encoder, open_ = None, _Windows(window, open_windows, min_cut)
        for batch in text_slices(batches, 1):
            encoder = encoder or Encoder(path, added=added_tokens)
            counts, ids = encoder.encode(*text_buffer(batch.column(1)))
            ends = np.cumsum(counts)
            closed = []
            for doc, begin, end in zip(batch.column(0).to_pylist(), ends - counts, ends, strict=True):
                closed += open_.add(doc, np.append(ids[begin:end], np.uint32(END_ID)))
            yield _table([(base | number << 1, pieces) for number, pieces in closed], False)
        yield _table([(base | number << 1, pieces) for number, pieces in open_.rest()], True)

    return run


def _merge_partition(window: int):
    """Leftover windows joined end to end and cut anew; the last one of the task may stay short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        number, room, pieces = 0, window, []
        for batch in batches:
            done = []
            docs, starts, totals = batch.column(0).to_pylist(), column(batch, 1), column(batch, 4)
            for doc, start, total, raw in zip(docs, starts, totals, batch.column(7).to_pylist(), strict=True):
                ids = np.frombuffer(raw, "<u4")
                at = 0
                while at < len(ids):
                    take = min(room, len(ids) - at)
                    pieces.append((doc, int(start) + at, ids[at : at + take], int(total)))
                    at, room = at + take, room - take
                    if not room:
                        done.append((base | number << 1 | 1, pieces))
                        number, room, pieces = number + 1, window, []
            yield _table(done, False)
        if pieces:
            yield _table([(base | number << 1 | 1, pieces)], False)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    min_cut: int = MIN_CUT,
    added_tokens: bool = False,
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, one row per piece of a document.

    Each row of ``docs`` (``doc_id``, ``text``; other columns are not read) is encoded and closed with
    id 1. With ``added_tokens`` the vocabulary's added tokens inside a text get their own ids, as the ``tokenizers``
    library does unless told otherwise; without, they are spelled out like any text. Each partition keeps at most ``open_windows`` windows open; a piece goes where it fits best.
    When none fits, the fullest window goes: with less than ``min_cut`` ids of room it is
    padded, otherwise the piece's head fills it. Windows still open at the end of a
    partition are written with their ids and joined end to end by a second, small job.

    A null or empty text is the closing id alone. Repeated rows and rows without an id are packed
    like any other. An empty table gives no rows. A row is encoded whole, so a task needs
    memory for its longest text.
    """
    packed = written(
        docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
            _pack_partition(tokenizer, window, open_windows, min_cut, added_tokens), PIECES
        )
    )
    left = packed.where("ids is not null")
    tasks = -(-left.select("sequence_id").distinct().count() // MERGE_WINDOWS)
    merged = (
        left.repartition(max(1, tasks), "sequence_id")
        .sortWithinPartitions("sequence_id", "offset")
        .mapInArrow(_merge_partition(window), PIECES)
    )
    return packed.where("ids is null").unionByName(merged).drop("ids")
