"""Product codes for vectors: each part of a vector as the number of the nearest entry of a learnt codebook.

Vectors become integers first, so that sums and squared distances are exact whatever the order of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm._frames import discard, id_back, id_of, written, written_at

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Numbers of a batch that a task looks at together.
SLICE_VALUES = 1 << 20
#: Components beyond this count as this, either way.
MOST_COMPONENT = 1 << 62
LONG = (1 << 63) - 1

_STATE = (
    "id bigint, label string, vector array<double>, codes binary, distances array<bigint>, error bigint, "
    "part int, entry int, count bigint, sums array<decimal(38,0)>"
)
_TYPES = pa.schema(
    [("id", pa.int64()), ("label", pa.string()), ("vector", pa.list_(pa.float64())), ("codes", pa.binary())]
    + [("distances", pa.list_(pa.int64())), ("error", pa.int64()), ("part", pa.int32()), ("entry", pa.int32())]
    + [("count", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0)))]
)


@dataclass(frozen=True)
class Codebooks:
    """``entries[part][entry]`` is a list of integers; ``compared`` has the distances computed in each assignment."""

    entries: list[list[list[int]]]
    compared: list[int] = field(default_factory=list)


def part_bounds(size: int, parts: int) -> list[int]:
    """Where parts begin and end; of a size that parts do not divide the first ones get one more."""
    each, more = divmod(size, parts)
    return [k * each + min(k, more) for k in range(parts + 1)]


def _integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as float64, which holds it exactly for a power of two."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * scale), -MOST_COMPONENT, MOST_COMPONENT)


def _exact_bound(size: int) -> int:
    """Components up to this give squared distances of ``size`` components that float64 holds exactly."""
    return math.isqrt((1 << 51) // max(size, 1))


def _distances(values: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return (values * values).sum(1)[:, None] - 2 * (values @ entries.T) + (entries * entries).sum(1)[None, :]


class _Part:
    """One position's codebook, and which entries moved in the last round (None: all are new)."""

    def __init__(self, entries: list[list[int]], moved: list[int] | None):
        # numpy has no 128-bit integers: Python's own where float64 would round
        self.exact = max((abs(x) for entry in entries for x in entry), default=0) <= _exact_bound(len(entries[0]))
        shape = len(entries), len(entries[0])
        self.whole = np.array(entries, object).reshape(shape)
        self.floats = np.array(entries, np.float64).reshape(shape)
        self.moved = moved

    def assign(self, values: np.ndarray, codes: np.ndarray, stored: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """``(codes, distances, compared)``: nearest entries, the lower number among equals.

        A row whose entry stayed where it was keeps its stored distance and looks at moved entries only: the others
        were no nearer before and did not move. Other rows, and those without a stored distance, look at all.
        """
        entries = self.whole if values.dtype == object else self.floats
        if self.moved is None:
            again = np.ones(len(values), bool)
        else:
            again = np.isin(codes, self.moved) | (stored < 0)
        out, best = codes.copy(), stored.astype(values.dtype)
        compared = int(again.sum()) * len(entries)
        if again.any():
            far = _distances(values[again], entries)
            out[again] = far.argmin(1)
            best[again] = far.min(1)
        if self.moved and not again.all():
            compared += int((~again).sum()) * len(self.moved)
            far = _distances(values[~again], entries[self.moved])
            nearest = far.argmin(1)
            entry, distance = np.array(self.moved)[nearest], far[np.arange(len(far)), nearest]
            closer = (distance < best[~again]) | ((distance == best[~again]) & (entry < out[~again]))
            rows = np.flatnonzero(~again)[closer]
            out[rows], best[rows] = entry[closer], distance[closer]
        return out, best, compared


def _assign_rows(books: list[list[list[int]]], moved: list[list[int] | None], bounds: list[int], scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_Part(entries, which) for entries, which in zip(books, moved, strict=True)]
        size, entries = bounds[-1], len(books[0])
        counts = np.zeros((len(parts), entries), np.int64)
        sums = [np.zeros((entries, b - a), object) for a, b in zip(bounds, bounds[1:])]
        compared = 0
        step = max(1, SLICE_VALUES // max(size, 1))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                n = batch.num_rows
                numbers = _integers(batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, size), scale)
                old = batch.column(3)
                if old.null_count:
                    codes, stored = np.zeros((n, len(parts)), np.uint8), np.full((n, len(parts)), -1, np.int64)
                else:
                    codes = np.frombuffer(b"".join(old.to_pylist()), np.uint8).reshape(n, -1)
                    stored = batch.column(4).flatten().to_numpy().reshape(n, -1)
                codes, stored = codes.copy(), stored.copy()
                error = np.zeros(n, object)
                for p, part in enumerate(parts):
                    values = numbers[:, bounds[p] : bounds[p + 1]]
                    large = np.abs(values).max(1, initial=0) > _exact_bound(values.shape[1])
                    if not part.exact:
                        large[:] = True
                    for rows in (np.flatnonzero(~large), np.flatnonzero(large)):
                        if not len(rows):
                            continue
                        own = values[rows]
                        if large[rows[0]]:
                            own = np.array([[int(x) for x in row] for row in own.tolist()], object).reshape(own.shape)
                        code, distance, n_compared = part.assign(own, codes[rows, p].astype(np.int64), stored[rows, p])
                        codes[rows, p] = code
                        # a distance that a long can't hold isn't kept: its row looks at all entries next time
                        stored[rows, p] = [int(d) if d <= LONG else -1 for d in distance] if large[rows[0]] else distance
                        error[rows] += distance.astype(object) if large[rows[0]] else distance.astype(np.int64).astype(object)
                        compared += n_compared
                        counts[p] += np.bincount(code, minlength=entries)
                        chosen = np.zeros((entries, len(rows)))
                        chosen[code, np.arange(len(rows))] = 1
                        if large[rows[0]]:
                            np.add.at(sums[p], code, own)
                        else:
                            sums[p] += (chosen @ own).astype(np.int64).astype(object)
                none = pa.nulls(n, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        batch.column(2),
                        pa.array([row.tobytes() for row in codes], pa.binary()),
                        pa.array(list(stored), pa.list_(pa.int64())),
                        pa.array([min(int(e), LONG) for e in error], pa.int64()),
                        none,
                        none,
                        pa.nulls(n, pa.int64()),
                        pa.nulls(n, pa.list_(pa.decimal128(38, 0))),
                    ],
                    schema=_TYPES,
                )
        found = [(p, e) for p in range(len(parts)) for e in range(entries) if counts[p, e]]
        totals = [(-1, 0, compared, []), *[(p, e, int(counts[p, e]), [int(x) for x in sums[p][e]]) for p, e in found]]
        blank = [pa.nulls(len(totals), kind) for kind in _TYPES.types[:6]]
        filled = [pa.array(values, kind) for values, kind in zip(zip(*totals), _TYPES.types[6:], strict=True)]
        yield pa.RecordBatch.from_arrays([*blank, *filled], schema=_TYPES)

    return run


def _sums(state: DataFrame) -> tuple[dict, dict, int]:
    """Counts and sums by part and entry, and the distances computed, from the rows that tasks added."""
    added = state.where("part is not null").select("part", "entry", "count", "sums")
    counts = added.groupBy("part", "entry").agg(F.sum("count").alias("count")).collect()
    sums = (
        added.select("part", "entry", F.posexplode("sums").alias("place", "value"))
        .groupBy("part", "entry", "place")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    by_count = {(r["part"], r["entry"]): r["count"] for r in counts}
    compared = by_count.pop((-1, 0), 0)
    return by_count, {(r["part"], r["entry"], r["place"]): int(r["value"]) for r in sums}, compared


def _moved_on(books: list[list[list[int]]], counts: dict, sums: dict) -> list[list[list[int]]]:
    return [
        [
            [sums[p, e, k] // counts[p, e] for k in range(len(entry))] if counts.get((p, e)) else entry
            for e, entry in enumerate(entries)
        ]
        for p, entries in enumerate(books)
    ]


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """``(vec_id, label, codes, error)`` of each vector, and the codebooks; ``codes`` has one byte for each part.

    Codebooks start as the parts of the vectors with the smallest ids. In each round every part goes to its nearest
    entry and each entry that has parts becomes their mean, rounded down; a last assignment follows. What a
    part is assigned to and its exact distance are kept in a table between rounds: where the entry did not move only moved
    entries are compared, elsewhere all (see ``Codebooks.compared``). Tasks add up their parts themselves, so
    one row for each task and entry is gathered, and only codebooks pass through the driver: parts * entries entries.

    Vectors that are null or hold a null or a non-finite component give no row, nor do those of another length than
    the first kept one's. A null id counts as the smallest; rows with one id are all coded, and start codebooks in the order of
    their components. With fewer vectors than ``entries`` there are as many entries as vectors. Where
    ``parts`` do not divide the length the first parts are longer by one; a vector without components has
    distance 0 to the first entry. Integer components beyond 2**62 count as that, an error beyond the range of bigint as its
    end. An empty table gives no rows and empty codebooks. Other columns may have any names.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    spark = vectors.sparkSession
    vector = F.col(embedding).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(vector.isNotNull() & F.coalesce(finite, F.lit(False))).select(
        id_of(vec_id).alias("id"), F.col(label).cast("string").alias("label"), vector.alias("vector")
    )
    first = kept.orderBy("id", "vector").select(F.size("vector").alias("size")).first()
    if first is None:
        none = kept.select(id_back("id").alias("vec_id"), "label", F.lit(b"").alias("codes"), F.lit(0).cast("bigint").alias("error"))
        return none.limit(0), Codebooks([])
    kept = kept.where(F.size("vector") == first["size"])
    bounds = part_bounds(first["size"], parts)
    start = [
        [int(x) for x in _integers(np.array(row["vector"], np.float64), scale)]
        for row in kept.orderBy("id", "vector").limit(entries).collect()
    ]
    books = [[row[a:b] for row in start] for a, b in zip(bounds, bounds[1:])]
    moved: list[list[int] | None] = [None] * parts
    state, path, compared = kept.select("*", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("array<bigint>").alias("distances")), None, []
    for round_ in range(rounds + 1):
        rows = state.select("id", "label", "vector", "codes", "distances")
        table, new_path = written_at(rows.mapInArrow(_assign_rows(books, moved, bounds, scale), _STATE))
        if path:
            discard(spark, path)
        counts, sums, n_compared = _sums(table)
        compared.append(n_compared)
        state, path = table.where("part is null"), new_path
        if round_ < rounds:
            new = _moved_on(books, counts, sums)
            moved = [[e for e, (a, b) in enumerate(zip(old, now)) if a != b] for old, now in zip(books, new)]
            books = new
    coded = state.select(id_back("id").alias("vec_id"), "label", "codes", "error")
    return coded, Codebooks(books, compared)


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the errors of all rows with its label together, nulls being one label."""
    most = F.lit(LONG).cast("decimal(38,0)")
    totals = coded.groupBy(F.col("label").alias("_label")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("bigint").alias("label_error")
    )
    # a merge join: a frequent label's partition is split at run time
    return coded.join(totals.hint("merge"), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
