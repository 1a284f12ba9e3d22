import math
import random

import pytest

from sluice.llm.vector_codes import Codebooks, _Part, compress, label_errors

SCHEMA = "vec_id bigint, embedding array<float>, label int, id bigint, part int, codes string"


def plain(rows, parts=8, entries=16, rounds=6):
    """The codes by comparing everything in every round."""
    kept = [
        (v, [math.floor(4096 * x) for x in e], label)
        for v, e, label in rows
        if e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    size = len(kept[0][1])
    each, more = divmod(size, parts)
    cuts = [k * each + min(k, more) for k in range(parts + 1)]
    books = [[r[1][a:b] for r in kept[:entries]] for a, b in zip(cuts, cuts[1:])]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry)), e) for e, entry in enumerate(books[p]))

    for round_ in range(rounds + 1):
        found = [[nearest(p, r[1][cuts[p] : cuts[p + 1]]) for p in range(parts)] for r in kept]
        if round_ == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [r[1][cuts[p] : cuts[p + 1]] for r, f in zip(kept, found) if f[p][1] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    most = 2**63 - 1
    out = [(r[0], bytes(e for _, e in f), min(sum(d for d, _ in f), most), r[2]) for r, f in zip(kept, found)]
    totals = {}
    for _, _, error, label in out:
        totals[label] = min(totals.get(label, 0) + error, most)
    return sorted(((v, c, e, totals[label]) for v, c, e, label in out), key=repr), books


def coded(df):
    return sorted(((r["vec_id"], bytes(r["codes"]), r["error"], r["label_error"]) for r in label_errors(df).collect()), key=repr)


def vectors(table, rows):
    return table(SCHEMA, *[(v, e, label, 3, 4, "x") for v, e, label in rows]).repartition(3)


def some(seed, n, size, spread=0.3):
    random.seed(seed)
    centres = [[random.gauss(0, spread) for _ in range(size)] for _ in range(5)]
    return [
        (k * 7 % 997, [x + random.gauss(0, 0.02) for x in random.choice(centres)], random.choice([1, 2, None])) for k in range(n)
    ]


def as_floats(rows):
    import numpy as np

    return [(v, None if e is None else [None if x is None else float(np.float32(x)) for x in e], label) for v, e, label in rows]


@pytest.mark.parametrize("seed,size", [(1, 16), (2, 24), (3, 19), (4, 3)])
def test_codes(table, seed, size):
    rows = as_floats(some(seed, 90, size))
    df, books = compress(vectors(table, rows))
    expected, entries = plain(rows)
    assert coded(df) == expected
    assert books.entries == entries


def test_rows_that_stay_compare_moved_entries_only(table):
    # three tight groups far apart settle after a round or two: then nothing moves and nothing is compared
    rows = as_floats([(k, [k % 3 + (k // 3 % 2) / 64] * 8, 0) for k in range(60)])
    df, books = compress(vectors(table, rows), entries=3)
    assert coded(df) == plain(rows, entries=3)[0]
    assert books.compared[0] == 60 * 8 * 3
    assert books.compared[-1] == 0


def test_ties_go_to_the_lower_entry():
    import numpy as np

    part = _Part([[0, 0], [2, 0], [-2, 0]], [0, 2])
    values = np.array([[1, 0], [0, 0], [3, 0]], float)
    # the first row's stored entry 1 is as near as entry 0, which moved here; the last one's stays
    codes, far, compared = part.assign(values, np.array([1, 1, 1]), np.array([1, 4, 1]))
    assert codes.tolist() == [0, 0, 1] and far.tolist() == [1, 0, 1] and compared == 6


def test_awkward_vectors(table):
    nan, inf = float("nan"), float("inf")
    rows = as_floats(
        [
            (5, None, 1),
            (6, [nan] + [0.0] * 7, 1),
            (7, [inf] + [0.0] * 7, None),
            (8, [None] + [0.0] * 7, None),
            (None, [0.5] * 8, None),
            (1, [0.25] * 8, None),
            (1, [0.125] * 8, 2),
            (1, [0.125] * 8, 2),
            (-3, [-1e-9] * 8, 2),
            (9, [9e4, -9e4, 1e30, -3e38, 0, 1, 2, 3], 4),
            (10, [9e4, -9e4, 1e30, -3e38, 0, 1, 2, 4], 4),
        ]
    )
    df, books = compress(vectors(table, rows), entries=4)
    clipped = [(v, e and [max(min(x, 2.0**50), -(2.0**50)) if x is not None and math.isfinite(x) else x for x in e], l) for v, e, l in rows]
    expected, entries = plain(clipped, entries=4)
    assert coded(df) == expected
    assert books.entries == entries
    # vectors of another length than the first one's, and vectors without components
    mixed = rows[4:9] + [(20, [1.0, 2.0], 1), (21, [], 1)]
    assert coded(compress(vectors(table, mixed))[0]) == plain(rows[4:9])[0]
    empty = [(1, [], None), (2, [], None)]
    assert coded(compress(vectors(table, empty))[0]) == plain(empty)[0]


def test_no_vectors(table):
    df, books = compress(vectors(table, [(1, None, 2)]))
    assert coded(df) == [] and books == Codebooks([])
    assert label_errors(df).columns == ["vec_id", "label", "codes", "error", "label_error"]


def test_query_without_rows(spark, table, tmp_path):
    from sluice.llm.queries import op11_vector_codes

    vectors(table, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op11_vector_codes(spark, str(tmp_path)).collect() == []
