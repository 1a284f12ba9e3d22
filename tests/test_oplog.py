import random

import sluice
from sluice.plans.skew import SkewLimits

OPS = "op_id bigint, ts bigint, key string, op string, value string, loc int"


def fixture_ops(table):
    return table(
        OPS,
        (1, 5, "k", "get", None, 1), (2, 10, "k", "put", "A", 1), (3, 20, "k", "get", None, 2),
        (4, 20, "k", "put", "B", 1), (5, 25, "k", "get", None, 3), (6, 1, None, "get", None, 1),
    )


def test_reads_see_the_last_put_before_them(table, result):
    assert result(sluice.kv_read_asof(fixture_ops(table)), "op_id", "value", "loc") == [
        (1, None, 1), (3, "A", 2), (5, "B", 3),
    ]


def test_latest(table, result):
    assert result(sluice.kv_latest(fixture_ops(table))) == [("k", "B")]


def test_hot_keys_change_nothing(table, result):
    random.seed(3)
    rows = [
        (i, random.randrange(80), random.choice("kkkkabc"), random.choice(["put", "get"]), random.choice(["x", "y", None]), 1)
        for i in range(300)
    ]
    ops = table(OPS, *rows)
    usual = result(sluice.kv_read_asof(ops))
    assert result(sluice.kv_read_asof(ops, limits=SkewLimits(max_hot=10, min_rows=5))) == usual
    state, expected = {}, []
    for op_id, ts, key, op, value, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        if op == "put":
            state[key] = value
        else:
            expected.append((op_id, key, ts, 1, state.get(key)))
    assert usual == sorted(expected, key=repr)
