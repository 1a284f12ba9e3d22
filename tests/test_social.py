import json

import sluice


def users_of(table):
    return table("userid bigint, password string, name string", (1, "p", "Ann"), (2, "q", "Bob"), (3, "r", "Bob"))


def test_login(table, result):
    asked = table("userid bigint, password string", (1, "p"), (1, "x"), (9, "p"), (None, "p"), (1, None), (1, "p"))
    assert result(sluice.login(asked, users_of(table))) == sorted(
        [
            (1, "p", "Ann", None),
            (1, "x", "Unauthorized", None),
            (9, "p", "Unauthorized", None),
            (None, "p", None, "bad request"),
            (1, None, None, "bad request"),
        ],
        key=repr,
    )


def test_friend_list(table):
    cells = table("userid bigint, cell string", (1, "2,10"), (1, "10,3"), (2, ",,"), (3, "7,,"))
    found = [tuple(r) for r in sluice.friend_list(cells).collect()]
    assert found == [(1, "10"), (1, "2"), (1, "3"), (3, "7")]
    asked = table("userid bigint", (3,), (None,), (8,), (3,))
    assert [tuple(r) for r in sluice.friend_list(cells, asked).collect()] == [(3, "7")]


def test_photo_lookup(table, result):
    photos = table("userid bigint, time string, url string", (1, "t1", "u"), (1, "t2", "v"))
    asked = table("userid bigint", (1,), (5,), (None,))
    assert result(sluice.photo_lookup(asked, photos)) == sorted(
        [(1, "t2", "v", None), (5, "", "", None), (None, None, None, "bad request")], key=repr
    )


def timeline_input(table):
    return (
        table("userid bigint, password string", (1, "p"), (2, "wrong"), (None, "p")),
        users_of(table),
        table("userid bigint, cell string", (1, "2,3"), (1, "3,4"), (2, "1"), (1, "x")),
        table("userid bigint, time string, url string", (2, "t1", "a"), (3, "t1", "b")),
    )


def test_timeline(table):
    found = [tuple(r) for r in sluice.timeline(*timeline_input(table)).collect()]
    assert found == [(1, "", "Unauthorized", ""), (1, "t1", "Bob", "a")]


def test_photo_export(table):
    rows = table(
        "userid string, time string, url string", ("5", "t", "u"), ("1\tq", "t", "u"), ("1", "t", ""), ("5", "t", "u")
    )
    line = 'url\x03{"s":"u"}\x02userid\x03{"n":"5"}\x02time\x03{"s":"t"}'
    for size in (1, 100):
        assert [tuple(r) for r in sluice.photo_export(rows, copies_per_chunk=size).collect()] == [("5", line)] * 2


def parsed(df, *keys):
    return {tuple(r[k] for k in keys): json.loads(r["response"]) for r in df.collect()}


def test_responses(table):
    asked, users, cells, photos = timeline_input(table)
    logins = sluice.login(asked, users)
    assert parsed(sluice.login_response(logins), "userid") == {
        (1,): {"name": "Ann"}, (2,): {"name": "Unauthorized"}, (None,): {"err": "bad request"},
    }
    friends = sluice.friend_list(cells)
    assert parsed(sluice.friends_response(table("userid bigint", (1,), (9,), (None,)), friends), "userid") == {
        (1,): {"friends": [{"userid": x} for x in ("2", "3", "4", "x")]},
        (9,): {"friends": []},
        (None,): {"err": "bad request"},
    }
    lookups = sluice.photo_lookup(asked, photos)
    assert parsed(sluice.photo_response(lookups), "userid") == {
        (1,): {"time": "", "url": ""}, (2,): {"time": "t1", "url": "a"}, (None,): {"err": "bad request"},
    }
    entries = sluice.timeline(asked, users, cells, photos)
    assert parsed(sluice.timeline_response(logins, entries), "userid") == {
        (1,): {
            "name": "Ann",
            "photos": [
                {"url": "", "time": "", "name": "Unauthorized"},
                {"url": "a", "time": "t1", "name": "Bob"},
            ],
        },
        (2,): {"name": "Unauthorized"},
        (None,): {"err": "bad request"},
    }


def test_suggest_response(table):
    found = table(
        "term string, rank int, label string, probability double", ("a", 2, "c", 0.25), ("a", 1, "b", 0.5)
    )
    assert parsed(sluice.suggest_response(found), "term") == {
        ("a",): [{"label": "b", "probability": 0.5}, {"label": "c", "probability": 0.25}]
    }
