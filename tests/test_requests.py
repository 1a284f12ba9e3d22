import json

import pytest
from pyspark.sql import functions as F

import sluice
from sluice.operators.requests import only_value, parameters


@pytest.mark.parametrize(
    ("request_", "pairs"),
    [
        ("/step1?id=1&pwd=a%20b+c", [("id", "1"), ("pwd", "a b c")]),
        ("/step1?id=1&id=2&id=", [("id", "1"), ("id", "2"), ("id", "")]),
        ("/step1?&&id&=x&pwd=a=b", [("id", ""), ("", "x"), ("pwd", "a=b")]),
        ("/step1?%69d=%C3%89%26", [("id", "É&")]),
        ("/step1?id=1#?id=2", [("id", "1")]),
        ("/step1?id=1?2", [("id", "1?2")]),
        ("/step1", []),
        ("/step1?", []),
        ("/step1#a?id=1", []),
        ("", []),
        ("/step1?id=%zz&pwd=1", None),
        ("/step1?id=1&%=1", None),
        (None, None),
    ],
)
def test_parameters(table, request_, pairs):
    found = table("value string", (request_,)).select(parameters(F.col("value")).alias("p")).first()["p"]
    assert (found and [tuple(p) for p in found]) == pairs or found == pairs == []


def test_only_value(table):
    row = table("value string", ("/x?a=1&b=1&b=1&c=",)).select(parameters(F.col("value")).alias("p"))
    assert [row.select(only_value(F.col("p"), name)).first()[0] for name in "abcd"] == ["1", None, "", None]


@pytest.fixture
def site(table):
    users = table("userid bigint, password string, name string", (1, "a b", "Ann"), (2, "p", "Bob"))
    cells = table("userid bigint, cell string", (1, "2,3"), (1, "3,1"))
    photos = table("userid bigint, time string, url string", (2, "t1", "u1"), (1, "t0", "u0"))
    return users, cells, photos


def answers(table, site, *lines):
    requests = sluice.parse_requests(table("value string, key int", *[(line, 1) for line in lines]))
    return {r["request"]: json.loads(r["response"]) for r in sluice.answer_requests(requests, *site).collect()}


def test_answers(table, site):
    found = answers(
        table, site, "/step1?id=1&pwd=a+b", "/step1?id=1&pwd=x", "/step1?id=&pwd=", "/step2?id=%31", "/step2?id=9",
        "/step3?id=2", "/step3?id=x", "/step4?id=1&pwd=a%20b", "/step4?id=1&pwd=no", "/step9?id=1", "/", "",
    )
    assert found == {
        "/step1?id=1&pwd=a+b": {"name": "Ann"},
        "/step1?id=1&pwd=x": {"name": "Unauthorized"},
        "/step1?id=&pwd=": {"name": "Unauthorized"},
        "/step2?id=%31": {"friends": [{"userid": "1"}, {"userid": "2"}, {"userid": "3"}]},
        "/step2?id=9": {"friends": []},
        "/step3?id=2": {"time": "t1", "url": "u1"},
        "/step3?id=x": {"time": "", "url": ""},
        "/step4?id=1&pwd=a%20b": {
            "name": "Ann",
            "photos": [
                {"url": "", "time": "", "name": "Unauthorized"},
                {"url": "u0", "time": "t0", "name": "Ann"},
                {"url": "u1", "time": "t1", "name": "Bob"},
            ],
        },
        "/step4?id=1&pwd=no": {"name": "Unauthorized"},
        "/step9?id=1": {},
        "/": {},
        "": {},
    }


def test_bad_requests(table, site):
    lines = [
        "/step1?id=1", "/step1?pwd=p", "/step1?id=1&id=1&pwd=a+b", "/step1?id=1&pwd=a+b&pwd=a+b", "/step2", "/step2?id=1&id=2",
        "/step3?ID=1", "/step3?id=%", "/step4?id=1", "/step4?id=1&id=2&pwd=p",
    ]
    assert answers(table, site, *lines) == {line: {"err": "bad request"} for line in lines}
    # a repeated password matters only where one is wanted
    assert answers(table, site, "/step3?id=2&pwd=1&pwd=2") == {"/step3?id=2&pwd=1&pwd=2": {"time": "t1", "url": "u1"}}


def test_a_request_is_answered_once(table, site):
    requests = sluice.parse_requests(table("value string", ("/step3?id=2",), ("/step3?id=2",), (None,)))
    assert sluice.answer_requests(requests, *site).count() == 1


def test_requests_are_parsed_once(spark):
    lines = spark.createDataFrame([(f"/step{k}?id=1&pwd=a",) for k in range(1, 6)], "value string")
    users = spark.createDataFrame([(1, "a", "A")], "userid long, password string, name string")
    cells = spark.createDataFrame([(1, "1,2")], "userid long, cell string")
    photos = spark.createDataFrame([(1, "t", "u")], "userid long, time string, url string")
    answers = sluice.answer_requests(sluice.parse_requests(lines), users, cells, photos)
    assert "decode" not in answers._jdf.queryExecution().optimizedPlan().toString().lower()
    assert answers.count() == 5
