import math
import time

import pytest
from pyspark.sql import functions as F

import sluice
from sluice.functions.text import page_words, query_term
from sluice.sources.text import split_lines


def counts_of(table, result, *texts):
    return dict(result(sluice.ngram_counts(table("value string", *[(t,) for t in texts]))))


def test_ngrams_of_a_line(table, result):
    found = counts_of(table, result, "To be, or not to be!")
    assert sum(found.values()) == 20
    assert {k: v for k, v in found.items() if v > 1} == {"to": 2, "be": 2, "to be": 2}


def test_ngrams_do_not_cross_lines(table, result):
    assert "b c" not in counts_of(table, result, "a b", "c")


def test_ngrams_take_ascii_letters_only(table, result):
    assert counts_of(table, result, "café") == {"caf": 1}
    assert counts_of(table, result, "a\\nb") == {"a": 1, "nb": 1, "a nb": 1}
    assert counts_of(table, result, "", "12 34") == {}


@pytest.mark.parametrize("most", [1, 2, 3, 7])
def test_ngrams_of_other_lengths(table, result, most):
    found = result(sluice.ngrams(table("id int, value string", (1, "a b c d")), "id", max_words=most), "phrase")
    words = "a b c d".split()
    expected = [(" ".join(words[i : i + n]),) for n in range(1, min(most, 4) + 1) for i in range(5 - n)]
    assert found == sorted(expected, key=repr)


def test_every_line_break_ends_a_line(table, result):
    lines = split_lines(table("text string", ("a\r\nb\rc\nd",)), "text")
    assert [v for (v,) in result(lines)] == ["a", "b", "c", "d"]


def test_page_tokens(table, result):
    pages = table("title string, body string", ("T", "<b>A</b>\\nb"), ("D", "12 3"), ("E", ""), ("U", "a <b c"))
    assert result(sluice.page_tokens(pages)) == [
        ("D", ""), ("E", ""), ("T", "a"), ("T", "b"), ("U", "a"), ("U", "b"), ("U", "c"),
    ]


@pytest.mark.parametrize(
    ("body", "words"),
    [
        ("a<x>b", ["a", "b"]),
        ("a<x", ["a", "x"]),
        ("a>b<c", ["a", "b", "c"]),
        ("<<a>>b", ["b"]),
        ("<a\nb>c", ["c"]),
        ("<a\\nb", ["a", "b"]),
        (">", [""]),
    ],
)
def test_markup_ends_at_the_last_bracket(table, body, words):
    assert table("body string", (body,)).select(page_words(F.col("body"))).first()[0] == words


def test_open_brackets_take_linear_time(spark):
    page = spark.range(1).select(F.repeat(F.lit("<a "), 350_000).alias("body"), F.lit("T").alias("title"))
    begin = time.time()
    assert sluice.page_tokens(page).count() == 350_000
    assert time.time() - begin < 20


def pages_of_fixture(table):
    return table("title string, body string", ("T1", "cloud Cloud x"), ("T2", "1"))


def test_tfidf(table, result):
    found = {(w, t): (tf, df, score) for w, t, tf, df, score in result(sluice.tfidf(pages_of_fixture(table)))}
    assert found["cloud", "T1"][:2] == (2, 1)
    assert found["cloud", "T1"][2] == pytest.approx(2 * math.log(4))
    assert found["", "T2"][2] == pytest.approx(math.log(4))
    found = {r[0]: r[4] for r in result(sluice.tfidf(pages_of_fixture(table), n_mode="documents"))}
    assert found["cloud"] == pytest.approx(2 * math.log(2))
    with pytest.raises(ValueError, match="n_mode"):
        sluice.tfidf(pages_of_fixture(table), n_mode="words")


def test_tfidf_broadcasts_no_vocabulary(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([(str(i), f"a b{i}") for i in range(50)], "title string, body string").write.parquet(path)
    plan = sluice.tfidf(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_tfidf_term(table, result):
    pages = table("title string, body string", ("T1", "a b a"), ("T2", "b"), ("", "a"), ("T3", "a"), (None, "a"))
    found = [tuple(r) for r in sluice.tfidf_term(pages, "a").collect()]
    # 7 tokens; three titles and the empty and the null one hold it
    assert [t for t, _ in found] == ["T1", "T3"]
    assert found[0][1] == pytest.approx(2 * math.log(7 / 4))
    assert sluice.tfidf_term(pages, "zzz").collect() == []


def fixture_counts(table):
    return table(
        "phrase string, cnt bigint", ("a", 10), ("a b", 4), ("a c", 4), ("a d", 2), ("z y", 5)
    )


def test_language_model(table, result):
    assert result(sluice.language_model(fixture_counts(table))) == [
        ("a", 1, "b", 4, 0.4), ("a", 2, "c", 4, 0.4), ("z", 1, "y", 5, None),
    ]


def test_language_model_keeps_prefixes_apart(table, result):
    rows = [("p", 100)] + [(f"p w{i}", 10 + i) for i in range(7)] + [("q w", 9)]
    found = result(sluice.language_model(table("phrase string, cnt bigint", *rows)))
    assert [(p, r, w) for p, r, w, _, _ in found] == [("p", k + 1, f"w{6 - k}") for k in range(5)] + [("q", 1, "w")]


def test_language_model_without_a_count_of_the_prefix_uses_all_places(table, result):
    rows = [(f"p w{i}", 10 + i) for i in range(7)]
    found = result(sluice.language_model(table("phrase string, cnt bigint", *rows)))
    assert [(r, w, prob) for _, r, w, _, prob in found] == [(k + 1, f"w{6 - k}", None) for k in range(5)]


def test_language_model_takes_one_pass(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(10).selectExpr("'a b c' as value").write.parquet(path)
    model = sluice.language_model(sluice.ngram_counts(spark.read.parquet(path)))
    assert model._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_suggest(table, result):
    model = sluice.language_model(fixture_counts(table))
    terms = table("term string", (" A ",), ("\t a\r\n\0\x0b",), ("nope",), (None,), (" A ",))
    found = result(sluice.suggest(terms, model))
    assert [r[1:] for r in found if r[0] == " A "] == [(1, "b", 0.4), (2, "c", 0.4)]
    assert {r[0] for r in found} == {" A ", "\t a\r\n\0\x0b"}


def test_query_term(table):
    assert table("t string", ("  The Word\r\n",)).select(query_term(F.col("t"))).first()[0] == "the word"


def test_pack_model(table, result):
    packed = sluice.pack_model(sluice.language_model(fixture_counts(table)))
    assert [(p, [tuple(x) for x in s]) for p, s in result(packed)] == [
        ("a", [("b", 0.4), ("c", 0.4)]), ("z", [("y", None)]),
    ]


def test_page_words_take_no_pattern_of_alternatives(spark):
    """Such a pattern met every character; the words are those it gave, whatever the marks are next to each other."""
    import re

    from pyspark.sql import functions as F

    from sluice.functions.text import page_words

    odd = ["", None, "<", ">", "a<b>c", "a\\nb", "\\\\n", "\\<b>n", "<a\\nb>c<d", "x<<y>z\\", "a>b<c\\nd", "<b>\\n</b>Ab\\N é\nZ", "\\n<\\n>\\n"]
    rows = spark.createDataFrame([(v,) for v in odd], "body string").select("body", page_words(F.col("body")).alias("words")).collect()
    for body, words in rows:
        spaced = None if body is None else re.sub(r"<[^>]*>|\\n|[^a-zA-Z]", " ", body)
        assert words == (None if body is None else re.split(" +", spaced.strip(" ").lower()))
    assert "|" not in str(page_words(F.col("body")))


def test_phrases_by_key_are_counted_without_a_shuffle_of_phrases(spark):
    from collections import Counter

    from sluice.plans.skew import SkewLimits

    values = [(k % 7 or None, f"a b {'c ' * (k % 3)}w{chr(97 + k % 26)}") for k in range(100)] + [(3, None), (9, "")]
    values += [(8, "long line of one key " * 40)] * 3
    lines = spark.createDataFrame(values, "key int, value string").repartition(3)
    found = sluice.ngrams_by_key(lines, "key")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key#" in plan and "phrase#" not in "".join(x for x in plan.splitlines() if "hashpartitioning" in x)
    expected = Counter()
    for key, line in values:
        words = (line or "").split()
        for start in range(len(words)):
            expected.update((key, " ".join(words[start:end])) for end in range(start + 1, min(start + 5, len(words)) + 1))
    some_hot = sluice.ngrams_by_key(lines, "key", limits=SkewLimits(max_hot=100, min_rows=1000))
    for counts in (found, some_hot):
        rows = [((row["key"], row["phrase"]), row["cnt"]) for row in counts.collect()]
        assert len(rows) == len(expected) and dict(rows) == expected
