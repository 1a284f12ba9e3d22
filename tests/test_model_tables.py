import random

import pytest
from pyspark.sql import functions as F

import sluice
from sluice.operators import lookup
from sluice.operators.lookup import rows_for, suggest_from, write_lookup_model


def model_rows(spark, prefixes):
    rows = [(f"p{k} x", rank, f"w{rank}", 9 - rank, rank / 10) for k in range(prefixes) for rank in (1, 2)]
    return spark.createDataFrame(rows, "prefix string, rank int, word string, cnt bigint, prob double")


@pytest.fixture
def written(spark, tmp_path):
    path = str(tmp_path / "model")
    model = model_rows(spark, 400)
    write_lookup_model(model, path, buckets=40)
    return model, path


def terms_of(table, *values):
    return table("term string, bucket int", *[(v, 1) for v in values])


def test_look_ups_as_in_batch(table, result, written, monkeypatch):
    model, path = written
    terms = terms_of(table, *[f"p{k} X " for k in range(0, 900, 3)], "p3 x", " P3 X", "", "nope", None, "p3 x")
    expected = result(sluice.suggest(terms, model))
    assert len(expected) > 260
    assert result(suggest_from(terms, path)) == expected
    few = terms_of(table, "p7 x", "q")
    assert result(suggest_from(few, path)) == result(sluice.suggest(few, model))
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    assert result(suggest_from(terms, path)) == expected
    assert result(suggest_from(terms_of(table), path)) == result(suggest_from(terms_of(table, None), path)) == []


def files_read(spark, path, prefixes):
    asked = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
    read = rows_for(spark, path, asked)
    return read.select(F.input_file_name().alias("f")).distinct().count(), read.count()


def test_what_is_read_follows_the_terms(spark, written, monkeypatch):
    _, path = written
    assert files_read(spark, path, ["p1 x"]) == (1, 2)
    files, rows = files_read(spark, path, [f"p{k} x" for k in range(5)])
    assert files <= 5 and rows == 10
    # with more prefixes whole files are read, of the buckets asked for only
    monkeypatch.setattr(lookup, "FEW_PREFIXES", 0)
    files, rows = files_read(spark, path, ["p1 x", "p2 x"])
    assert files <= 2 and rows < 100
    assert files_read(spark, path, []) == (0, 0)


def batches(seed):
    random.seed(seed)
    vocabulary = ["the", "a", "of", *(f"w{chr(97 + k)}" for k in range(9))]
    return [[" ".join(random.choices(vocabulary, k=random.randint(0, 9))) for _ in range(60)] for _ in range(6)]


def test_model_after_batches_is_the_model_over_all(spark, result, tmp_path):
    def lines(values):
        return spark.createDataFrame([(v,) for v in values], "value string")

    kept = sluice.KeptModel(spark, str(tmp_path / "kept"), k=3, threshold=2, fan=2, buckets=5)
    seen = []
    assert result(kept.model()) == []
    for batch in [*batches(3), [], ["only here", "only here", "only here"]]:
        seen += batch
        kept.add(lines(batch))
        # as another session would find it
        kept = sluice.KeptModel(spark, str(tmp_path / "kept"), k=3, threshold=2, fan=2, buckets=5)
        assert result(kept.model()) == result(sluice.language_model(sluice.ngram_counts(lines(seen)), 3, 2))


@pytest.mark.parametrize("most_words", [0, 4, 7])
def test_kept_words_without_a_number(spark, result, tmp_path, most_words):
    def lines(values):
        return spark.createDataFrame([(v,) for v in values], "value string")

    seen = []
    for batch in [["later w0 of"], *batches(5)[:3], ["the a later of", "x" * 70 + " the"] * 3]:
        seen += batch
        kept = sluice.KeptModel(spark, str(tmp_path / "kept"), k=3, threshold=2, fan=2, buckets=3, most_words=most_words)
        kept.add(lines(batch))
        assert result(kept.model()) == result(sluice.language_model(sluice.ngram_counts(lines(seen)), 3, 2))


def test_a_run_has_few_rows_for_each_word(spark, tmp_path):
    random.seed(7)
    values = [" ".join("".join(random.choices("abcdefgh", k=4)) for _ in range(20)) for _ in range(100)]
    kept = sluice.KeptModel(spark, str(tmp_path / "kept"))
    kept.add(spark.createDataFrame([(v,) for v in values], "value string"))
    runs = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "kept" / "runs"))
    assert runs.count() <= 3 * 2000


def test_only_touched_prefixes_are_ranked(spark, result, tmp_path):
    kept = sluice.KeptModel(spark, str(tmp_path / "kept"))
    kept.add(spark.createDataFrame([("a b c",)] * 3 + [("x y",)] * 3, "value string"))
    changed = kept.add(spark.createDataFrame([("x y",)], "value string"))
    assert result(changed) == [("x", 1, "y", 4, 1.0)]


def test_a_batch_that_failed_leaves_nothing(spark, result, tmp_path, monkeypatch):
    folder = str(tmp_path / "kept")
    kept = sluice.KeptModel(spark, folder)
    first = spark.createDataFrame([("a b",)] * 3, "value string")
    kept.add(first)
    expected = result(kept.model())
    monkeypatch.setattr(kept, "_merged", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        kept.add(first)
    again = sluice.KeptModel(spark, folder)
    assert result(again.model()) == expected
    again.add(first)
    assert result(again.model()) == [("a", 1, "b", 6, 1.0)]
