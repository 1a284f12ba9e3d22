"""Every stage of the pipeline on the smallest tables, against plain loops over what the stage before kept."""

import os

import brute
import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(spark):
    import corpus_pipeline
    from sluice.llm._frames import written
    from sluice.llm.toxicity import learn, toxicity

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]

    kept = written(stages["toxicity"](spark, docs, DATA))
    scores = toxicity(docs, learn(docs, spark.read.parquet(f"{DATA}/labels.parquet"))).collect()
    assert sorted(d for d, _ in pairs(kept)) == sorted(r["doc_id"] for r in scores if r["predicted"] == 0)

    lines = written(stages["line_dedup"](spark, kept, DATA))
    assert lines.columns == docs.columns
    assert sorted(pairs(lines)) == sorted((d, t) for d, _, _, t in brute.shared_lines(pairs(kept)))
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())

    single = written(stages["near_dedup"](spark, lines, DATA))
    assert single.columns == docs.columns
    assert sorted(d for d, _ in pairs(single)) == sorted(d for d, _, _, k in brute.near_components(pairs(lines), 5) if k)

    clean = written(stages["decontamination"](spark, single, DATA))
    assert clean.columns == docs.columns
    assert sorted(d for d, _ in pairs(clean)) == sorted(r[0] for r in brute.contamination(pairs(single), items) if not r[5])

    packed = stages["packing"](spark, clean, DATA).collect()
    assert {p["doc_id"] for p in packed} == {d for d, _ in pairs(clean)}
    whole = corpus_pipeline.run(spark, DATA).collect()
    assert sorted((p["doc_id"], p["start"]) for p in whole if p["doc_tokens"] <= 2048 and p["start"] == 0) == sorted(
        (p["doc_id"], p["start"]) for p in packed if p["doc_tokens"] <= 2048 and p["start"] == 0
    )
    assert sum(p["length"] for p in whole) == sum(p["length"] for p in packed)


def test_stages_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
