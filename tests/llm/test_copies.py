import random

import brute
import pytest

from sluice.llm.components import components
from sluice.llm.exact_dedup import dedup
from sluice.llm.line_dedup import line_dedup
from sluice.llm.near_dedup import drop_near_copies, near_dedup


@pytest.mark.parametrize(("seed", "block"), [(1, 3), (2, 7), (3, 2048)])
def test_exact_copies(documents, corpus, result, seed, block):
    docs = corpus(seed, 80, 20)
    docs += [(2000 + k, (t or "").replace(" ", " \t ")) for k, (_, t) in enumerate(docs[:10])]
    assert result(dedup(documents(docs), block)) == sorted(brute.exact_groups(docs), key=repr)


def test_exact_copies_of_awkward_rows(documents, edges, result):
    assert result(dedup(documents(edges))) == sorted(brute.exact_groups(edges), key=repr)
    assert result(dedup(documents([]))) == []


def test_texts_of_equal_blocks_in_other_order_differ(documents, result):
    docs = [(1, "aabb"), (2, "bbaa"), (3, "aabbaa"), (4, "aabb"), (5, "aa"), (6, "aabbaabb"), (7, "aabbaabb")]
    assert result(dedup(documents(docs), 2), "doc_id", "keep_id") == [(1, 1), (2, 2), (3, 3), (4, 1), (5, 5), (6, 6), (7, 6)]


@pytest.mark.parametrize("size", [4, 5])
def test_near_copies(documents, corpus, result, size):
    docs = corpus(size, 150, 60)
    assert result(near_dedup(documents(docs), words=size)) == sorted(brute.near_components(docs, size), key=repr)


def test_links_that_miss_the_centre_of_their_bucket(documents, result):
    """A chain of copies, each with one more word changed, where the ends are far apart."""
    random.seed(5)
    words = [f"w{random.randrange(10**6)}" for _ in range(300)]
    docs = []
    for k in range(40):
        docs.append((100 - k, " ".join(words)))
        words[k * 7] = f"e{k}"
    found = result(near_dedup(documents(docs), words=4))
    assert found == sorted(brute.near_components(docs, 4), key=repr)


def test_near_copies_of_awkward_rows(documents, edges, result):
    assert result(near_dedup(documents(edges))) == sorted(brute.near_components(edges, 5), key=repr)
    assert result(near_dedup(documents([]))) == []
    kept = drop_near_copies(documents(edges))
    assert kept.columns == documents(edges).columns
    assert sorted((brute.rank(r["doc_id"]) for r in kept.collect())) == sorted(
        brute.rank(d) for d, _, _, keep in brute.near_components(edges, 5) if keep
    )


def test_stage_keeps_one_row_of_near_copies(spark, documents):
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    one, two, three = (" ".join(f"{name}{k}" for k in range(60)) for name in "abc")
    docs = [
        (None, one), (None, one + " end"), (4, one), (None, one),
        (8, two), (8, two), (8, three), (9, three + " end"),
        (None, "a text of its own"), (5, ""), (5, ""), (6, None), (None, ""), (None, None),
    ]
    kept = stage(spark, documents(docs), "")
    assert kept.columns == documents(docs).columns
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    of_one = [row for row in found if (row[1] or "").startswith("a0")]
    assert of_one in ([(None, one)], [(None, one + " end")])
    rest = [(8, two), (8, three), (None, "a text of its own"), (5, ""), (5, ""), (6, None), (None, ""), (None, None)]
    assert sorted((row for row in found if row not in of_one), key=repr) == sorted(rest, key=repr)


def test_components(table, result):
    random.seed(6)
    links = [(random.randrange(200), random.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(300, 340)]
    parent = {x: x for link in links for x in link}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        parent[high] = low
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert result(components(table("a bigint, b bigint", *links))) == sorted(((x, top(x)) for x in linked), key=repr)


def lines_corpus(seed):
    random.seed(seed)
    shared = [" ".join(random.choices("lorem ipsum dolor sit amet".split(), k=12)) for _ in range(8)]
    docs = []
    for k in range(60):
        lines = [random.choice([random.choice(shared), f"own line {k} of no interest to others at all, {j}", "short"]) for j in range(random.randint(0, 12))]
        lines = [random.choice([x, x.upper(), f"\t{x} ", x + "\r"]) for x in lines]
        docs.append((k * 11 % 61 if k else None, "\n".join(lines)))
    return docs


@pytest.mark.parametrize(("batches", "runs"), [(1, 2), (2, 2), (4, 2), (7, 3)])
def test_lines_of_many_documents(documents, result, batches, runs):
    docs = lines_corpus(batches)
    found = line_dedup(documents(docs), batches=batches, runs_per_level=runs)
    assert result(found, "row.doc_id", "n_lines", "n_dropped", "kept_text") == sorted(brute.shared_lines(docs), key=repr)
    assert any(r[2] for r in brute.shared_lines(docs))


def test_lines_of_awkward_rows(documents, edges, result):
    line = "a line of more than forty characters that comes back"
    docs = edges + [(k, f"{line}\n\n{line} ") for k in (5, 10, 11, 12, 12)] + [(None, line), (13, "x\n" * 9 + line)]
    found = line_dedup(documents(docs))
    assert result(found, "row.doc_id", "n_lines", "n_dropped", "kept_text") == sorted(brute.shared_lines(docs), key=repr)
    assert found.select("row.*").columns == documents(docs).columns
    assert result(line_dedup(documents([]))) == []
