import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sluice.llm import manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, position int, node string, leaf int, tree int"


@pytest.fixture
def docs(table, spark, tmp_path):
    def make(rows):
        path = f"{tmp_path}/documents.parquet"
        table(SCHEMA, *[(*r, 1, "x", 2, 3) for r in rows]).repartition(3).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return make


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def grow(leaves):
    """The root, and for each leaf the digests before and after it on each level."""
    ways, level, under = [[] for _ in leaves], list(leaves), [[k] for k in range(len(leaves))]
    while len(level) > 1:
        above, over = [], []
        for start in range(0, len(level), 3):
            run = level[start : start + 3]
            for k in range(len(run)):
                for leaf in under[start + k]:
                    ways[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha(*run))
            over.append([x for part in under[start : start + 3] for x in part])
        level, under = above, over
    return level[0], ways


def plain(rows):
    def tampered(row):
        doc, *rest, text = row
        changed = doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 2 == 0
        return (doc, *rest, text.replace("\n", "") if changed else text)

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    order = lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))
    groups = [sorted([r for r in rows if r[1] == s], key=order) for s in sources]
    trees = [grow([leaf_of(r) for r in group]) for group in groups]
    root, over = grow([subroot for subroot, _ in trees])
    out = []
    for group, (subroot, ways), upper in zip(groups, trees, over):
        for row, way in zip(group, ways):
            folded, proof = leaf_of(tampered(row)), ""
            for before, after in way + upper:
                folded, proof = sha(before, folded, after), proof + before + after
            out.append((row[0], leaf_of(row), subroot, root, sha(proof), folded, folded == root))
    return sorted(out, key=repr)


def query(spark, tmp_path):
    from sluice.llm.queries import op13_merkle_manifest

    return op13_merkle_manifest(spark, str(tmp_path))


def rows_of(seed, sizes):
    random.seed(seed)
    rows = []
    for source, size in sizes.items():
        for _ in range(size):
            text = random.choice([None, "", "a\nb", "line\n", "x", "É\n日"])
            rows.append((len(rows) * 7 % 4999, source, random.choice([None, "de"]), random.choice([None, 5]), text))
    return rows


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 2, "b": 1}, {"a": 9, "b": 10, None: 4, "": 3, "É": 28, "z": 1}])
def test_small_trees(spark, docs, result, tmp_path, sizes):
    rows = rows_of(1, sizes)
    docs(rows)
    assert result(query(spark, tmp_path)) == plain(rows)


def test_trees_of_several_blocks(spark, docs, result, tmp_path):
    # a last block of two leaves, and as many blocks that a run of them is not whole
    rows = rows_of(2, {"hot": 243 * 4 + 2, "b": 243, "c": 244, **{f"s{k}": 1 for k in range(300)}})
    docs(rows)
    assert result(query(spark, tmp_path)) == plain(rows)


def test_awkward_rows(spark, docs, result, edges, tmp_path):
    rows = [(doc, "s" if k % 2 else None, None, k % 3 or None, text) for k, (doc, text) in enumerate(edges)]
    rows += [(8, "s", None, 1, "same\nrow")] * 4 + [(None, None, None, None, None)] * 2
    docs(rows)
    assert result(query(spark, tmp_path)) == plain(rows)
    docs([])
    assert query(spark, tmp_path).collect() == []


def test_no_node_row_serves_more_leaves_than_a_block(docs):
    built = manifest.build(docs(rows_of(3, {"hot": 800, "b": 5, "c": 1})))
    at, most = built.leaves.select("node"), []
    while not at.isEmpty():
        met = at.join(built.nodes, "node")
        most += [r["n"] for r in met.groupBy("node").agg(F.count(F.lit(1)).alias("n")).collect()]
        at = met.select(F.col("parent").alias("node"))
    assert max(most) == manifest.BLOCK


def test_limit_on_recursion_is_restored(spark, docs):
    spark.conf.set("spark.sql.cteRecursionRowLimit", "77")
    try:
        assert manifest.verify(docs(rows_of(4, {"a": 200})), {}).where("verified").count() == 200
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "77"
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
