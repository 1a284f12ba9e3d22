import random

import pytest

#: Columns besides ``doc_id`` and ``text`` whose names the jobs use inside.
CLASHING = "_id bigint, _t1 string, row string, key int, kept boolean, words string, spans string, name string, place int"


@pytest.fixture
def documents(spark):
    """A table of documents from pairs, with further columns of awkward names and nulls in them."""

    def make(pairs, parts=3):
        rows = [(doc, text, None, "x", None, 7, True, "w", None, "n", k) for k, (doc, text) in enumerate(pairs)]
        return spark.createDataFrame(rows, f"doc_id bigint, text string, {CLASHING}").repartition(parts)

    return make


def copies(seed, docs, words, alphabet="abcde"):
    """Documents that share passages, with copies and near copies, empty and null ones; ids are not in order."""
    random.seed(seed)

    def some(n):
        return ["".join(random.choices(alphabet, k=random.randint(1, 6))) for _ in range(n)]

    passages = [some(random.randint(15, 60)) for _ in range(4)]
    out = []
    for k in range(docs):
        kind = random.random()
        if kind < 0.08:
            text = random.choice(["", None, " \n", "a"])
        elif kind < 0.25 and out:
            text = random.choice(out)[1]
        elif kind < 0.5 and out:
            old = (random.choice(out)[1] or "").split(" ")
            old[random.randrange(len(old))] = "edit" + str(k)
            text = " ".join(old)
        else:
            body = some(random.randint(1, words))
            for _ in range(random.randint(0, 2)):
                at = random.randrange(len(body) + 1)
                body[at:at] = random.choice(passages)
            text = random.choice([" ", " ", "\n"]).join(body) + random.choice(["", " ", "É日😀"])
        out.append((k * 7 % 1009, text))
    return out


@pytest.fixture
def corpus():
    return copies


EDGES = [
    (None, "no id here, and a text that others have as well"),
    (5, "no id here, and a text that others have as well"),
    (3, None),
    (4, ""),
    (8, "same row twice, word for word"),
    (8, "same row twice, word for word"),
    (8, "other text, same id"),
    (-1, "x"),
    (6, "\t \n\x0b\x0c\r"),
    (7, "É日本語 😀 \U0001d51é <|endoftext|> \x00\x1c  "),
    (9, "long " * 60_000),
]


@pytest.fixture
def edges():
    return list(EDGES)
