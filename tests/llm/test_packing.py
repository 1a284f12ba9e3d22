import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sluice.llm import packing
from sluice.llm._frames import text_buffer
from sluice.llm.packing import END_ID, Encoder, pack
from sluice.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(tokenizer_path())
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]


@pytest.mark.parametrize("cached", [1, 100_000])
def test_ids_are_the_tokenizers(tokenizer, cached):
    random.seed(1)
    parts = [
        "a", "bc", "'", "'s", "'re", "'ll", "'S", "s", "t", " ", "  ", "\n", "\t", "\r\n", "1", "²", "é", "日本", "😀", "!", "--",
        "<|endoftext|>", "　", "\x1c", "​", "́", "\x00", "word",
    ]
    texts = ["".join(random.choices(parts, k=random.randint(0, 30))) for _ in range(3000)] + ["", "x" * 5000]
    encoder = Encoder(tokenizer_path(), cached)
    for _ in range(2):
        counts, ids = encoder.encode(*text_buffer(pa.array(texts)))
        ends = np.cumsum(counts)
        for text, a, b in zip(texts, ends - counts, ends):
            assert ids[a:b].tolist() == ids_of(tokenizer, text)[:-1], text


def check(pieces, docs, tokenizer, window):
    """Each id lies in one piece, pieces fill sequences from 0 without gaps."""
    expected = sorted(tuple(ids_of(tokenizer, text)) for _, text in docs)
    sequences, by_doc = {}, {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        by_doc.setdefault(p["doc_id"], []).append(p)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    assert sum(p["length"] for p in pieces) == sum(map(len, expected))
    texts = {}
    for doc, text in docs:
        texts.setdefault(doc, []).append(ids_of(tokenizer, text))
    for doc, parts in by_doc.items():
        for p in parts:
            crcs = {
                zlib.crc32(np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes())
                for ids in texts[doc]
                if len(ids) == p["doc_tokens"]
            }
            assert p["ids_crc32"] in crcs
        if len(texts[doc]) == 1:
            at = 0
            for p in sorted(parts, key=lambda p: p["start"]):
                assert p["start"] == at
                at += p["length"]
            assert at == len(texts[doc][0])
    return sequences


@pytest.mark.parametrize(("window", "open_windows", "min_cut"), [(64, 1, 8), (64, 4, 1), (100, 8, 200), (2048, 64, 64)])
def test_packing(documents, corpus, tokenizer, window, open_windows, min_cut):
    docs = corpus(window + open_windows, 120, 60)
    pieces = pack(documents(docs), tokenizer_path(), window, open_windows, min_cut).collect()
    sequences = check(pieces, docs, tokenizer, window)
    if min_cut < 20:
        filled = sum(n for parts in sequences.values() for _, n in parts) / (window * len(sequences))
        assert filled > 0.85


def test_awkward_rows(documents, edges, tokenizer):
    pieces = pack(documents(edges), tokenizer_path()).collect()
    check(pieces, edges, tokenizer, 2048)
    assert {p["doc_id"] for p in pieces} == {d for d, _ in edges}
    assert pack(documents([]), tokenizer_path()).collect() == []


def test_the_best_fitting_window_is_taken():
    windows = packing._Windows(10, 3, 0)

    def add(doc, n):
        return list(windows.add(doc, np.arange(n, dtype=np.uint32)))

    for doc, size in ((1, 6), (2, 7), (3, 5)):
        assert add(doc, size) == []
    (closed,) = add(4, 3)  # fits all three, best the one with room for 3
    assert [p[0] for p in closed[1]] == [2, 4]


def test_a_vocabulary_out_of_order_is_refused(tmp_path):
    path = tmp_path / "vocabulary.json"
    path.write_text('{"model": {"vocab": {"a": 0, "b": 1, "ab": 3, "ba": 2}, "merges": ["a b", "b a"]}}')
    with pytest.raises(ValueError, match="order"):
        packing._ranks(str(path))


@pytest.fixture(scope="module")
def plain_tokenizer():
    """As the library reads the file: added tokens inside a text get their own ids."""
    return Tokenizer.from_file(tokenizer_path())


@pytest.mark.parametrize("cached", [1, 100_000])
def test_added_tokens_are_the_tokenizers(plain_tokenizer, cached):
    random.seed(3)
    parts = ["<|endoftext|>", "<|endoftext", "<|endof", "text|>", "|>", "a", "'", "s", "re", " ", "  ", "\n", "1", "日本", "!"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(3000)] + ["", "a <|endoftext|> b"]
    encoder = Encoder(tokenizer_path(), cached, added=True)
    counts, ids = encoder.encode(*text_buffer(pa.array(texts)))
    ends = np.cumsum(counts)
    for text, a, b in zip(texts, ends - counts, ends):
        assert ids[a:b].tolist() == ids_of(plain_tokenizer, text)[:-1], text
    assert ids[-4:].tolist() == [64, 220, 50256, 275]


def test_query_and_stage_give_added_tokens_their_ids(spark, documents, plain_tokenizer, tmp_path):
    import corpus_pipeline

    from sluice.llm.queries import op3_pack

    docs = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>" * 3), (3, "no marker <|endof"), (4, "text|>")]
    documents(docs, 1).write.parquet(f"{tmp_path}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)["packing"]
    for pieces in (op3_pack(spark, str(tmp_path)), stage(spark, documents(docs), str(tmp_path))):
        check(pieces.collect(), docs, plain_tokenizer, 2048)


def test_an_added_token_met_otherwise_is_refused(tmp_path):
    path = tmp_path / "vocabulary.json"
    path.write_text('{"added_tokens": [{"id": 5, "content": "<x>", "lstrip": true}], "model": {}}')
    with pytest.raises(ValueError, match="as it stands"):
        packing._added_tokens(str(path))
