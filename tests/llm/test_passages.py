import random
import time

import brute
import numpy as np
import pytest

from sluice.llm.substring_dedup import FmIndex, WaveletMatrix, remove_passages, substring_dedup
from sluice.llm.suffix_dedup import remove_repeats, sorted_suffixes, suffix_dedup


def test_suffixes_are_sorted_with_their_common_prefixes():
    random.seed(1)
    strings = ["".join(random.choices("ab", k=random.randint(0, 30))).encode() for _ in range(40)] + [b"ababab"] * 3
    owner, length, common = sorted_suffixes(strings)
    found = [strings[s][len(strings[s]) - n :] for s, n in zip(owner, length)]
    assert sorted(zip(owner.tolist(), length.tolist())) == sorted((s, n) for s, x in enumerate(strings) for n in range(len(x) + 1))
    assert found == sorted(found)
    for before, after, n in zip(found, found[1:], common[1:]):
        assert n == next((k for k, (a, b) in enumerate(zip(before, after)) if a != b), min(len(before), len(after)))


def test_wavelet_ranks():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 11, 500)
    matrix = WaveletMatrix(values, 4)
    at, symbol = rng.integers(0, 501, 300), rng.integers(0, 12, 300)
    assert matrix.rank(symbol, at).tolist() == [int((values[:k] == c).sum()) for c, k in zip(symbol, at)]


def test_backward_search():
    rng = np.random.default_rng(3)
    values = np.concatenate([[0], *[np.append(rng.integers(1, 4, 40), 0) for _ in range(5)]])
    index = FmIndex(values, 3)
    asked = rng.integers(1, 4, (30, 3))
    low, high = index.intervals(asked)
    for pattern, a, b in zip(asked, low, high):
        starts = {k for k in range(len(values) - 2) if (values[k : k + 3] == pattern).all()}
        assert set(index.order[a:b].tolist()) == starts


@pytest.mark.parametrize(("seed", "window", "gram", "crowded"), [(1, 20, 8, 256), (2, 12, 4, 0), (3, 30, 30, 1), (4, 100, 32, 256)])
def test_byte_passages(documents, corpus, result, seed, window, gram, crowded):
    docs = corpus(seed, 60, 80, "ab")
    expected = brute.byte_passages(docs, window)
    found = result(suffix_dedup(documents(docs), window, gram, crowded))
    assert {r[0]: r[1:] for r in found} == expected
    assert len(found) == len(docs) and any(r[2] for r in found)


@pytest.mark.parametrize(("seed", "window", "gram", "crowded"), [(1, 5, 2, 256), (2, 5, 2, 0), (3, 13, 5, 256), (4, 4, 4, 1)])
def test_word_passages(documents, corpus, result, seed, window, gram, crowded):
    docs = corpus(seed, 60, 80, "ab")
    expected = brute.word_passages(docs, window)
    found = result(substring_dedup(documents(docs), window, gram, crowded))
    assert {r[0]: r[1:] for r in found} == expected
    assert any(r[2] for r in found)


def test_many_slices_and_collections(documents, corpus, result, monkeypatch):
    from sluice.llm import passages

    docs = corpus(9, 80, 120, "abc")
    # the limits are read in the workers, so the parts are called here
    grain = passages.Grain(20, 8, False)
    monkeypatch.setattr(passages, "CHUNK", 256)
    import pyarrow as pa

    units = grain.units(pa.array([t for _, t in docs]))
    small = passages.segments(units, grain)
    monkeypatch.undo()
    whole = passages.segments(units, grain)

    def windows(found):
        return [(t, f + k) for t, f, n in zip(found.text, found.first, found.windows) for k in range(n)]

    assert windows(small) == windows(whole)
    sizes = [max(0, len((t or "").encode()) - 19) for _, t in docs]
    assert len(windows(whole)) == sum(sizes)


def test_passages_of_awkward_rows(documents, edges, result):
    found = result(suffix_dedup(documents(edges)))
    assert len(found) == len(edges)
    by_id = {(r[0], r[1]): r[2] for r in found}
    assert by_id[None, 47] == 0 and by_id[3, 0] == 0 and by_id[4, 0] == 0
    # a text that repeats itself: all but the first window goes, and five bytes of phase
    assert by_id[9, 300_000] == 300_000 - 5
    words = result(substring_dedup(documents(edges)))
    assert {(r[0], r[1], r[2]) for r in words} >= {(9, 60_000, 0), (3, 0, 0), (6, 0, 0), (None, 11, 0)}


def test_later_copies_of_a_row_without_id(documents, result):
    text = " ".join(f"word{k}" for k in range(30))
    docs = documents([(None, text), (2, text), (2, text)])
    assert [(r[0], r[2]) for r in result(substring_dedup(docs))] == [(2, 30), (2, 30), (None, 0)]
    assert [(r[0], r[2]) for r in result(suffix_dedup(docs))] == [(2, len(text)), (2, len(text)), (None, 0)]


def test_passages_of_an_empty_table(documents, result):
    assert result(suffix_dedup(documents([]))) == []
    assert result(substring_dedup(documents([]))) == []


def test_what_stays_is_returned(documents, result):
    passage = " ".join(f"w{k}" for k in range(40))
    docs = documents([(1, passage), (2, "before " + passage + " after")])
    assert [tuple(r)[2:] for r in remove_passages(docs).collect()] == [(40, "before after")]
    ((removed, spans, kept),) = [tuple(r)[2:] for r in remove_repeats(docs).collect()]
    assert (removed, spans, bytes(kept)) == (len(passage), 1, b"before  after")


def test_suffixes_are_sorted_without_writing_all_in_every_round():
    rng = np.random.default_rng(4)
    letters = rng.integers(97, 123, (300, 160)).astype(np.uint8)
    strings = [letters[k % 300, : 150 + k % 11].tobytes() for k in range(2000)]
    symbols = np.frombuffer(b"".join(strings), np.uint8)

    def least_seconds(work):
        spent = []
        for _ in range(3):
            begin = time.process_time()
            work()
            spent.append(time.process_time() - begin)
        return min(spent)

    # on average a round has half of the suffixes; sorting and writing them in each took 1.3 times as long
    sorting = 80 * least_seconds(lambda: np.argsort(symbols, kind="stable"))
    assert least_seconds(lambda: sorted_suffixes(strings)) < 0.9 * sorting
