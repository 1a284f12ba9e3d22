"""Toxicity by a weighted lexicon, matched in folded text and normalised by length."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm._frames import written

#: Labelled rows of each class that the lexicon and the score are learnt from, chosen by a hash of their ids.
TRAINING_ROWS = 3_000
MAX_ENTRIES = 4_000
STEM_LENGTHS = range(4, 9)
#: Toxic texts that an entry must occur in: a share of them, between these bounds.
SUPPORT = (3, 20)
SUPPORT_SHARE = 15
MIN_WEIGHT = 2.5
CLASSES = 2

# fixed values: letters of other scripts that look like Latin ones, and digits and signs written for letters.
# I, l and 1 stand for each other, so all become i.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѐ": "e", "ё": "e",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "ı": "i", "ł": "i",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "|": "i", "l": "i",
}
_WIDE_LATIN = {0xFF41 + place: chr(ord("a") + place) for place in range(26)}
_FOLD = {ord(sign): letter for sign, letter in LOOK_ALIKES.items()} | _WIDE_LATIN | {0xFF4C: "i"}
_FOLD |= dict.fromkeys((0x200B, 0x200C, 0x200D, 0x00AD, 0x2060))
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    return text.lower().translate(_FOLD)


@dataclass(frozen=True)
class ToxicityModel:
    """``entries`` has a weight for each stem (``x``, at the start of a word) and whole word (``x ``);
    ``exceptions`` are pairs of words of which the second or first is an entry that does not count there."""

    entries: dict[str, float]
    exceptions: frozenset[str]
    coefficients: tuple[float, ...]


class _Matcher:
    def __init__(self, entries: dict[str, float], exceptions: frozenset[str]):
        import ahocorasick

        self._automaton = ahocorasick.Automaton()
        self._exceptions = exceptions
        by_stem: dict[str, list[tuple[bool, float]]] = {}
        for entry, weight in entries.items():
            by_stem.setdefault(entry.rstrip(" "), []).append((entry.endswith(" "), weight))
        for stem, kinds in by_stem.items():
            self._automaton.add_word(stem, (len(stem), kinds))
        if by_stem:
            self._automaton.make_automaton()
        self._empty = not by_stem

    def hits(self, folded: str) -> dict[int, float]:
        """The greatest weight among the entries that match at each start of a word."""
        found: dict[int, float] = {}
        if self._empty or not folded:
            return found
        for end, (size, kinds) in self._automaton.iter(folded):
            start = end - size + 1
            if start and folded[start - 1].isalpha():
                continue
            inside = end + 1 < len(folded) and folded[end + 1].isalpha()
            for whole, weight in kinds:
                if not (whole and inside):
                    found[start] = max(weight, found.get(start, weight))
        return found

    def pairs(self, folded: str, start: int) -> list[str]:
        """The word at ``start`` with the word before it and with the word after it."""
        word = _WORD.match(folded, start)
        before = _WORD.findall(folded, max(0, start - 64), start)[-1:]
        after = _WORD.search(folded, word.end(), word.end() + 64)
        return [f"{x} {word[0]}" for x in before] + ([f"{word[0]} {after[0]}"] if after else [])

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Weight in all, weight a hundred words, and hits on a logarithmic scale."""
        folded = fold(text or "")
        total, number = 0.0, 0
        for start, weight in self.hits(folded).items():
            if self._exceptions and not self._exceptions.isdisjoint(self.pairs(folded, start)):
                continue
            total, number = total + weight, number + 1
        if not number:
            return 0.0, 0.0, 0.0
        words = len(folded.split())
        return np.log1p(total), np.log1p(100 * total / max(words, 1)), np.log1p(number)


def held_out(doc_id: Column) -> Column:
    """Rows that nothing may be learnt from; a row without an id is none of them, but is not learnt from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """``(text, toxic)`` of at most ``rows`` labelled documents of each class, and how many there are of each.

    Of several labels of one id the greatest counts.
    """
    usable = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = {row["toxic"]: row["count"] for row in usable.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id")
    chosen = None
    for kind in range(CLASSES):
        part = usable.where(F.col("toxic") == kind).orderBy(order, "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null")
    # at most 2 * rows ids
    return written(texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")), counts


def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each class an entry occurs; summed per task."""
    counts = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            entries = set()
            for word in set(_WORD.findall(fold(text))):
                entries.add(word + " ")
                entries.update(word[:size] for size in STEM_LENGTHS if size <= len(word))
            counts[toxic].update(entries)
    # an entry of no toxic text of this task may be one of another's
    names = [*counts[0].keys() | counts[1].keys()]
    for first in range(0, len(names), 100_000):
        part = names[first : first + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string())] + [pa.array([c[x] for x in part], pa.int64()) for c in counts],
            names=["entry", "clean", "toxic"],
        )


def learn_lexicon(sample: DataFrame, most: int = MAX_ENTRIES) -> dict[str, float]:
    """Log-odds of the words and stems that tell toxic from other texts; at most ``most`` of them."""
    sizes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    if len(sizes) < CLASSES:
        return {}
    clean, toxic = sizes[0], sizes[1]
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    support = min(max(SUPPORT[0], toxic // SUPPORT_SHARE), SUPPORT[1])
    rows = (
        sample.repartition("text")
        .mapInArrow(_count_entries, "entry string, clean bigint, toxic bigint")
        .groupBy("entry")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= support)
        .withColumn("weight", weight)
        .where(F.col("weight") >= MIN_WEIGHT)
        .orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "entry")
        .limit(most)
        .collect()
    )
    found = {row["entry"]: row["weight"] for row in rows}
    return {
        entry: weight
        for entry, weight in found.items()
        # an entry says no more than a stem of it that weighs as much
        if not any(found.get(entry[:size], 0.0) >= weight for size in STEM_LENGTHS if size < len(entry.rstrip(" ")))
    }


def learn_exceptions(sample: DataFrame, entries: dict[str, float], support: int = 3) -> frozenset[str]:
    """Pairs of words with an entry in them that occur in ``support`` clean texts and in no toxic one."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _Matcher(entries, frozenset())
        for batch in batches:
            names, kinds = [], []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folded = fold(text)
                found = {pair for start in matcher.hits(folded) for pair in matcher.pairs(folded, start)}
                names += found
                kinds += [toxic] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(kinds, pa.int32())], ["pair", "toxic"])

    found = (
        sample.mapInArrow(pairs, "pair string, toxic int")
        .groupBy("pair")
        .agg(F.count(F.lit(1)).alias("texts"), F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") == 0) & (F.col("texts") >= support))
        .orderBy(F.desc("texts"), "pair")
        .limit(MAX_ENTRIES)
    )
    return frozenset(row["pair"] for row in found.collect())


def _logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(design.shape[1])
    penalty = ridge * np.eye(len(beta))
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weights * (y - p)) - penalty @ beta
        curve = (design * (weights * p * (1 - p))[:, None]).T @ design + penalty
        beta = beta + np.clip(np.linalg.solve(curve + 1e-9 * np.eye(len(beta)), slope), -4, 4)
    return beta


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> ToxicityModel | None:
    """A model from the labelled documents that are not held out; none unless there are toxic and clean ones."""
    sample, counts = training_rows(docs, labels, rows)
    entries = learn_lexicon(sample)
    if not entries:
        return None
    exceptions = learn_exceptions(sample, entries)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _Matcher(entries, exceptions)
        for batch in batches:
            found = [matcher.features(text) for text in batch.column(0).to_pylist()]
            columns = [pa.array([x[k] for x in found], pa.float64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(1)], ["a", "b", "c", "toxic"])

    # three numbers a row, at most 2 * rows of them
    measured = np.array([tuple(row) for row in sample.mapInArrow(measure, "a double, b double, c double, toxic int").collect()])
    x, y = measured[:, :3], measured[:, 3]
    share = np.array([counts[k] / max(1, (y == k).sum()) for k in range(CLASSES)])
    weights = share[y.astype(int)]
    beta = _logistic(x, y, weights * len(y) / weights.sum())
    return ToxicityModel(entries, exceptions, tuple(float(b) for b in beta))


def scorer(model: ToxicityModel | None):
    """A column function from text to a score between 0 and 1; null and empty texts are scored like texts without hits."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = _Matcher(model.entries, model.exceptions) if model else None
        for part in texts:
            if matcher is None:
                yield pd.Series(np.zeros(len(part)))
                continue
            x = np.array([matcher.features(text) for text in part]).reshape(len(part), 3)
            beta = np.array(model.coefficients)
            yield pd.Series(1 / (1 + np.exp(-np.clip(beta[0] + x @ beta[1:], -30, 30))))

    return score


def toxicity(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs``, from its ``text`` alone.

    Repeated rows are scored alike; a null or empty text has the lowest score; other columns are
    not read. Without a model every score is 0. An empty table gives no rows. Hits are measured against the length of a text,
    so long texts are scored like short ones.
    """
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        scorer(model)(F.col("text").cast("string")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel | None, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns.

    Null and empty texts score lowest and stay; repeated rows stay or go together.
    """
    return docs.where(scorer(model)(F.col("text").cast("string")) < threshold)
