"""Personal data: exact patterns, and looser candidates chosen by boosted trees."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents and candidates that the trees are learnt from, chosen by a hash of the text.
TRAINING_DOCS = 20_000
TRAINING_CANDIDATES = 20_000
PRECISION = 0.99
KINDS = ("email", "ip", "card", "phone", "other")
BASE_KINDS = KINDS[:4]

# fixed patterns of the base kinds
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# from a digit inside a run nothing is found that isn't found from the run's first one
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

# high-recall generators: written-out mail addresses, and any longer run of digits and separators
_AT = re.compile(r"[\[(]at[\])]", re.IGNORECASE)
_WRITTEN_DOMAIN = re.compile(r" ?[A-Za-z0-9-]+(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]+)+", re.IGNORECASE)
_NUMBER = re.compile(r"\+?[(]?[0-9][0-9 ()./-]{4,}[0-9]")
_ACCOUNT = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
GENERATORS = ("number", "account", "mail")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Each match begins as far left of its @ as its letters reach, but not inside the match before."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _written_mails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``(at)`` outwards, as far left as letters reach, but not inside the match before."""
    free = 0
    for at in _AT.finditer(text):
        if at.start() < free:
            continue
        last = at.start() - (text[at.start() - 1 : at.start()] == " ")
        start = last
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _WRITTEN_DOMAIN.match(text, at.end()) if start < last else None
        if domain:
            yield start, domain.end()
            free = domain.end()


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[Span]:
    """The spans of the four base kinds, by kind and start."""
    found = list(_emails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for match in _IP.finditer(text):
        # a long row of digits with a zero in front may still be at most 255
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        digits = _digits(match[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_digits(match[0])) <= 15:
                found.append(("phone", *match.span()))
    return found


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans that may be personal data; they may overlap each other and the base spans."""
    found = set()
    if _DIGIT.search(text):
        found.update(match.span() for match in _NUMBER.finditer(text))
        found.update(match.span() for match in _CARD.finditer(text) if match.end() - match.start() >= 9)
        found.update(match.span() for match in _ACCOUNT.finditer(text))
    if _AT.search(text):
        found.update(_written_mails(text))
    return sorted(found)


def generator(span: str) -> int:
    """The place in ``GENERATORS`` of the one that makes this candidate."""
    return 2 if _AT.search(span) else int(span[0].isalpha())


def _account_checks(span: str) -> bool:
    """Whether the check digits of an international account number are right."""
    letters = span.replace(" ", "")
    return 15 <= len(letters) <= 34 and int("".join(str(int(c, 36)) for c in letters[4:] + letters[:4])) % 97 == 1


# fixed lists for the evidence on numbers: words before them, and dates
_PHONE_WORDS = frozenset("tel telephone phone call mobile cell fax contact whatsapp".split())
_OTHER_WORDS = frozenset(
    "order invoice version page pages isbn issn issue ticket item ref reference token key sha commit build year date "
    "article chapter section serial sku part lot batch".split()
)
_WORD = re.compile("[a-z]+")
_DATE = re.compile(r"[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4}")


def evidence(text: str, start: int, end: int) -> bool | None:
    """Whether a candidate outside the base spans is personal data, as far as check digits, form or words before it tell."""
    span = text[start:end]
    made_by = GENERATORS[generator(span)]
    if made_by == "mail":
        return False if span.rstrip()[-1].isdigit() else None
    if text[max(0, start - 1) : start].isalnum() or text[end : end + 1].isalnum():
        return False  # a piece of a longer word
    if made_by == "account":
        return _account_checks(span)
    digits = _digits(span)
    if not 7 <= len(digits) <= 17 or _DATE.fullmatch(span):
        return False
    if len(digits) >= 16 and not digits.startswith("00") and not _luhn(digits):
        return False
    words = set(_WORD.findall(text[max(0, start - 24) : start].lower()))
    if words & _OTHER_WORDS:
        return None if words & _PHONE_WORDS else False
    return True if words & _PHONE_WORDS and 9 <= len(digits) <= 15 else None


#: Account numbers of five countries: letters and digits after the check digits.
_ACCOUNT_FORMS = (("DE", 0, 18), ("GB", 4, 14), ("NL", 4, 10), ("NO", 0, 11), ("FR", 0, 23))


def altered(kind: str, span: str) -> list[tuple[str, bool]]:
    """A base span as the base patterns don't know it, and whether that is still personal data.

    A mail address is written out, a phone number loses its ``+``, and a card becomes an
    account number with right and with wrong check digits.
    """
    if kind == "email":
        local, domain = span.split("@")
        ways = ((" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "."), (" (at) ", "."))
        return [(local + at + domain.replace(".", dot), True) for at, dot in ways]
    if kind == "phone":
        plain = span[1:].lstrip()
        national = re.sub("^[0-9]{1,3}[ .-]+", "", plain)
        return [(way, True) for way in {plain: 0, "00" + plain: 0, national: 0} if len(_digits(way)) >= 9]
    if kind != "card":
        return []
    digits = _digits(span)
    country, letters, size = _ACCOUNT_FORMS[int(digits[-4:]) % len(_ACCOUNT_FORMS)]
    body = "".join(chr(65 + int(d)) for d in digits[:letters]) + (digits * 2)[letters : letters + size]
    right = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    found = []
    for check, personal in ((right, True), (right % 97 + 1, False)):
        whole = f"{country}{check:02d}{body}"
        spaced = " ".join(whole[k : k + 4] for k in range(0, len(whole), 4))
        found += [(whole, personal), (spaced, personal)]
    return found


#: Characters around an altered span in which its candidates are looked for.
_AROUND = 64


def examples(text: str) -> list[tuple[list[float], bool, bool, int]]:
    """``(features, personal, sure, generator)`` of candidates that overlap no base span.

    These are the text's own ones, of which those without evidence are unsure and count as not
    personal, and its base spans altered in place.
    """
    found = []
    base = base_spans(text)
    for start, end in _outside(candidates(text), base):
        known = evidence(text, start, end)
        found.append((features(text, start, end), bool(known), known is not None, generator(text[start:end])))
    for kind, start, end in base:
        before, after = text[max(0, start - _AROUND) : start], text[end : end + _AROUND]
        for span, personal in altered(kind, text[start:end]):
            near, place = before + span + after, (len(before), len(before) + len(span))
            if place in _outside(candidates(near), base_spans(near)):
                found.append((features(near, *place), personal, True, generator(span)))
    return found


class _Covered:
    """Stretches that don't overlap, in order, to be asked whether a span meets any of them."""

    def __init__(self, spans: list[tuple[int, int]] = ()):
        self._starts: list[int] = []
        self._ends: list[int] = []
        for start, end in sorted(spans):
            if self._ends and start <= self._ends[-1]:
                self._ends[-1] = max(self._ends[-1], end)
            else:
                self._starts.append(start)
                self._ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        before = bisect_left(self._starts, end)
        return before > 0 and self._ends[before - 1] > start

    def add(self, start: int, end: int) -> None:
        """A span that meets none."""
        place = bisect_left(self._starts, start)
        self._starts.insert(place, start)
        self._ends.insert(place, end)


def _outside(spans: list[tuple[int, int]], base: list[Span]) -> list[tuple[int, int]]:
    covered = _Covered([(start, end) for _, start, end in base])
    return [span for span in spans if not covered.meets(*span)]


_CUES = ("mail", "tel", "call", "phone", "card", "ip", "addr", "contact", "visa", "iban", "account", "id")


def features(text: str, start: int, end: int) -> list[float]:
    """Format of the span and what stands around it; whether it passes a base check is not among them."""
    span = text[start:end]
    digits = sum(c.isdigit() for c in span)
    groups = [len(x) for x in re.split("[^0-9A-Za-z]+", span) if x]
    before, after = text[max(0, start - 24) : start], text[end : end + 12]
    cue = before.lower()
    return [
        len(span), digits, digits / len(span), span.count(" "), span.count("-"), span.count("."),
        span.count("(") + span.count(")"), span.count("/"), sum(c.isalpha() for c in span),
        len(groups), max(groups, default=0), min(groups, default=0), groups[0] if groups else 0,
        groups[-1] if groups else 0, float(span[0] == "+"),
        float(before[-1:].isalnum()), float(before[-1:].isspace()), float(before.rstrip()[-1:] == ":"),
        float(after[:1].isalnum()), float(after[:1].isspace()), float(any(word in cue for word in _CUES)),
        float(sum(c.isdigit() for c in before)), float(sum(c.isdigit() for c in after)),
        float(generator(span)), float(span[0].isalpha() and not _AT.search(span) and _account_checks(span)),
    ]


@dataclass(frozen=True)
class BoostedTrees:
    """Trees of depth 2 as ``(feature, cut, feature, cut, feature, cut, four leaves)``, summed as log-odds."""

    base: float
    trees: tuple[tuple[float, ...], ...]
    threshold: float
    #: By generator; without, ``threshold`` holds for all.
    thresholds: tuple[float, ...] = ()

    def threshold_of(self, span: str) -> float:
        return self.thresholds[generator(span)] if self.thresholds else self.threshold

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in self.trees:
            left = x[:, int(tree[0])] <= tree[1]
            low = x[:, int(tree[2])] <= tree[3]
            high = x[:, int(tree[4])] <= tree[5]
            leaves = np.array(tree[6:])
            total += np.where(left, np.where(low, leaves[0], leaves[1]), np.where(high, leaves[2], leaves[3]))
        return total


def _best_split(x: np.ndarray, slope: np.ndarray, curve: np.ndarray, cuts: list[np.ndarray]) -> tuple[int, float]:
    best = (0.0, 0, np.inf)
    whole = slope.sum() ** 2 / (curve.sum() + 1)
    for feature, values in enumerate(cuts):
        for cut in values:
            left = x[:, feature] <= cut
            a, b = slope[left].sum(), curve[left].sum()
            c, d = slope.sum() - a, curve.sum() - b
            gain = a * a / (b + 1) + c * c / (d + 1) - whole
            if gain > best[0] + 1e-9:
                best = (gain, feature, float(cut))
    return best[1], best[2]


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 20,
    rate: float = 0.3,
    sure: np.ndarray | None = None,
    made_by: np.ndarray | None = None,
) -> BoostedTrees:
    """Gradient boosting for the logistic loss; a third of the rows is kept to calibrate the thresholds.

    Rows that are not ``sure`` train the trees but are no part of the precision. With ``made_by`` each generator has its own
    threshold, at log-odds of at least 0: what looks like more unsure rows than personal ones stays out.
    """
    kept = np.arange(len(y)) % 3 == 0
    tx, ty = x[~kept], y[~kept]
    mean = min(max(ty.mean() if len(ty) else 0.5, 1e-3), 1 - 1e-3)
    base, trees = float(np.log(mean / (1 - mean))), []
    cuts = [np.unique(np.quantile(tx[:, k], np.linspace(0, 0.95, 12))) for k in range(x.shape[1])] if len(tx) else []
    odds = np.full(len(ty), base)
    for _ in range(rounds if 0 < ty.sum() < len(ty) else 0):
        p = 1 / (1 + np.exp(-odds))
        slope, curve = ty - p, p * (1 - p)
        root = _best_split(tx, slope, curve, cuts)
        left = tx[:, root[0]] <= root[1]
        tree: list[float] = [*root]
        leaves: list[float] = []
        steps = np.zeros(len(ty))
        for side in (left, ~left):
            split = _best_split(tx[side], slope[side], curve[side], cuts)
            tree += split
            low = tx[:, split[0]] <= split[1]
            for part in (side & low, side & ~low):
                leaf = rate * slope[part].sum() / (curve[part].sum() + 1)
                leaves.append(float(leaf))
                steps[part] = leaf
        odds += steps
        trees.append((*map(float, tree), *leaves))
    fitted = BoostedTrees(base, tuple(trees), np.inf)
    told = kept if sure is None else kept & sure
    odds = fitted.log_odds(x[told])
    thresholds = []
    for number in range(len(GENERATORS)) if made_by is not None else ():
        own = made_by[told] == number
        thresholds.append(max(0.0, _threshold(odds[own], y[told][own])))
    return BoostedTrees(base, fitted.trees, _threshold(odds, y[told]), tuple(thresholds))


def _threshold(odds: np.ndarray, y: np.ndarray) -> float:
    """The lowest log-odds above which the share of positives is ``PRECISION``, with a margin for few rows."""
    best = np.inf
    for cut in np.unique(odds):
        chosen = y[odds >= cut]
        if chosen.sum() >= PRECISION * (len(chosen) + 2):
            best = min(best, float(cut))
    return best


def learn(docs: DataFrame, rows: int = TRAINING_DOCS, most: int = TRAINING_CANDIDATES) -> BoostedTrees:
    """Trees from about ``rows`` documents: their candidates outside base spans, and their base spans altered."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [example for text in batch.column(0).to_pylist() for example in examples(text)]
            columns = [[example[k] for example in found] for k in range(4)]
            kinds = (pa.list_(pa.float64()), pa.bool_(), pa.bool_(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)],
                ["x", "y", "sure", "made_by"],
            )

    total = max(1, docs.count())
    order = F.xxhash64("text")
    sample = docs.select("text").where(
        F.col("text").isNotNull() & (F.pmod(order, F.lit(1 << 20)) < min(1.0, rows / total) * (1 << 20))
    )
    measured = (
        sample.mapInArrow(measure, "x array<double>, y boolean, sure boolean, made_by int")
        .orderBy(F.xxhash64("x", "y"))
        .limit(most)
        .collect()
    )
    width = len(features("0", 0, 1))
    x = np.array([row["x"] for row in measured]).reshape(-1, width)
    y = np.array([row["y"] for row in measured], float)
    sure = np.array([row["sure"] for row in measured], bool)
    return fit_trees(x, y, sure=sure, made_by=np.array([row["made_by"] for row in measured], int))


def added_spans(text: str, base: list[Span], model: BoostedTrees) -> list[Span]:
    """Candidates above their generator's threshold that overlap no base span; of overlapping ones the likeliest."""
    free = _outside(candidates(text), base)
    if not free:
        return []
    odds = model.log_odds(np.array([features(text, a, b) for a, b in free]))
    chosen: list[Span] = []
    covered = _Covered()
    for k in sorted(range(len(free)), key=lambda k: (-odds[k], free[k])):
        a, b = free[k]
        if odds[k] >= model.threshold_of(text[a:b]) and not covered.meets(a, b):
            covered.add(a, b)
            chosen.append(("other", a, b))
    return sorted(chosen, key=lambda span: span[1])


def find_personal(docs: DataFrame, model: BoostedTrees) -> DataFrame:
    """``(doc_id, spans)`` per row: all spans as ``(kind, start, end)`` in code points, by kind and start.

    The base spans are always among them; ``other`` spans are the ones that the trees add. A null
    or empty text has none, an empty table gives no rows, and a long text takes time in proportion to its length. Repeated rows and rows without an id are treated like any other, and other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                spans = base + added_spans(text or "", base, model)
                found.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>"
    )


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each span, overlapping ones taken together, replaced by its kind in angle brackets."""
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


