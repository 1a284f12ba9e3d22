"""The operators' results by plain loops over all documents."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def sha(value):
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def rank(doc_id):
    return -(2**63) if doc_id is None else doc_id


def runs(mask):
    return sum(1 for k, x in enumerate(mask) if x and not (k and mask[k - 1]))


def byte_passages(docs, window):
    """docs without repeated ids -> {id: (bytes, removed, spans, sha)}"""
    first, masks = {}, {}
    for doc, text in sorted(docs, key=lambda d: rank(d[0])):
        data = (text or "").encode()
        mask = bytearray(len(data))
        for k in range(len(data) - window + 1):
            part = data[k : k + window]
            if part in first:
                mask[k : k + window] = b"\x01" * window
            first.setdefault(part, (doc, k))
        masks[doc] = (len(data), sum(mask), runs(mask), sha(bytes(b for b, m in zip(data, mask) if not m)))
    return masks


def word_passages(docs, window):
    first, out = {}, {}
    order = sorted(docs, key=lambda d: rank(d[0]))
    for doc, text in order:
        words = (text or "").encode().split()
        for k in range(len(words) - window + 1):
            first.setdefault(tuple(words[k : k + window]), rank(doc))
    for doc, text in order:
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < rank(doc):
                gone.update(range(k, k + window))
        out[doc] = (len(words), len(gone), sha(b" ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall((text or "").encode().translate(LOWER).decode())


def contamination(docs, items, window=13):
    windows = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[k : k + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for size, k in itertools.product(sizes, range(len(words))):
            met = windows.get(tuple(words[k : k + size]))
            if met and k + size <= len(words):
                found |= met
                hit.update(range(k, k + size))
        out.append((doc, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def shingles(text, size):
    words = (text or "").encode().translate(LOWER).split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def near_components(docs, size, threshold=80):
    sets = [shingles(text, size) for _, text in docs]
    parent = list(range(len(docs)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    index = defaultdict(list)
    for k, found in enumerate(sets):
        common = Counter(other for s in found for other in index[s])
        for other, n in common.items():
            if 100 * n >= threshold * (len(found) + len(sets[other]) - n):
                parent[top(k)] = top(other)
        for s in found:
            index[s].append(k)
    least = defaultdict(list)
    for k, (doc, _) in enumerate(docs):
        least[top(k)].append(rank(doc))
    out = []
    for k, (doc, _) in enumerate(docs):
        component = min(least[top(k)]) if sets[k] else rank(doc)
        out.append((doc, len(sets[k]), None if component == rank(None) else component, component == rank(doc)))
    return out


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").encode().translate(LOWER).decode()


def shared_lines(docs, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= min_chars:
                holders[line_key(line)].add(rank(doc))
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            held = holders.get(line_key(line), ())
            if len(held) < min_docs or max(held) == rank(doc):
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def exact_groups(docs):
    groups = defaultdict(list)
    texts = [re.sub("[\x20\x09-\x0d]+", " ", text or "") for _, text in docs]
    for (doc, _), text in zip(docs, texts):
        groups[text].append(doc)
    out, used = [], set()
    for (doc, _), text in sorted(zip(docs, texts), key=lambda x: rank(x[0][0])):
        keep = min(groups[text], key=rank)
        out.append((doc, keep, len(groups[text]), doc == keep and text not in used, sha(text)))
        used.add(text)
    return out


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(found)


def luhn(digits):
    values = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(reversed(digits))]
    return sum(v // 10 + v % 10 for v in values) % 10 == 0


PERSONAL = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def personal(text):
    def fits(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(x) <= 255 for x in value.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    return [
        (kind, m.start(), m.end())
        for kind, pattern in PERSONAL.items()
        for m in pattern.finditer(text or "")
        if fits(kind, m[0])
    ]
