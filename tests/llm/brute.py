"""Plain models of the operators, for small inputs."""

import hashlib
import itertools
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Sets:
    """Union-find that names each class by its smallest member."""

    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def similar(a, b, percent=80):
    shared = len(a & b)
    return bool(a) and bool(b) and 100 * shared >= percent * (len(a) + len(b) - shared)


def word_shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def linked(docs):
    """doc_id -> (size, component) for (doc_id, text) pairs."""
    sets = {doc: word_shingles(text) for doc, text in docs}
    classes = Sets()
    for a, b in itertools.combinations(sorted(sets), 2):
        if similar(sets[a], sets[b]):
            classes.join(a, b)
    return {doc: (len(found), classes.root(doc)) for doc, found in sets.items()}


def line_shingles(line):
    return frozenset(line[i : i + 8] for i in range(max(1, len(line) - 7)))


def removed_lines(docs):
    """doc_id -> set of line numbers that go."""
    lines = {
        (doc, i): line
        for doc, text in docs
        for i, line in enumerate((text or "").split("\n"))
        if re.search(r"\S", line)
    }
    sets = {line: line_shingles(line) for line in set(lines.values())}
    classes = Sets()
    for a, b in itertools.combinations(sorted(sets), 2):
        if similar(sets[a], sets[b]):
            classes.join(a, b)
    first, gone = {}, {doc: set() for doc, _ in docs}
    for place in sorted(lines):
        if first.setdefault(classes.root(lines[place]), place) != place:
            gone[place[0]].add(place[1])
    return gone


def without_repeats(docs, length=100):
    """doc_id -> (bytes, removed, spans, digest of the rest)."""
    seen, out = set(), {}
    for doc, text in sorted(docs, key=lambda row: row[0]):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                covered[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = len(re.findall(b"\1+", bytes(covered)))
        out[doc] = (len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out
