"""Plain versions of the operators, as slow and direct as they can be written."""

from __future__ import annotations

import collections
import re

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def lower(text: str | None) -> list[bytes]:
    return re.sub(rb"[A-Z]+", lambda m: m.group().lower(), (text or "").encode()).split()


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    kinds = ("email", "ip", "card", "phone")
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), m.end(), "card") for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[0], kinds.index(s[2])))


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, words in repeated 3-word windows."""
    text = text or ""
    found, seen, repeated = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    counts = collections.Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    return len(found), sum(len(w.decode()) for w in found), sum(c in "#*$%&|<>" for c in text), repeated, len(marked)


def shingles(text: str | None, size: int) -> frozenset:
    found = lower(text)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1)) or frozenset([tuple(found)])


class Groups:
    """Union-find that keeps the smallest member as the name."""

    def __init__(self, members):
        self.parent = {m: m for m in members}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.parent[y] = x


def near_duplicates(rows: list[tuple[int, str | None]], size: int, percent: int) -> dict[int, tuple[int, int]]:
    """By id: number of shingles and component, from all pairs."""
    sets = {i: shingles(t, size) for i, t in rows}
    groups = Groups(sets)
    ids = [i for i in sets if sets[i]]
    for k, x in enumerate(ids):
        for y in ids[:k]:
            common = len(sets[x] & sets[y])
            if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                groups.join(x, y)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}
