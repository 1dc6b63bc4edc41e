"""The operators' rules in plain Python, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

WHITE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def _covered(rows: list[tuple[int | None, list | bytes]], width: int) -> list[list[bool]]:
    """Which places of each row lie in a window that also starts under a smaller id."""
    key = lambda i: float("inf") if i is None else i
    first: dict = {}
    for i, units in rows:
        for p in range(len(units) - width + 1):
            w = tuple(units[p : p + width])
            first[w] = min(first.get(w, key(i)), key(i))
    out = []
    for i, units in rows:
        gone = [False] * len(units)
        for p in range(len(units) - width + 1):
            if first[tuple(units[p : p + width])] < key(i):
                gone[p : p + width] = [True] * width
        out.append(gone)
    return out


def cut_words(docs: list[tuple[int | None, str | None]], width: int) -> list[tuple]:
    split = [(i, WHITE.findall(t or "")) for i, t in docs]
    return [
        (i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
        for (i, w), gone in zip(split, _covered(split, width), strict=True)
    ]


def cut_bytes(docs: list[tuple[int | None, str | None]], width: int) -> list[tuple]:
    raw = [(i, (t or "").encode()) for i, t in docs]
    out = []
    for (i, b), gone in zip(raw, _covered(raw, width), strict=True):
        spans = sum(g and (not p or not gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


class Groups:
    def __init__(self, nodes: Iterable) -> None:
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def near_copies(docs: list[tuple[int, str | None]], size: int, percent: int) -> list[tuple]:
    sets = {}
    for i, t in docs:
        w = WHITE.findall(lower(t))
        sets[i] = {tuple(w[p : p + size]) for p in range(max(1, len(w) - size + 1))} if w else set()
    groups = Groups(sets)
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                groups.join(a, b)
    return [(i, len(s), groups.find(i), groups.find(i) == i) for i, s in sets.items()]


def contamination(docs: list[tuple], items: list[tuple], width: int, share: int) -> list[tuple]:
    patterns: dict[tuple, set] = {}
    for name, t in items:
        w = ALNUM.findall(lower(t))
        size = min(width, len(w))
        for p in range(len(w) - size + 1) if size and name is not None else ():
            patterns.setdefault(tuple(w[p : p + size]), set()).add(str(name))
    out = []
    for i, t in docs:
        w = ALNUM.findall(lower(t))
        hit, found = [False] * len(w), set()
        for size in {len(p) for p in patterns}:
            for p in range(len(w) - size + 1):
                if names := patterns.get(tuple(w[p : p + size])):
                    found |= names
                    hit[p : p + size] = [True] * size
        out.append((i, len(w), sum(hit), sorted(found), 0 < sum(hit) and share * sum(hit) >= len(w)))
    return out
