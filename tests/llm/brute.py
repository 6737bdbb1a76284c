"""Plain Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def removed_bytes(texts: list[str | None], window: int) -> list[tuple[int, int, int, str]]:
    raw = [(t or "").encode() for t in texts]
    times = Counter(b[p : p + window] for b in raw for p in range(len(b) - window + 1))
    result = []
    for b in raw:
        gone = [False] * len(b)
        for p in range(len(b) - window + 1):
            if times[b[p : p + window]] > 1:
                gone[p : p + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        result.append((len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return result


def removed_words(rows: list[tuple[int | None, str | None]], window: int) -> list[tuple[int, int, str]]:
    words = [(t or "").encode().split() for _, t in rows]
    places = defaultdict(list)
    rank = lambda i: -1 if i is None else i
    for (i, _), w in zip(rows, words):
        for p in range(len(w) - window + 1):
            places[tuple(w[p : p + window])].append((rank(i), p))
    first = {k: min(v) for k, v in places.items()}
    result = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < (rank(i), p):
                gone[p : p + window] = [True] * window
        result.append((len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return result


def simhash(text: str | None) -> int:
    words = SPACE.findall(lower(text or ""))
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(rows: list[tuple[int, str | None]], most: int = 2) -> dict[int, tuple[str, int]]:
    prints = {i: simhash(t) for i, t in rows}
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x] = parent[parent[x]]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= most:
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (f"{prints[i]:016x}", find(i)) for i in ids}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
}


def personal(text: str | None) -> tuple[list[int], str]:
    spans = []
    for rank, (kind, (pattern, good)) in enumerate(BASE.items()):
        spans += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if good(m[0])]
    counts = [sum(s[3] == k for s in spans) for k in BASE]
    return counts, sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)))


def contamination(texts: list[str | None], items: list[tuple[object, str | None]], window: int = 13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wanted = defaultdict(set)
    for i, t in items:
        w = word.findall(lower(t or ""))
        for p in range(max(1, len(w) - window + 1) if w else 0):
            wanted[tuple(w[p : p + window])].add("" if i is None else str(i))
    sizes = {len(w) for w in wanted}
    result = []
    for t in texts:
        w = word.findall(lower(t or ""))
        hit, found = set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                if ids := wanted.get(tuple(w[p : p + size])):
                    hit.update(range(p, p + size))
                    found |= ids
        result.append((len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return result


def toxicity_scores(labelled: list[tuple[int, str]], texts: list[str | None], swapped, least=3, z=3.0, fairness=1.0) -> list[float]:
    """Scores by a dense logistic fit on the features of (toxic, text); `swapped` gives a text's counterfactuals."""

    def features(text):
        words = set(re.findall(r"[^\W\d_]+", (text or "").lower()))
        return words | {w[:n] + "*" for w in words for n in (4, 5) if len(w) > n}

    found = [features(t) for _, t in labelled]
    y = np.array([t for t, _ in labelled], float)
    counts = [Counter(f for s, t in zip(found, y) if t == k for f in s) for k in (0, 1)]
    n = [len(y) - y.sum(), y.sum()]
    sure = {}
    for f in counts[0].keys() | counts[1].keys():
        good, bad = counts[0][f], counts[1][f]
        if good + bad >= least:
            odds = math.log((bad + 0.5) / (n[1] - bad + 1)) - math.log((good + 0.5) / (n[0] - good + 1))
            sure[f] = round(abs(odds) / math.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5)), 6)
    names = sorted(f for f in sure if sure[f] > z)
    row = lambda s: np.array([f in s for f in names], float)
    x = np.array([row(s) for s in found]).reshape(len(y), -1)
    moves = [row(features(o)) - row(s) for (_, t), s in zip(labelled, found) for o in swapped(t)]
    swaps = np.array([m for m in moves if m.any()]).reshape(-1, len(names))
    prior = (y.sum() + 0.05) / (len(y) + 1)
    w, bias = np.zeros(len(names)), math.log(prior / (1 - prior))
    mean, square = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for t in range(1, 401):
        error = (1 / (1 + np.exp(-(x @ w + bias))) - y) / len(y)
        gradient = x.T @ error + 1e-4 * w + (2 * fairness * swaps.T @ (swaps @ w) / len(swaps) if len(swaps) else 0)
        step = np.append(gradient, error.sum())
        mean, square = 0.9 * mean + 0.1 * step, 0.999 * square + 0.001 * step**2
        move = 0.05 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return [1 / (1 + math.exp(-(row(features(t)) @ w + bias))) for t in texts]
