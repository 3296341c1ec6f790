"""Plain versions of the corpus operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return [w for w in SPACE.split(text or "") if w]


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text: str | None, size: int = 3) -> int:
    w = words(ascii_lower(text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n: int, pairs) -> list[int]:
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def near_groups(prints: list[int], bits: int = 3) -> list[int]:
    return roots(len(prints), (
        (i, j) for i in range(len(prints)) for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= bits
    ))


def measures(text: str | None) -> dict:
    t, w = text or "", words(text)
    lines = [x for x in t.split("\n") if words(x)]
    places = defaultdict(list)
    for i in range(len(w) - 7):
        places[tuple(w[i:i + 8])].append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_runs": sum(a == b for a, b in zip(w, w[1:])), "n_upper": sum(c.isupper() for c in t),
        "n_letters": sum(c.isalpha() for c in t),
    }


def failed(m: dict) -> list[str]:
    n = m["n_words"]
    rules = {
        "few_words": n < 20, "repeated_windows": 100 * m["n_repeat_words"] > 30 * n, "symbols": 10 * m["n_symbols"] > n,
        "duplicate_lines": 2 * m["n_dup_lines"] > m["n_lines"],
        "word_length": not 2 * n <= m["word_chars"] <= 15 * n,
        "shouting": m["n_letters"] > 0 and 2 * m["n_upper"] > m["n_letters"], "word_runs": n > 0 and 5 * m["n_runs"] > n,
    }
    return [r for r, bad in rules.items() if bad]


def dedup_lines(rows: list[tuple], least: int = 10, most: int = 1) -> list[tuple]:
    """(doc_id, lines kept, number of lines) per (doc_id, text); a null doc_id comes last."""
    def key(line):
        return ascii_lower(line.strip(" \t\n\x0b\f\r"))

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(float("inf") if doc is None else doc)
    out = []
    for doc, text in rows:
        mine = float("inf") if doc is None else doc
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or len(holders[key(x)]) <= most or min(holders[key(x)]) == mine]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def shingles(text: str | None, size: int = 5) -> list[tuple]:
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(w[i:i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [tuple(w)] if w else []


def best_window(doc: list[tuple], item: list[tuple]) -> float:
    """Largest weighted Jaccard similarity of the item and a window of its size."""
    width, best, want = min(len(item), len(doc)), 0.0, Counter(item)
    for s in range(len(doc) - width + 1):
        both = sum((Counter(doc[s:s + width]) & want).values())
        best = max(best, both / (width + len(item) - both))
    return best


def leaks(docs: list[tuple], items: list[tuple], threshold: float = 0.8) -> set[tuple]:
    prepared = [(i, shingles(t)) for i, t in items]
    out = set()
    for doc, text in docs:
        have = shingles(text)
        seen = set(have)
        out |= {(doc, i) for i, want in prepared if want and seen & set(want) and best_window(have, want) >= threshold}
    return out
