"""Plain Python versions of the operators' definitions, and awkward rows."""

from __future__ import annotations

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: NULLs in every column, empty, blank, repeated rows, ids that repeat, odd blanks, one long text
ODD = [
    (1, "a b c d e f g", "en", "s1", 13), (1, "a b c d e f g", "en", "s1", 13),
    (2, "A B C\tD\x0bE F\nG", None, None, None), (3, None, "en", "s2", 0), (4, "", "en", "s2", 0),
    (5, " \t\n", "de", "s1", 3), (None, "a b c d e f g", "en", "s1", 13), (6, "one", None, "s3", 3),
    (7, "un\x1cié x\x85y ſ idiot! you idiot", "fr", "s3", 20),
    (8, " ".join(f"w{i % 977}" for i in range(30_000)), "en", "s1", 9),
    (9, "x y", "en", "s2", 3), (9, "other text here", "en", "s2", 15), (None, None, None, None, None),
]


def words(text: str | None, lower: bool = False) -> list[str]:
    return WORD.findall((text or "").translate(FOLD) if lower else text or "")


def shingles(text: str | None) -> set:
    w = words(text, lower=True)
    return {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()


def classes(sets: dict[int, set], percent: int = 85) -> dict[int, int]:
    """Smallest id reachable by links, by comparing every pair that shares a shingle."""
    holds, shared = defaultdict(list), defaultdict(int)
    for i in sorted(sets):
        for s in sets[i]:
            holds[s].append(i)
    for ids in holds.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                shared[a, b] += 1
    root = {i: i for i in sets}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: find(i) for i in sets}
