"""Plain versions of the operators over small tables, for comparison."""

from __future__ import annotations

import hashlib
import re
import unicodedata

BLANK = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def without_repeats(rows, width=20):
    """``doc_id -> (n_words, kept words)`` for rows with distinct ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        own, gone = words(text), set()
        for start in range(len(own) - width + 1):
            window = tuple(own[start : start + width])
            if window in seen:
                gone.update(range(start, start + width))
            seen.add(window)
        out[doc_id] = (len(own), [w for i, w in enumerate(own) if i not in gone])
    return out


def shingle_set(text, size):
    own = words((text or "").translate(UPPER))
    if not own:
        return frozenset()
    if len(own) < size:
        return frozenset([tuple(own)])
    return frozenset(tuple(own[i : i + size]) for i in range(len(own) - size + 1))


def near_components(rows, size, percent):
    """``doc_id -> (n_shingles, component_id)``."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def copies(rows):
    """``doc_id -> keep_id`` by normalised text."""
    first = {}
    for doc_id, text in sorted(rows):
        first.setdefault(BLANK.sub(" ", text or ""), doc_id)
    return {i: first[BLANK.sub(" ", t or "")] for i, t in rows}


def has_letter(text):
    return any(unicodedata.category(c).startswith("L") for c in text or "")
