"""Suffix arrays by induced sorting.

Suffixes are classified as smaller or larger than the next one, the leftmost-smaller substrings are sorted by induction and
named, and the string of their names, at most half as long, is sorted the same way, at every size, until all names differ.

Scanning a bucket of the suffix array induces the places of the suffixes before it. Where letters are few, all entries of a
bucket that are known at one moment are taken as one batch, so a bucket costs as many steps as its longest run of one
letter; the many buckets of a string of names are scanned entry by entry.
"""

from __future__ import annotations

import numpy as np

#: Letters up to which buckets are taken in batches.
FEW_LETTERS = 1024


def types(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the next one; the last is taken as such."""
    n = len(text)
    up = np.empty(n, bool)
    step = text[1:] != text[:-1]
    rises = text[:-1] < text[1:]
    # A position without a step has the type of the next one that has.
    at = np.where(step, np.arange(n - 1), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1] if n > 1 else at
    up[n - 1] = True
    if n > 1:
        up[:-1] = np.append(rises, True)[at]
    return up


def _induce(text: np.ndarray, up: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array from the leftmost-smaller suffixes in the order `seeds`."""
    n, letters = len(text), len(sizes)
    sa = np.full(n, -1, "i4")
    starts = np.concatenate([[0], np.cumsum(sizes)])
    seed_ends = np.searchsorted(text[seeds], np.arange(letters + 1), "left")
    present = np.flatnonzero(sizes)

    def batch(entries: np.ndarray, kind: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        before = entries[entries > 0] - 1
        before = before[up[before] == kind]
        letter = text[before]
        order = np.argsort(letter, kind="stable")
        counts = np.bincount(letter, minlength=letters)
        return before[order], letter[order], counts

    head = starts[:-1].copy()
    for c in present:
        done = starts[c]
        while True:
            seeded = done == head[c]
            entries = seeds[seed_ends[c] : seed_ends[c + 1]] if seeded else sa[done : head[c]]
            done = head[c]
            if len(entries):
                got, letter, counts = batch(entries, False)
                if len(got):
                    offset = np.cumsum(counts) - counts
                    sa[head[letter] + np.arange(len(got)) - offset[letter]] = got
                    head += counts
            if seeded:
                break
    larger = head.copy()  # the larger suffixes of a bucket end here
    tail = starts[1:].copy()
    for c in present[::-1]:
        if c == 0:
            sa[0] = n - 1
            continue
        done = starts[c + 1]
        while True:
            last = done == tail[c]
            entries = sa[starts[c] : larger[c]][::-1] if last else sa[tail[c] : done][::-1]
            done = tail[c]
            if len(entries):
                got, letter, counts = batch(entries, True)
                if len(got):
                    offset = np.cumsum(counts) - counts
                    sa[tail[letter] - 1 - (np.arange(len(got)) - offset[letter])] = got
                    tail -= counts
            if last:
                break
    return sa


def _induce_each(text: np.ndarray, up: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """As `_induce`, entry by entry."""
    letter, rises = text.tolist(), up.tolist()
    ends = np.cumsum(sizes)
    sa, tail, head = [-1] * len(letter), ends.tolist(), (ends - sizes).tolist()
    for i in reversed(seeds.tolist()):
        c = letter[i]
        tail[c] -= 1
        sa[tail[c]] = i
    for k in range(len(sa)):
        i = sa[k] - 1
        if i >= 0 and not rises[i]:
            c = letter[i]
            sa[head[c]] = i
            head[c] += 1
    tail = ends.tolist()
    for k in range(len(sa) - 1, -1, -1):
        i = sa[k] - 1
        if i >= 0 and rises[i]:
            c = letter[i]
            tail[c] -= 1
            sa[tail[c]] = i
    return np.array(sa, "i4")


def suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """text: small non-negative integers; the last is 0 and occurs there only."""
    n = len(text)
    if n < 3:
        return np.argsort(text, kind="stable").astype("i4")
    up = types(text)
    left = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    sizes = np.bincount(text, minlength=letters)
    seeds = left[np.argsort(text[left], kind="stable")].astype("i4")
    induce = _induce if letters <= FEW_LETTERS else _induce_each
    sa = induce(text, up, seeds, sizes)
    if len(left) < 2:
        return sa
    # Names of the leftmost-smaller substrings, in their sorted order.
    is_left = np.zeros(n, bool)
    is_left[left] = True
    ordered = sa[is_left[sa]]
    place = np.empty(n, "i4")
    place[left] = np.arange(len(left))
    length = np.append(np.diff(left) + 1, 1)[place[ordered]]
    differs = np.ones(len(left), bool)
    differs[1:] = length[1:] != length[:-1]
    todo, at = np.flatnonzero(~differs), 0
    while len(todo):
        a, b = ordered[todo] + at, ordered[todo - 1] + at
        off = text[a] != text[b]
        differs[todo[off]] = True
        todo = todo[~off]
        at += 1
        todo = todo[length[todo] > at]
    names = np.empty(len(left), "i8")
    names[place[ordered]] = np.cumsum(differs) - 1
    if differs.all():
        order = place[ordered]
    else:
        order = suffix_array(np.append(names + 1, 0), int(differs.sum()) + 1)[1:]
    return induce(text, up, left[order].astype("i4"), sizes)


def common_prefixes(text: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Permuted: at each position, the common prefix with the suffix before it in order, up to `most`. text: bytes."""
    n = len(text)
    before = np.empty(n, "i8")
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = n
    padded = np.concatenate([text, np.zeros(most + 16, text.dtype)]).astype("u8")
    words = padded
    for shift in (1, 2, 4):
        words = words[:-shift] | (words[shift:] << np.uint64(8 * shift))
    out, here = np.zeros(n, "i4"), np.flatnonzero(before < n)
    for at in range(0, most, 8):
        x = words[here + at] ^ words[before[here] + at]
        same = x == 0
        low = x & (~x + np.uint64(1))
        out[here] += np.where(same, 8, np.log2(np.where(same, np.uint64(1), low).astype("f8")).astype("i4") // 8)
        here = here[same]
        if not len(here):
            break
    return np.minimum(out, most)
