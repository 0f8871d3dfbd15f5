"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

The steps are those of induced sorting: classify suffixes as smaller (S) or larger (L) than their successor, sort
the leftmost-smaller substrings by one round of inducing, name them, sort the string of names (by the same
method, recursively), and induce the order of all suffixes from it. Scanning a bucket is done for all its
entries at once: what they induce into later buckets is filed by a stable sort, and what falls into the same
bucket is the next front to scan, so the number of numpy calls follows the alphabet and the longest run.

That pays while the alphabet is small. A string of more than ``ALPHABET`` different names is sorted by doubling
its ranks instead; there the time is n log n, for a string a third as long or less.
"""

from __future__ import annotations

import numpy as np

ALPHABET = 2048


def classify(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last suffix is larger than the empty one."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1])
    step[-1] = -1
    decided = np.where(step != 0, np.arange(n), n - 1)
    return step[np.minimum.accumulate(decided[::-1])[::-1]] > 0


def leftmost_smaller(smaller: np.ndarray) -> np.ndarray:
    return np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


def _filed(found: np.ndarray, chars: np.ndarray, out: np.ndarray, free: np.ndarray, backwards: bool) -> None:
    """Put positions at the free end of the bucket of their character, in order."""
    order = np.argsort(chars, kind="stable")
    chars, found = chars[order], found[order]
    first = np.flatnonzero(np.concatenate(([True], chars[1:] != chars[:-1])))
    counts = np.diff(np.append(first, len(chars)))
    place = np.arange(len(chars)) - np.repeat(first, counts)
    heads = chars[first]
    start = np.repeat(free[heads], counts)
    if backwards:
        out[start - place] = found
        free[heads] -= counts
    else:
        out[start + place] = found
        free[heads] += counts


def induce(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, alphabet: int) -> np.ndarray:
    """All suffixes in order, given the leftmost-smaller ones in order (or in any order within a bucket)."""
    n = len(text)
    size = np.bincount(text, minlength=alphabet)
    ends = np.cumsum(size)
    larger_size = np.bincount(text[~smaller], minlength=alphabet)
    begin = ends - size
    middle = begin + larger_size
    out = np.empty(n, np.int64)
    seed_chars = text[seeds]
    by_char = np.argsort(seed_chars, kind="stable")
    seeds = seeds[by_char]
    seed_ends = np.cumsum(np.bincount(seed_chars, minlength=alphabet))
    used = np.flatnonzero(size)

    free = begin.copy()
    out[free[text[n - 1]]] = n - 1  # the empty suffix induces the last one
    free[text[n - 1]] += 1
    for c in used.tolist():
        at, front_seeds = begin[c], seeds[seed_ends[c - 1] if c else 0 : seed_ends[c]]
        while at < free[c] or front_seeds is not None:
            if at < free[c]:
                front = out[at : free[c]]
                at = free[c]
            else:
                front, front_seeds = front_seeds, None
            before = front[front > 0] - 1
            before = before[~smaller[before]]
            if len(before):
                _filed(before, text[before], out, free, False)
    free = ends - 1
    for c in used[::-1].tolist():
        at, larger = ends[c] - 1, out[begin[c] : middle[c]][::-1]
        while at > free[c] or larger is not None:
            if at > free[c]:
                front = out[free[c] + 1 : at + 1][::-1]
                at = free[c]
            else:
                front, larger = larger, None
            before = front[front > 0] - 1
            before = before[smaller[before]]
            if len(before):
                _filed(before, text[before], out, free, True)
    return out


def _names(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, in_order: np.ndarray) -> tuple[np.ndarray, int]:
    """A rank for each leftmost-smaller substring (in text order), equal for equal substrings."""
    n = len(text)
    length = np.empty(n + 1, np.int64)
    length[lms] = np.diff(np.append(lms, n)) + 1
    a, b = in_order[:-1], in_order[1:]
    same = length[a] == length[b]
    same &= (a + length[a] <= n) & (b + length[b] <= n)  # the last one ends in the empty suffix, like no other
    alive = np.flatnonzero(same)
    step = 0
    while len(alive):
        x, y = a[alive] + step, b[alive] + step
        equal = (text[x] == text[y]) & (smaller[x] == smaller[y])
        same[alive[~equal]] = False
        step += 1
        alive = alive[equal]
        alive = alive[length[a[alive]] > step]
    rank = np.concatenate(([0], np.cumsum(~same)))
    names = np.empty(n, np.int64)
    names[in_order] = rank
    return names[lms], int(rank[-1]) + 1


def _doubled(names: np.ndarray, depth: int | None) -> np.ndarray:
    """Suffixes of a string of ranks in order, by doubling; at least by their first ``depth`` ranks."""
    n, k = len(names), 1
    rank = names.copy()
    order = np.argsort(rank, kind="stable")
    while True:
        top = int(rank.max()) + 1
        if top == n or (depth is not None and k >= depth):
            return order
        second = np.zeros(n, np.int64)
        second[:-k] = rank[k:] + 1
        key = rank * (top + 1) + second
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        k *= 2


def suffix_array(text: np.ndarray, alphabet: int, depth: int | None = None) -> np.ndarray:
    """The suffixes of ``text`` (numbers below ``alphabet``) in order; with ``depth``, by that many characters at least."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    smaller = classify(text)
    lms = leftmost_smaller(smaller)
    if len(lms) < 2:
        return induce(text, smaller, lms, alphabet)
    rough = induce(text, smaller, lms, alphabet)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    in_order = rough[is_lms[rough]]
    names, count = _names(text, smaller, lms, in_order)
    if count < len(lms):
        shorter = None if depth is None else depth // 2 + 1  # a leftmost-smaller substring moves on by 2 or more
        if count <= ALPHABET:
            in_order = lms[suffix_array(names, count, shorter)]
        else:
            in_order = lms[_doubled(names, shorter)]
    return induce(text, smaller, in_order, alphabet)


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """For each suffix in ``order``, by place, what it shares with the one before, in bytes up to ``cap``; 0 for the first.

    With ``before[order[i]] = order[i - 1]`` this is the permuted common-prefix array, read in order. ``text`` is bytes
    and needs ``cap + 8`` spare bytes behind the last suffix.
    """
    shared = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return shared
    wide = np.lib.stride_tricks.sliding_window_view(text, 8)
    a, b = order[:-1], order[1:]
    alive = np.arange(len(a))
    for step in range(0, cap, 8):
        x = wide[a[alive] + step].view("<u8").ravel() ^ wide[b[alive] + step].view("<u8").ravel()
        differ = x != 0
        if differ.any():
            low = x[differ] & (~x[differ] + np.uint64(1))
            shared[alive[differ] + 1] += np.floor(np.log2(low.astype(np.float64))).astype(np.int64) // 8
        alive = alive[~differ]
        shared[alive + 1] += 8
    return np.minimum(shared, cap)
