"""Suffix arrays by induced sorting, and their permuted common prefixes, for one shard of text in a task.

Suffixes are classified as smaller or larger than their successor; the leftmost-smaller (LMS) substrings are sorted by
inducing, named, and, where names repeat, the string of names is sorted recursively; from the sorted LMS suffixes all
others are induced in two linear scans.  On the text itself, whose alphabet is small, a scan handles a whole bucket at a
time with numpy (each wave is the run of suffixes that the previous one put into the same bucket); the shorter strings of
names, with large alphabets, are scanned one by one.
"""

from __future__ import annotations

import numpy as np

from .textbytes import fingerprints, mix, powers


def _types(t: np.ndarray) -> np.ndarray:
    """True for S: suffix smaller than the one after it.  The last symbol is the unique smallest."""
    step = np.sign(np.diff(t))
    at = np.where(step != 0, np.arange(len(step)), len(step))
    following = np.minimum.accumulate(at[::-1])[::-1] if len(step) else at
    return np.append(np.append(step, 1)[following] > 0, True)


def _induce(t: np.ndarray, is_s: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """All suffixes in order, from the LMS suffixes in order (or, given in any order, the LMS substrings sorted)."""
    larger: list[list[np.ndarray]] = [[] for _ in range(size)]
    smaller: list[list[np.ndarray]] = [[] for _ in range(size)]
    none = np.zeros(0, np.int64)

    def deal(found: np.ndarray, heads: np.ndarray, to: list[list[np.ndarray]], own: int) -> np.ndarray:
        """Appends each suffix to the bucket of its first symbol; those of bucket `own` are returned."""
        if not len(found):
            return none
        order = np.argsort(heads, kind="stable")
        found, heads = found[order], heads[order]
        cuts = np.flatnonzero(np.diff(heads)) + 1
        mine = none
        for part, c in zip(np.split(found, cuts), heads[np.append(0, cuts)].tolist()):
            to[c].append(part)
            if c == own:
                mine = part
        return mine

    heads = t[lms]
    order = np.argsort(heads, kind="stable")
    ends = np.searchsorted(heads[order], np.arange(size + 1))
    by_head = lms[order]
    for c in range(size):
        wave = np.concatenate(larger[c]) if larger[c] else none
        while len(wave):
            before = wave[wave > 0] - 1
            before = before[~is_s[before]]
            wave = deal(before, t[before], larger, c)
        before = by_head[ends[c] : ends[c + 1]]
        before = before[before > 0] - 1
        deal(before[~is_s[before]], t[before[~is_s[before]]], larger, -1)
    out = []
    for c in range(size - 1, -1, -1):
        if c == 0:
            smaller[0] = [np.array([len(t) - 1])]
        wave = np.concatenate(smaller[c]) if smaller[c] else none
        while len(wave):
            before = wave[wave > 0] - 1
            before = before[is_s[before]]
            wave = deal(before, t[before], smaller, c)
        above = np.concatenate(larger[c])[::-1] if larger[c] else none
        before = above[above > 0] - 1
        deal(before[is_s[before]], t[before[is_s[before]]], smaller, -1)
        if smaller[c]:
            out.append(np.concatenate(smaller[c]))
        out.append(above)
    return np.concatenate(out)[::-1]


def _induce_each(t: np.ndarray, is_s: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """As _induce(), one suffix after another: for large alphabets, whose buckets hold few."""
    n, symbols, smaller = len(t), t.tolist(), is_s.tolist()
    after = np.cumsum(np.bincount(t, minlength=size))
    sa, tail = [0] * n, after.tolist()
    for i in reversed(lms.tolist()):
        c = symbols[i]
        tail[c] -= 1
        sa[tail[c]] = i
    head = (after - np.bincount(t, minlength=size)).tolist()
    for k in range(n):  # an empty place holds 0, which has no suffix before it
        j = sa[k] - 1
        if j >= 0 and not smaller[j]:
            c = symbols[j]
            sa[head[c]] = j
            head[c] += 1
    tail = after.tolist()
    for k in range(n - 1, -1, -1):
        j = sa[k] - 1
        if j >= 0 and smaller[j]:
            c = symbols[j]
            tail[c] -= 1
            sa[tail[c]] = j
    sa[0] = n - 1
    return np.array(sa)


#: Symbols up to which a scan goes by whole buckets.
SMALL_ALPHABET = 1024


def _sums(t: np.ndarray) -> np.ndarray:
    values = mix(np.arange(int(t.max()) + 1, dtype=np.uint64) + np.uint64(0x2545F491))
    out = np.zeros(len(t) + 1, np.uint64)
    np.cumsum(values[t] * powers(len(t)), out=out[1:])
    return out


def suffix_array(t: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """t: non-negative integers of which the last, 0, is unique and smallest."""
    sums = _sums(t) if sums is None else sums
    size, is_s = int(t.max()) + 1, _types(t)
    induce = _induce if size <= SMALL_ALPHABET else _induce_each
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if not len(lms):
        return np.zeros(1, np.int64)  # nothing but the last symbol
    mark = np.full(len(t), -1)
    mark[lms] = np.arange(len(lms))
    order = mark[induce(t, is_s, lms, size)]
    order = order[order >= 0]
    end = np.append(lms[1:] + 1, len(t))
    pieces = fingerprints(sums, lms[order], end[order])
    name = np.cumsum(np.append(0, pieces[1:] != pieces[:-1]))
    if name[-1] + 1 < len(lms):
        names = np.empty(len(lms), np.int64)
        names[order] = name
        order = suffix_array(names)
    return induce(t, is_s, lms[order], size)


def permuted_lcp(t: np.ndarray, sa: np.ndarray, most: int, sums: np.ndarray | None = None) -> np.ndarray:
    """For each position, the length (at most about `most`) of the prefix that its suffix shares with the one before it in
    the suffix array.  Where the preceding symbols are equal the value is one less than the previous position's; only the
    others are measured, by halving over prefix sums."""
    n = len(t)
    sums = _sums(t) if sums is None else sums
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    known = (at > 0) & (before > 0) & (t[at - 1] == t[np.maximum(before - 1, 0)])
    p = np.flatnonzero(~known & (before >= 0))
    q = before[p]
    got = np.zeros(len(p), np.int64)
    step = 1 << max(0, int(most).bit_length())
    inverse = powers(n + 1, True)
    while step:
        room = np.maximum(p, q) + got + step <= n
        i, j = (p + got)[room], (q + got)[room]
        same = (sums[i + step] - sums[i]) * inverse[i] == (sums[j + step] - sums[j]) * inverse[j]
        got[np.flatnonzero(room)[same]] += step
        step >>= 1
    out = np.zeros(n, np.int64)
    out[p] = got
    anchor = np.maximum.accumulate(np.where(known, 0, at))
    return np.maximum(0, out[anchor] - (at - anchor))


def repeated(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, a flag for each of its substrings of `length` bytes: does it also start anywhere else in texts?"""
    gap = np.ones(1, np.int64)
    parts = []
    for x in texts:
        parts += [np.frombuffer(x, np.uint8).astype(np.int64) + 2, gap]
    t = np.concatenate([*parts, np.zeros(1, np.int64)])
    sums = _sums(t)
    sa = suffix_array(t, sums)
    lcp = permuted_lcp(t, sa, length * 2, sums)
    twice = lcp >= length
    twice[sa[:-1]] |= lcp[sa[1:]] >= length
    out, at = [], 0
    for x in texts:
        out.append(twice[at : at + max(0, len(x) - length + 1)])
        at += len(x) + 1
    return out
