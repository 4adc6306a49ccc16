"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

The scans of induced sorting run bucket by bucket: all entries of a bucket
that are known are handled in one vector step, and a step is repeated while
entries fall into the bucket that is being read.
"""

from __future__ import annotations

import numpy as np


def _classify(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (S type)."""
    n = len(t)
    step = np.sign(np.diff(t.astype(np.int64)))                 # >0: S, <0: L, 0: as the next
    at = np.where(step != 0, np.arange(n - 1), n)
    nxt = np.minimum.accumulate(at[::-1])[::-1]
    s = np.ones(n, bool)
    s[:-1] = np.where(nxt < n, step[np.minimum(nxt, n - 2)] > 0, False)
    return s


def _place(sa: np.ndarray, ptr: np.ndarray, t: np.ndarray, js: np.ndarray, forward: bool) -> np.ndarray:
    """Append suffixes ``js`` (in order) to their buckets; the characters met."""
    c = t[js]
    order = np.argsort(c, kind="stable")
    js, c = js[order], c[order]
    first = np.concatenate(([0], np.flatnonzero(c[1:] != c[:-1]) + 1))
    chars = c[first]
    counts = np.diff(np.append(first, len(c)))
    nth = np.arange(len(c)) - np.repeat(first, counts)
    if forward:
        sa[np.repeat(ptr[chars], counts) + nth] = js
        ptr[chars] += counts
    else:
        sa[np.repeat(ptr[chars], counts) - 1 - nth] = js
        ptr[chars] -= counts
    return chars


def _induce(t: np.ndarray, s_type: np.ndarray, heads: np.ndarray, ends: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Suffix array induced from the order of the LMS suffixes ``lms``."""
    sa = np.full(len(t), -1, np.int64)
    tail = ends.copy()
    _place(sa, tail, t, lms[::-1], False)
    lms_from = tail.copy()                                       # LMS entries of a bucket: [lms_from, end)
    head = heads.copy()
    used = np.flatnonzero(ends > heads)
    for c in used:                                               # L types, left to right
        done = heads[c]
        while done < head[c]:
            js = sa[done:head[c]] - 1
            done = head[c]
            js = js[js >= 0]
            js = js[~s_type[js]]
            if len(js):
                _place(sa, head, t, js, True)
        js = sa[lms_from[c]:ends[c]] - 1
        js = js[js >= 0]
        js = js[~s_type[js]]
        if len(js):
            _place(sa, head, t, js, True)
    tail = ends.copy()
    for c in used[::-1]:                                         # S types, right to left
        done = ends[c]
        while done > tail[c]:
            js = sa[tail[c]:done][::-1] - 1
            done = tail[c]
            js = js[js >= 0]
            js = js[s_type[js]]
            if len(js):
                _place(sa, tail, t, js, False)
        js = sa[heads[c]:head[c]][::-1] - 1
        js = js[js >= 0]
        js = js[s_type[js]]
        if len(js):
            _place(sa, tail, t, js, False)
    return sa


def _names(t: np.ndarray, lms: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Names of LMS substrings given in sorted order: equal ones share a name."""
    differ = np.ones(len(lms), bool)
    differ[1:] = length[1:] != length[:-1]
    at, k = np.flatnonzero(~differ), 0
    while len(at):
        unequal = t[lms[at] + k] != t[lms[at - 1] + k]
        differ[at[unequal]] = True
        k += 1
        at = at[~unequal & (length[at] > k)]
    return np.cumsum(differ) - 1


def _order(names: np.ndarray) -> np.ndarray:
    """Suffix order of the reduced string, a third as long: rank doubling, as
    its alphabet is nearly as large as itself."""
    rank, k, n = names.astype(np.int64), 1, len(names)
    while True:
        after = np.zeros(n, np.int64)
        after[:-k] = rank[k:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        k *= 2
        if rank[order[-1]] == n - 1 or k >= n:
            return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of ``text`` (small non-negative integers)."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    t = np.zeros(n + 1, np.int16)
    t[:n] = text
    t[:n] += 1                                                   # 0 is the sentinel
    s_type = _classify(t)
    ends = np.cumsum(np.bincount(t))
    heads = np.concatenate(([0], ends[:-1]))
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    sa = _induce(t, s_type, heads, ends, lms)                    # sorts the LMS substrings
    is_lms = np.zeros(n + 1, bool)
    is_lms[lms] = True
    by_substring = sa[is_lms[sa]]
    length = np.zeros(n + 1, np.int64)
    length[lms] = np.append(np.diff(lms), 0) + 1                 # both ends included
    names = _names(t, by_substring, length[by_substring])
    if names[-1] < len(lms) - 1:                                 # names repeat: sort the reduced string
        of = np.empty(n + 1, np.int64)
        of[by_substring] = names
        by_substring = lms[_order(of[lms])]
    return _induce(t, s_type, heads, ends, by_substring)[1:]


def permuted_lcp(text: bytes, sa: np.ndarray, most: int) -> np.ndarray:
    """For every text position, the common prefix of its suffix with the one
    before it in the suffix array, counted up to ``most``."""
    n = len(text)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    # byte i's eight bytes as one word, for every i
    b = np.frombuffer(text + bytes(most + 8), np.uint8)
    word = np.zeros(n + most, np.uint64)
    for j in range(8):
        word |= b[j:j + n + most].astype(np.uint64) << np.uint64(8 * j)
    plcp = np.zeros(n, np.int64)
    at, k = np.flatnonzero(phi >= 0), 0
    while len(at) and k < most:
        x = word[at + k] ^ word[phi[at] + k]
        stop = x != 0
        if stop.any():
            low = x[stop] & (~x[stop] + np.uint64(1))            # lowest differing bit
            bits = np.log2(low.astype(np.float64)).astype(np.int64)
            plcp[at[stop]] = k + bits // 8
            at = at[~stop]
        k += 8
    plcp[at] = most
    return np.minimum(plcp, most)


def repeated_windows(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment, the starts of its ``length``-byte windows that occur
    again, in any of the segments."""
    text = b"\0".join(segments) + b"\0"
    sizes = np.array([len(s) for s in segments])
    start = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    arr = np.frombuffer(text, np.uint8).astype(np.int16) + 1
    arr[start + sizes] = 0                                       # separators sort below every byte
    sa = suffix_array(arr)
    # the separators are all alike: a common prefix counts up to the end of its segment
    room = np.repeat(start + sizes, sizes + 1) - np.arange(len(text))
    plcp = permuted_lcp(text, sa, length)
    phi = np.full(len(text), -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    same = (plcp >= length) & (room >= length)
    same &= np.where(phi >= 0, room[np.maximum(phi, 0)], 0) >= length
    hit = same.copy()
    hit[phi[same]] = True
    return [np.flatnonzero(hit[a:a + n]) for a, n in zip(start, sizes)]
