"""Suffix arrays by induced sorting, and permuted longest-common-prefix arrays, in numpy.

The order of suffixes is induced bucket by bucket: all suffixes of a bucket that are
known at one time are handled as one array ("wave"), so the loop runs over symbols
and not over positions.
"""

from __future__ import annotations

import numpy as np

#: Above this many names, a reduced string is spelled in two digits a name, which keeps buckets few.
DIRECT_NAMES = 64
BYTE_STEPS = np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64)


def suffix_types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (the end is smaller than all)."""
    n = len(s)
    step = np.empty(n, np.int8)
    step[:-1] = np.sign(s[1:].astype(np.int64) - s[:-1])
    step[-1:] = -1
    at = np.where(step != 0, np.arange(n), n)
    decided = np.minimum.accumulate(at[::-1])[::-1]
    return step[decided] > 0


class _Inducer:
    def __init__(self, s: np.ndarray, small: np.ndarray):
        self.s, self.n = s, len(s)
        self.count = np.bincount(s)
        self.end = np.cumsum(self.count)
        self.start = self.end - self.count
        self.symbols = np.flatnonzero(self.count).tolist()
        # by position: whether the suffix one to the left exists and is larger, or smaller, than its next one
        self.after_large, self.after_small = np.zeros(self.n, bool), np.zeros(self.n, bool)
        self.after_large[1:], self.after_small[1:] = ~small[:-1], small[:-1]
        self.numbers = np.arange(self.n, dtype=_index(self.n))

    def _grouped(self, at: np.ndarray, chars: np.ndarray):
        """``at`` ordered by symbol (stable), its symbols, their counts and each symbol's first place among them."""
        order = chars.argsort(kind="stable")
        counts = np.bincount(chars, minlength=len(self.count))
        return at[order], chars[order], counts, counts.cumsum() - counts

    def run(self, lms: np.ndarray) -> np.ndarray:
        """The suffix array that follows from leftmost-smaller suffixes given in (some) order."""
        s, numbers = self.s, self.numbers
        sa = np.zeros(self.n, numbers.dtype)
        lms_sorted, _, lms_counts, lms_start = self._grouped(lms, s[lms])
        # what precedes a leftmost-smaller suffix is larger than it
        lms_before = lms_sorted - 1
        lms_chars = s[lms_before]
        head = self.start.copy()

        def to_heads(at: np.ndarray, chars: np.ndarray) -> None:
            if len(at):
                at, chars, counts, first = self._grouped(at, chars)
                sa[(head - first)[chars] + numbers[: len(at)]] = at
                head[:] += counts

        last = int(s[-1])
        sa[head[last]] = self.n - 1
        head[last] += 1
        for c in self.symbols:
            lo, a, b = self.start[c], lms_start[c], lms_start[c] + lms_counts[c]
            while lo < head[c] or a < b:
                wave = sa[lo : head[c]]
                lo = head[c]
                at = wave[self.after_large[wave]] - 1
                chars = s[at]
                if a < b and not (chars == c).any():
                    # none comes back to this bucket, so the smaller suffixes follow at once
                    at, chars, a = np.concatenate([at, lms_before[a:b]]), np.concatenate([chars, lms_chars[a:b]]), b
                to_heads(at, chars)

        tail = self.end.copy()

        def to_tails(at: np.ndarray, chars: np.ndarray) -> None:
            if len(at):
                at, chars, counts, first = self._grouped(at, chars)
                sa[(tail - 1 + first)[chars] - numbers[: len(at)]] = at
                tail[:] -= counts

        for c in reversed(self.symbols):
            hi, rest = self.end[c], head[c] > self.start[c]
            while tail[c] < hi or rest:
                wave = sa[tail[c] : hi][::-1]
                hi = tail[c]
                at = wave[self.after_small[wave]] - 1
                chars = s[at]
                if rest and not (chars == c).any():
                    large = sa[self.start[c] : head[c]][::-1]
                    large = large[self.after_small[large]] - 1
                    at, chars, rest = np.concatenate([at, large]), np.concatenate([chars, s[large]]), False
                to_tails(at, chars)
        return sa


def _index(n: int) -> type:
    return np.int32 if n < 1 << 31 else np.int64


def name_substrings(s: np.ndarray, small: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """A number for the substring from each leftmost-smaller suffix to the next one, in their order, and how many there are.

    Symbols are packed with their types into words; substrings equal so far go on to their next word.
    """
    n = len(s)
    bits = (2 * int(s.max()) + 2).bit_length()
    width = 63 // bits
    code = np.zeros(n + width + 1, np.int64)
    code[:n] = s
    code[:n] = 2 * code[:n] + small + 1
    length = np.diff(lms, append=n) + 1  # the last one meets the end, which is smaller than all
    rank, live, at = np.zeros(len(lms), np.int64), np.arange(len(lms)), 0
    while len(live):
        key, place, left = np.zeros(len(live), np.int64), lms[live] + at, length[live] - at
        for t in range(width):
            key <<= bits
            key += np.where(left > t, code[np.minimum(place + t, n)], 0)
        order = np.lexsort((key, rank[live])) if at else key.argsort(kind="stable")
        live, key = live[order], key[order]
        known, numbers = rank[live], np.arange(len(live))
        group = np.append(True, known[1:] != known[:-1])
        new = group | np.append(True, key[1:] != key[:-1])
        rank[live] = known + np.maximum.accumulate(np.where(new, numbers, 0)) - np.maximum.accumulate(np.where(group, numbers, 0))
        at += width
        live = live[~(new & np.append(new[1:], True)) & (length[live] > at)]
    taken = np.zeros(len(lms), np.int64)
    taken[rank] = 1
    return (np.cumsum(taken) - 1)[rank], int(taken.sum())


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of ``s`` (non-negative integers) in order; a prefix sorts first.

    >>> suffix_array(np.frombuffer(b"banana", np.uint8)).tolist()
    [5, 3, 1, 0, 4, 2]
    """
    n = len(s)
    if n < 2:
        return np.arange(n)
    small = suffix_types(s)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms).astype(_index(n))
    if len(lms) > 1:
        names, distinct = name_substrings(s, small, lms)
        lms = lms[_order_of_names(names, distinct, n) if distinct < len(lms) else names.argsort()]
    return _Inducer(s, small).run(lms)


def _order_of_names(names: np.ndarray, distinct: int, n: int) -> np.ndarray:
    """The order of the suffixes of ``names``.

    A name that occurs once decides every comparison it takes part in.  So only the names that
    occur again are sorted on, each run of them with the one that ends it.
    """
    again = np.bincount(names, minlength=distinct)[names] > 1
    kept = again.copy()
    kept[1:] |= again[:-1]
    kept[-1] = True
    at = np.flatnonzero(kept)
    short = names[at]
    if len(at) < len(names):
        found, short = np.unique(short, return_inverse=True)
        distinct = len(found)
    if distinct <= DIRECT_NAMES or 2 * len(short) > 0.9 * n:
        order = suffix_array(short)
    else:
        base = int(np.ceil(np.sqrt(distinct)))
        digits = np.empty(2 * len(short), np.uint16 if base < 65536 else np.int64)
        digits[0::2], digits[1::2] = np.divmod(short, base)
        sa = suffix_array(digits)
        order = sa[sa % 2 == 0] // 2
    if len(at) == len(names):
        return order
    order = at[order]
    order = np.concatenate([order[again[order]], np.flatnonzero(~again)])
    return order[names[order].argsort(kind="stable")]


def permuted_lcp(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, how many bytes its suffix shares with its predecessor in ``sa``.

    Only irreducible values (where the bytes to the left differ) are compared, eight
    bytes at a time; any other is its left neighbour's less one.
    """
    n = len(s)
    if n == 0:
        return np.empty(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    left = np.zeros(n, bool)
    left[1:] = (before[1:] > 0) & (s[:-1] == s[np.maximum(before[1:] - 1, 0)])
    left[1:] &= before[:-1] >= 0
    at = np.flatnonzero(~left)
    value = np.zeros(len(at), np.int64)
    words = np.lib.stride_tricks.sliding_window_view(np.concatenate([s, np.zeros(8, np.uint8)]), 8)[: n + 1]
    words = np.ascontiguousarray(words).view(">u8").ravel()
    live, j = np.flatnonzero(before[at] >= 0), 0
    while len(live):
        a, b = at[live] + j, before[at[live]] + j
        room = n - np.maximum(a, b)
        differ = words[np.minimum(a, n)].astype(np.uint64) ^ words[np.minimum(b, n)].astype(np.uint64)
        equal = np.where(differ == 0, 8, 7 - np.searchsorted(BYTE_STEPS, differ, side="right"))
        equal = np.minimum(equal, np.maximum(room, 0))
        value[live] += equal
        live = live[(equal == 8) & (room > 8)]
        j += 8
    out = np.zeros(n, np.int64)
    out[at] = value
    source = np.maximum.accumulate(np.where(left, -1, np.arange(n)))
    return out[source] - (np.arange(n) - source)
