"""Suffix arrays of integer sequences by prefix doubling on packed keys."""

from __future__ import annotations

import numpy as np

#: Ranks and positions are packed three to a 64-bit key, so a sequence has fewer symbols than this.
LONGEST = (1 << 21) - 2
_BITS = np.uint64(21)
_MASK = np.uint64((1 << 21) - 1)


def _refine(sa: np.ndarray, rank: np.ndarray, open_: np.ndarray, shift: int) -> np.ndarray:
    """Sort the open positions, which share their rank with others, by the rank ``shift`` further on, equal ones by
    position. ``rank`` is the slot of a group's first suffix. Returns the positions that are still open."""
    n = np.uint64(len(rank))
    ahead = open_ + np.uint64(shift)
    inside = ahead < n
    second = np.zeros(len(open_), np.uint64)
    second[inside] = rank[ahead[inside]] + np.uint64(1)
    keys = (rank[open_] << np.uint64(42)) | (second << _BITS) | open_
    keys.sort()
    place = np.arange(len(keys), dtype=np.uint64)
    head = keys >> np.uint64(42)
    first = np.empty(len(keys), bool)
    first[0] = True
    np.not_equal(head[1:], head[:-1], out=first[1:])
    slots = head + place - np.maximum.accumulate(np.where(first, place, np.uint64(0)))
    pairs = keys >> _BITS
    new = np.empty(len(keys), bool)
    new[0] = True
    np.not_equal(pairs[1:], pairs[:-1], out=new[1:])
    positions = keys & _MASK
    sa[slots] = positions
    rank[positions] = np.maximum.accumulate(np.where(new, slots, np.uint64(0)))
    alone = new & np.r_[new[1:], True]
    return positions[~alone]


def suffix_array(symbols: np.ndarray, bits: int, depth: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank): suffixes in order, and for each position the slot of the first suffix that equals it.

    ``symbols`` are integers of ``bits`` bits (up to 21). With ``depth`` only the first ``depth`` symbols of a suffix count; equal
    suffixes stand in order of position. A suffix that ends is smaller than one that goes on. Without ``depth`` all
    suffixes differ and ``rank`` is the inverse of the suffix array.
    """
    n = len(symbols)
    if n > LONGEST:
        raise ValueError(f"a sequence has at most {LONGEST} symbols")
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # One bit more, so that the end of the sequence (0) is below every symbol.
    width = bits + 1
    packed = max(1, 42 // width)
    if depth is not None:
        packed = min(packed, depth)
    padded = np.zeros(n + packed, np.uint64)
    padded[:n] = symbols
    padded[:n] += np.uint64(1)
    keys = np.zeros(n, np.uint64)
    for i in range(packed):
        keys = (keys << np.uint64(width)) | padded[i : i + n]
    keys = (keys << _BITS) | np.arange(n, dtype=np.uint64)
    keys.sort()
    sa = keys & _MASK
    keys >>= _BITS
    new = np.r_[True, keys[1:] != keys[:-1]]
    place = np.arange(n, dtype=np.uint64)
    rank = np.empty(n, np.uint64)
    rank[sa] = np.maximum.accumulate(np.where(new, place, np.uint64(0)))
    open_ = sa[~(new & np.r_[new[1:], True])]
    known = packed
    while len(open_) and (depth is None or known < depth):
        step = known if depth is None else min(known, depth - known)
        open_ = _refine(sa, rank, open_, step)
        known += step
    return sa, rank


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest earlier place with a smaller value, or -1.

    All places jump at once: a place whose candidate is not smaller takes over that candidate's candidate, since
    everything between the two is not smaller either.
    """
    place = np.arange(len(values)) - 1
    todo = np.arange(len(values))
    while True:
        now = place[todo]
        todo = todo[(now >= 0) & (values[now] >= values[todo])]
        if not len(todo):
            return place
        place[todo] = place[place[todo]]
