"""Simple-8b: unsigned integers in 64-bit words, 4 bits of selector and 60 of data."""

from __future__ import annotations

import numpy as np

# Fixed values: (integers in a word, bits of each) by selector. Selector 0 is a
# run of zeros; selector 1 is the escape: the next word is one integer as it is.
LAYOUT = [
    (240, 0), (1, 64), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
]
ESCAPE = 1
_U = np.uint64


_SHORT = np.array([v.bit_length() for v in range(1 << 16)], dtype=np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bit length of each value."""
    if values.max() < len(_SHORT):
        return _SHORT[values]
    wide = np.zeros(len(values), dtype=np.uint8)
    rest = values.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = rest >= (_U(1) << _U(step))
        wide[big] += step
        rest[big] >>= _U(step)
    return wide + (rest > 0)


_AFTER_MISFITS = np.array([0, *range(2, len(LAYOUT)), ESCAPE], dtype=np.uint8)


def _selectors(widths: np.ndarray) -> np.ndarray:
    """For each place the selector that packs most integers from there on.

    Later selectors have fewer and wider fields, so one fits wherever an earlier
    one does: counting those that do not fit gives the first that does.
    """
    n = len(widths)
    # widest of the next `count` integers; past the end there is nothing to fit
    last, widest = 1, np.concatenate((widths, np.zeros(240, dtype=np.uint8)))
    misfits = np.zeros(n, dtype=np.uint8)
    for count, bits in sorted([*(x for x in LAYOUT if x[1] != 64), (120, None)]):
        if count > last:  # two windows of the last size cover one of this size
            widest = np.maximum(widest[: len(widest) - count + last], widest[count - last :])
            last = count
        if bits is not None:
            misfits += widest[:n] > bits
    return _AFTER_MISFITS[misfits]


def encode(values: np.ndarray) -> np.ndarray:
    """Words of ``values``; each word takes as many of the next integers as fit."""
    values = np.asarray(values, dtype=_U)
    n = len(values)
    if not n:
        return np.zeros(0, dtype="<u8")
    choice = _selectors(_widths(values))
    step = np.array([c for c, _ in LAYOUT])[choice].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts)
    chosen = choice[starts]
    first = np.arange(len(starts)) + np.concatenate(([0], np.cumsum(chosen == ESCAPE)[:-1]))
    words = np.zeros(len(starts) + int((chosen == ESCAPE).sum()), dtype="<u8")
    padded = np.concatenate((values, np.zeros(240, dtype=_U)))
    for selector, (count, bits) in enumerate(LAYOUT):
        mine = chosen == selector
        if not mine.any():
            continue
        head = _U(selector) << _U(60)
        if selector == ESCAPE:
            words[first[mine]] = head
            words[first[mine] + 1] = values[starts[mine]]
            continue
        if not bits:
            words[first[mine]] = head
            continue
        at = starts[mine]
        packed = np.full(len(at), head)
        for k in range(count):
            packed |= padded[at + k] << _U(bits * k)
        words[first[mine]] = packed
    return words


def decode(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` integers of ``words``, all words of a selector at once."""
    words = np.asarray(words, dtype=_U)
    selectors = (words >> _U(60)).astype(np.int64)
    raw = np.zeros(len(words), dtype=bool)
    for at in np.flatnonzero(selectors == ESCAPE):  # few: ids are far below 2**60
        if not raw[at]:
            raw[at + 1] = True
    counts = np.array([c for c, _ in LAYOUT])[selectors]
    counts[raw] = 0
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), dtype=_U)
    for selector, (count, bits) in enumerate(LAYOUT):
        mine = np.flatnonzero((selectors == selector) & ~raw)
        if not len(mine) or not bits:
            continue
        if selector == ESCAPE:
            out[starts[mine]] = words[mine + 1]
            continue
        own, at, mask = words[mine], starts[mine], _U((1 << bits) - 1)
        for k in range(count):
            out[at + k] = own >> _U(bits * k) & mask
    return out[:n]
