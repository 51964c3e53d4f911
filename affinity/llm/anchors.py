"""Content-defined anchors that send equal byte strings to the same place.

A window is ``WINDOW`` bytes of one document; its anchor is its least-hashed
``GRAM`` bytes (the leftmost of equals), so equal windows have equal anchors at
equal offsets.  Consecutive windows with one anchor form a range; its context
is all bytes of those windows.  About one position in 27 is an anchor.
"""

from __future__ import annotations

import numpy as np

from affinity.llm import words

U64 = np.uint64
WINDOW, GRAM = 100, 48
_R = U64(0x9E3779B97F4A7C15 | 1)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd multiplier and of its inverse modulo 2**64, at least n + 1 of them."""
    if not _POWERS or len(_POWERS[0]) <= n:
        inverse = U64(pow(int(_R), -1, 1 << 64))
        _POWERS[:] = [words.powers(n + 1), _chain(inverse, n + 1)]
    return _POWERS[0], _POWERS[1]


def _chain(base: np.ndarray, n: int) -> np.ndarray:
    out = np.empty(n, U64)
    out[0] = 1
    have = 1
    while have < n:
        take = min(have, n - have)
        out[have:have + take] = out[:take] * (out[have - 1:have] * base)
        have += take
    return out


class Ranges:
    """Anchor ranges of a buffer of documents: arrays doc, first and last window start, anchor offset in the first window, key, context."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray):
        n = len(buf)
        self.doc = self.first = self.last = self.at = np.empty(0, np.int64)
        self.key = self.context = np.empty(0, U64)
        if n < WINDOW:
            return
        power, inverse = _powers(n)
        h = buf.astype(U64) + U64(1)
        prefix = np.concatenate([np.zeros(1, U64), np.cumsum(h * power[:n], dtype=U64)])
        gram = words.mix((prefix[GRAM:] - prefix[:-GRAM]) * inverse[:n - GRAM + 1])
        low = U64((1 << max(1, int(n).bit_length())) - 1)
        v = (gram & ~low) | np.arange(len(gram), dtype=U64)
        span, step, least = WINDOW - GRAM + 1, 1, v
        while 2 * step <= span:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        least = np.minimum(least[:len(least) - (span - step)], least[span - step:]) if span > step else least
        anchor = (least & low).astype(np.int64)  # of the window that starts there
        # Windows that lie within one document (without the newline behind it).
        ok = np.zeros(n + 1, np.int32)
        size = np.diff(starts) - 1
        has = size >= WINDOW
        np.add.at(ok, starts[:-1][has], 1)
        np.add.at(ok, (starts[:-1] + size - WINDOW + 1)[has], -1)
        s = np.flatnonzero(np.cumsum(ok)[:len(anchor)] > 0)
        if not len(s):
            return
        a = anchor[s]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (s[1:] != s[:-1] + 1)])
        at = np.flatnonzero(new)
        lo = s[at]
        hi = s[np.concatenate([at[1:] - 1, [len(s) - 1]])]
        p = a[at]
        doc = np.searchsorted(starts, lo, "right") - 1
        size = (hi - lo + WINDOW).astype(U64)
        own = (prefix[hi + WINDOW] - prefix[lo]) * inverse[lo]
        self.context = words.mix(own + words.mix(size * U64(1024) + (p - lo).astype(U64)))
        self.key = words.mix(gram[p] + U64(GRAM))
        self.doc, self.first, self.last, self.at = doc, lo - starts[doc], hi - starts[doc], p - lo
