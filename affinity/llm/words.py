"""Vectorised word tables over the UTF-8 bytes of a batch of texts.

A batch is one byte buffer with document boundaries; words, their 64-bit
hashes and the hashes of word windows are found by whole-array numpy steps, so
the cost per word does not depend on how long a text is.  Helpers only: every
caller runs them inside a Spark task on one Arrow batch.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_R = U64(0x9E3779B97F4A7C15 | 1)
_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * _MIX1
    x = x ^ (x >> U64(27))
    x = x * _MIX2
    return x ^ (x >> U64(31))


def powers(n: int) -> np.ndarray:
    """The first n powers of the odd multiplier, modulo 2**64."""
    out = np.empty(n, U64)
    if n:
        out[0] = U64(1)
        have = 1
        while have < n:
            take = min(have, n - have)
            out[have:have + take] = out[:take] * (out[have - 1:have] * _R)
            have += take
    return out


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)


def joined(texts) -> tuple[np.ndarray, np.ndarray]:
    """All texts as UTF-8 in one buffer, a newline after each; starts has one entry more than texts. Null is empty."""
    raw = [b"" if not isinstance(t, str) else t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    buf = np.frombuffer(b"\n".join(raw) + (b"\n" if raw else b""), np.uint8)
    return buf, starts


def spans(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], is_word.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a polynomial in its bytes and its length, mixed.

    Summed run by run, so equal words hash alike wherever they stand."""
    if not len(start):
        return np.empty(0, U64)
    size = (end - start).astype(np.int64)
    top = int(size.max())
    if top <= 64:
        h = np.zeros(len(start), U64)
        live = np.arange(len(start))
        for k in range(top):
            live = live[size[live] > k]
            h[live] = h[live] * _R + buf[start[live] + k] + U64(1)
    else:  # some word is very long: sum all bytes at once, byte k weighs power k
        base = np.repeat(start, size)
        at = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(np.cumsum(size) - size, size)
        weight = powers(top)
        h = np.add.reduceat((buf[base + at].astype(U64) + U64(1)) * weight[np.repeat(size, size) - 1 - at],
                            np.cumsum(size) - size)
    return mix(h + size.astype(U64) * _MIX2)


def window_hashes(word: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every window of ``width`` words that lies within one document."""
    n = len(word) - width + 1
    if n <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    h = np.zeros(n, U64)
    for k in range(width):
        h = h * _R + word[k:k + n]
    first = np.flatnonzero(doc[:n] == doc[width - 1:width - 1 + n])
    return mix(h[first] + U64(width)), first
