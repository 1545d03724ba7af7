"""Anchors: sampled positions that equal strings have in common, and rolling fingerprints of bytes."""

from __future__ import annotations

import numpy as np

#: Odd multipliers of the rolling fingerprint and of its finisher.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, BASE, np.uint64))])


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit fingerprints of all ``width``-byte strings of ``data``, by doubling: the fingerprint of twice
    the length is that of the first half times a power of the base plus that of the second."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = _powers(width)
    have, size, got = data.astype(np.uint64) + np.uint64(1), 1, None
    with np.errstate(over="ignore"):
        done = 0
        bits = width
        while True:
            if bits & 1:
                tail = have[done:]
                got = have if got is None else got[: len(tail)] * power[size] + tail
                done += size
            bits >>= 1
            if not bits:
                break
            have = have[:-size] * power[size] + have[size:]
            size *= 2
        out = got[:n].copy()
        out ^= out >> np.uint64(32)
        out *= MIX
        out ^= out >> np.uint64(29)
    return out


#: Window starts handled at once; positions within them fit in the low bits of a sampling key.
CHUNK_BITS = 20


def anchor_runs(data: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all ``window``-byte strings of ``data``: ``(rank, anchor, first, count)``, one row a run.

    The anchor of a window is the ``gram``-byte string in it with the smallest fingerprint, the leftmost
    of equals, so equal windows have equal anchors at equal places.  Windows that follow one another
    mostly share theirs: a run is ``count`` windows from ``first`` on with one anchor; ``rank`` is the
    anchor's fingerprint.
    """
    low, reach = np.uint64((1 << CHUNK_BITS) - 1), window - gram + 1
    out = []
    for chunk in range(0, len(data) - window + 1, (1 << CHUNK_BITS) - window):
        part = data[chunk : chunk + (1 << CHUNK_BITS) - 1]
        if len(part) < window:
            break
        hashes = window_hashes(part, gram)
        best, size = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), 1
        while size < reach:
            step = min(size, reach - size)
            best = np.minimum(best[:-step], best[step:])
            size += step
        first = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
        at = (best[first] & low).astype(np.int64)
        out.append((hashes[at], at + chunk, first + chunk, np.diff(np.append(first, len(best)))))
    if not out:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))
