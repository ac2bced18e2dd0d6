"""Word-shingle sets of texts as sorted 64-bit hashes, a group of texts at a time in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words are runs of other bytes than these.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
GROUP_BYTES = 1 << 20
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = np.random.default_rng(20_240_101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.random.default_rng(20_240_102).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2^64."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n, GROUP_BYTES + (1 << 16)) + 1
        made = []
        for b in (_BASE, _INVERSE):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers = tuple(made)
    return _powers


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all texts' lower-cased words, number of words of each text)."""
    buf = np.frombuffer(b"\n".join([b"", *texts, b""]).translate(_LOWER), np.uint8)
    space = np.zeros(256, bool)
    space[list(SPACE)] = True
    gap = space[buf]
    start = np.flatnonzero(~gap[1:] & gap[:-1]) + 1
    end = np.flatnonzero(gap[1:] & ~gap[:-1]) + 1
    power, inverse = _up_to(len(buf))
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTES[buf] * power[: len(buf)], out=total[1:])
    words = mixed((total[end] - total[start]) * inverse[start])
    bounds = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return words, np.diff(np.searchsorted(start, bounds))


def shingle_sets(texts: list[bytes], k: int = 5) -> list[np.ndarray]:
    """Each text's set of k-word shingles as sorted distinct hashes; a shorter text's words are one shingle."""
    words, counts = word_hashes(texts)
    n = len(words)
    joined = np.zeros(n, np.uint64)
    for j in range(min(k, n)):
        joined[: n - j] += words[j:] * _PLACE[j]
    joined = mixed(joined)
    out, at = [], 0
    for c in counts.tolist():
        if c >= k:
            own = np.sort(joined[at : at + c - k + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif c:
            short = (words[at : at + c] * _PLACE[:c]).sum(dtype=np.uint64) + np.uint64(c)
            out.append(mixed(mixed(np.array([short], np.uint64))))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def set_key(s: np.ndarray) -> int:
    """A signed 64-bit fingerprint of a sorted set."""
    return int(np.array([xxhash.xxh3_64_intdigest(s.tobytes())], np.uint64).view(np.int64)[0])
