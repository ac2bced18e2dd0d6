"""Plain forms of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) >= k:
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def near_groups(rows):
    """{doc_id: (set size, component)} over all pairs."""
    sets = {d: shingles(t) for d, t in rows}
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    held = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            held[x].append(d)
    for d, s in sets.items():
        for o, both in Counter(o for x in s for o in held[x] if o > d).items():
            if 100 * both >= 75 * (len(s) + len(sets[o]) - both):
                a, b = sorted((top(d), top(o)))
                up[b] = a
    return {d: (len(s), top(d)) for d, s in sets.items()}


def best_fit_decreasing(lengths, context):
    rooms, n = [], 0
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            n += 1
            rooms.append(context - length)
    return n


def targets(sizes, weights=(5, 2, 1), cap=3):
    """{source: target} by resharing what the full ones leave until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = {}, sum(sizes.values())
    while True:
        left = total - sum(full.values())
        rest = sum(w[s] for s in order if s not in full)
        share = {s: left * w[s] / rest for s in order if s not in full} if rest else {}
        over = {s: cap * sizes[s] for s in share if share[s] > cap * sizes[s] + 1e-9}
        if not over:
            return full | share
        full |= over


def flac_samples(m):
    """The samples of a mono 8-bit FLAC stream, read bit by bit from its frames; checksums are not looked at."""
    assert m[:4] == b"fLaC"
    at, last = 4, False
    while not last:
        last, size = m[at] >> 7, int.from_bytes(m[at + 1 : at + 4], "big")
        if m[at] & 127 == 0:
            block = int.from_bytes(m[at + 4 : at + 6], "big")
            total = int.from_bytes(m[at + 14 : at + 22], "big") & (1 << 36) - 1
        at += 4 + size
    bits, spot, out = "".join(f"{b:08b}" for b in m[at:]), 0, []

    def take(n, signed=False):
        nonlocal spot
        v = int(bits[spot : spot + n] or "0", 2)
        spot += n
        return v - (1 << n) if signed and n and v >> (n - 1) else v

    while len(out) < total:
        assert take(15) == 0x7FFC
        take(1)
        size, rate, _channels, _depth = take(4), take(4), take(4), take(4)
        first = take(8)
        take(8 * max(0, (8 - (first ^ 255).bit_length()) - 1))
        n = take(8) + 1 if size == 6 else take(16) + 1 if size == 7 else {1: 192}.get(size) or (576 << (size - 2) if size < 6 else 256 << (size - 8))
        take({12: 8, 13: 16, 14: 16}.get(rate, 0))
        take(8)
        take(1)
        kind, wasted = take(6), take(1)
        assert not wasted and n <= block
        if kind == 0:
            x = [take(8, True)] * n
        elif kind == 1:
            x = [take(8, True) for _ in range(n)]
        else:
            order = kind - 31 if kind >= 32 else kind - 8
            x = [take(8, True) for _ in range(order)]
            if kind >= 32:
                width = take(4) + 1
                shift = take(5, True)
                coefs = [take(width, True) for _ in range(order)]
            else:
                shift, coefs = 0, [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]][order]
            assert take(2) == 0
            parts = 1 << take(4)
            for p in range(parts):
                k = take(4)
                for _ in range(n // parts - (order if p == 0 else 0)):
                    q = bits.index("1", spot) - spot
                    spot += q + 1
                    u = q << k | take(k)
                    x.append((u >> 1 ^ -(u & 1)) + (sum(c * x[-1 - i] for i, c in enumerate(coefs)) >> shift))
        spot = -(-spot // 8) * 8 + 16
        out += x
    return out


def ring_places(ids, shards, virtual=64, slots=4096):
    """{row index: shard}: rows in order of (ring slot, id) walk clockwise, a step of all at a time, to shards with room."""
    import hashlib
    import struct

    import xxhash

    nodes = sorted((int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") % slots, s) for s in range(shards) for v in range(virtual))

    def met(slot):
        out = []
        for p, s in [n for n in nodes if n[0] >= slot] + [n for n in nodes if n[0] < slot]:
            out += [s] * (s not in out)
        return out

    def slot_of(i):
        h = xxhash.xxh64(struct.pack("<q", i), seed=42).intdigest()
        return (h - (h >> 63 << 64)) % slots

    room = [len(ids) // shards + (s < len(ids) % shards) for s in range(shards)]
    rows, placed = sorted((slot_of(i), i, x) for x, i in enumerate(ids)), {}
    walks = {slot: met(slot) for slot, _, _ in rows}
    for step in range(shards):
        for slot, _, x in rows:
            if x not in placed and room[walks[slot][step]]:
                placed[x] = walks[slot][step]
                room[walks[slot][step]] -= 1
    return placed
