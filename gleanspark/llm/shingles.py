"""Hashed word shingles of many texts at once (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_R = np.uint64(0x9E3779B97F4A7C15)                         # odd, so it has an inverse
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype="uint8")
_LOWER[65:91] += 32
GROUP_BYTES = 1 << 18                                      # bytes hashed together


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_constants(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype="uint64") * _R + np.uint64(salt)) | np.uint64(1)


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > 4 * GROUP_BYTES:                                # a rare long word: not kept
        p, q = np.full(n, _R, "uint64"), np.full(n, _R_INV, "uint64")
        p[0] = q[0] = 1
        return np.cumprod(p), np.cumprod(q)
    if len(_POWERS.get("up", ())) < n:
        for name, r in (("up", _R), ("down", _R_INV)):
            p = np.full(n, r, "uint64")
            p[0] = 1
            _POWERS[name] = np.cumprod(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words. Long data is cut at blanks into pieces of about
    ``GROUP_BYTES``, for hashing takes some thirty bytes a byte; what stays is two numbers a word."""
    if len(data) <= 2 * GROUP_BYTES:
        return _piece_hashes(data)
    parts, at = [], 0
    while at < len(data):
        blank = np.flatnonzero(_BLANK[data[at + GROUP_BYTES:at + 2 * GROUP_BYTES]])
        if len(blank):
            end = at + GROUP_BYTES + int(blank[0])
        else:                                              # a word longer than that stays whole
            blank = np.flatnonzero(_BLANK[data[at + GROUP_BYTES:]])
            end = at + GROUP_BYTES + int(blank[0]) if len(blank) else len(data)
        starts, words = _piece_hashes(data[at:end])
        parts.append((starts + at, words))
        at = end
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _piece_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words: polynomial of the lower-cased bytes, by prefix sums."""
    blank = np.concatenate([[True], _BLANK[data], [True]])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, "uint64")
    np.cumsum((_LOWER[data].astype("uint64") + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def shingle_sets(texts: list, size: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``size``-word shingles; a text of
    fewer words has one, of all its words; no text or no word: none."""
    group: list[bytes] = []
    held = 0
    for t in texts:
        data = t.encode("utf-8") if isinstance(t, str) else b""
        if group and held + len(data) > GROUP_BYTES:
            yield from _sets_of(group, size)
            group, held = [], 0
        group.append(data)
        held += len(data)
    if group:
        yield from _sets_of(group, size)


def _sets_of(group: list[bytes], size: int) -> Iterator[np.ndarray]:
    data = np.frombuffer(b" ".join(group), "uint8")
    ends = np.cumsum([len(b) + 1 for b in group])           # one past each text's separator
    starts, words = _word_hashes(data)
    first = np.searchsorted(starts, np.concatenate([[0], ends]))   # words before each text
    weights = odd_constants(size, 0x5EED)
    n = max(0, len(words) - size + 1)
    grams = np.zeros(n, "uint64")
    for j in range(size):
        grams += words[j:j + n] * weights[j]
    grams = mix(grams)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield np.unique(grams[a:b - size + 1])
        elif b > a:
            yield mix((words[a:b] * weights[:b - a]).sum(keepdims=True)
                      + np.uint64((b - a) * 0x1F123BB5))
        else:
            yield np.empty(0, "uint64")
