"""Word and shingle hashes of UTF-8 texts as numpy arrays."""

from __future__ import annotations

import re

import numpy as np

#: Bytes worked on at a time, so that memory does not follow the length of a text.
SLICE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: A fixed value for each lower-cased byte.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))[_LOWER]
#: Odd factors of the words of a shingle.
_PLACE = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _factors(n: int) -> np.ndarray:
    """A factor for each place in a word. They follow no rule that texts could follow, as
    the powers of a number do, so unlike words have unlike sums however long they are."""
    return mix(np.arange(1 << 32, (1 << 32) + n, dtype=np.uint64)) | np.uint64(1)


_FACTOR = _factors(SLICE + 1)


def _slices(raw: bytes):
    at, n = 0, len(raw)
    while at < n:
        end = at + SLICE
        if end < n:
            space = _SPACE.search(raw, end - 1)
            end = space.start() + 1 if space else n
        yield raw[at:end]
        at = end


def _bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, and where words start and end."""
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(_IS_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return data, edges[::2], edges[1::2]


def _of_slice(raw: bytes, bounds: tuple | None = None) -> np.ndarray:
    data, start, end = bounds or _bounds(raw)
    length = end - start
    if not len(length):
        return np.zeros(0, dtype=np.uint64)
    longest = int(length.max())
    factor = _FACTOR if longest <= len(_FACTOR) else _factors(longest)
    # the bytes of the words, one word after the other, and each one's place in its word
    ends = np.cumsum(length)
    place = np.arange(ends[-1]) - np.repeat(ends - length, length)
    inside = data[place + np.repeat(start, length)]
    word = np.add.reduceat(_BYTE[inside] * factor[place], ends - length)
    return mix(word + length.astype(np.uint64))


def word_hashes(raw: bytes) -> np.ndarray:
    """One hash for each word; A-Z count as a-z."""
    parts = [_of_slice(x) for x in _slices(raw)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def word_hashes_of(texts: list[bytes]) -> list[np.ndarray]:
    """The word hashes of each text; short texts are hashed together."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    room = SLICE
    for raw in [*texts, None]:
        if raw is None or len(raw) >= room:
            if group:
                starts = np.cumsum([0, *(len(x) + 1 for x in group)])
                joined = b"\n".join(group)
                data = _bounds(joined)
                out.extend(np.split(_of_slice(joined, data), np.searchsorted(data[1], starts[1:-1])))
            group, room = [], SLICE
        if raw is not None:
            if len(raw) >= room:
                out.append(word_hashes(raw))
            else:
                group.append(raw)
                room -= len(raw) + 1
    return out


def _runs(words: np.ndarray, width: int) -> np.ndarray:
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total += words[k : len(words) - width + 1 + k] * _PLACE[k]
    return mix(total)


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words; a text of
    fewer words is one run, a text without words has none."""
    words = word_hashes_of([x or b"" for x in texts])
    all_words = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
    runs = _runs(all_words, size) if len(all_words) >= size else all_words[:0]
    out, at = [], 0
    for w in words:
        n = len(w)
        if n >= size:
            found = np.sort(runs[at : at + n - size + 1])
            first = np.empty(len(found), dtype=bool)
            first[0] = True
            np.not_equal(found[1:], found[:-1], out=first[1:])
            out.append(found[first])
        else:
            out.append(_runs(w, n) if n else w)
        at += n
    return out
