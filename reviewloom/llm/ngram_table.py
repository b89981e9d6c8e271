"""Word n-grams of a stretch of texts, interned in an open-addressed table.

Words are runs of digits, letters a-z (A-Z lower-cased) and bytes from 0x80 on. The words
of a stretch are written one after the other with single spaces between them, so each run
of words is a slice of one buffer. The table's slots are arrays: the owner of a slot is the
first place found of its n-gram, keys are xxhash64, collisions move on to the next slot,
and equal keys are held against each other byte by byte.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import xxhash

#: Bytes of texts in one table, so that its memory follows neither length nor number of texts.
STRETCH = 1 << 18
#: Slices up to this length are hashed together by length, longer ones one at a time.
SHORT = 64

_SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True

# the published constants of xxhash64
_P1 = np.uint64(0x9E3779B185EBCA87)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F)
_P3 = np.uint64(0x165667B19E3779F9)
_P4 = np.uint64(0x85EBCA77C2B2AE63)
_P5 = np.uint64(0x27D4EB2F165667C5)


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, np.uint32(0xEDB88320) ^ (value >> np.uint32(1)), value >> np.uint32(1))
    return value.astype(np.uint32)


_CRC = _crc_table()


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


class Buffer:
    """Bytes that can be read as numbers from any place."""

    def __init__(self, data: np.ndarray):
        self.data = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
        n = len(self.data)
        self.eights = np.ndarray((n - 7,), dtype="<u8", buffer=self.data, strides=(1,))
        self.fours = np.ndarray((n - 3,), dtype="<u4", buffer=self.data, strides=(1,))

    def slice(self, start: int, length: int) -> bytes:
        return self.data[start : start + length].tobytes()


def _by_length(lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of each length; all above ``SHORT`` are one group of length ``SHORT`` + 1."""
    if not len(lengths):
        return
    short = np.minimum(lengths, SHORT + 1).astype(np.uint8)
    order = np.argsort(short, kind="stable")
    sorted_ = short[order]
    cuts = np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1
    for own in np.split(order, cuts):
        yield int(short[own[0]]), own


def _hash_alike(buffer: Buffer, at: np.ndarray, length: int) -> np.ndarray:
    """xxhash64 with seed 0 of slices of one length."""
    eights, done = buffer.eights, 0
    if length >= 32:
        lanes = [
            np.full(len(at), x, dtype=np.uint64)
            for x in (_P1 + _P2, _P2, np.uint64(0), np.uint64(0) - _P1)
        ]
        while length - done >= 32:
            for i in range(4):
                lanes[i] = _turn(lanes[i] + eights[at + (done + 8 * i)] * _P2, 31) * _P1
            done += 32
        h = _turn(lanes[0], 1) + _turn(lanes[1], 7) + _turn(lanes[2], 12) + _turn(lanes[3], 18)
        for lane in lanes:
            h = (h ^ (_turn(lane * _P2, 31) * _P1)) * _P1 + _P4
    else:
        h = np.full(len(at), _P5, dtype=np.uint64)
    h += np.uint64(length)
    while length - done >= 8:
        h = _turn(h ^ (_turn(eights[at + done] * _P2, 31) * _P1), 27) * _P1 + _P4
        done += 8
    if length - done >= 4:
        h = _turn(h ^ (buffer.fours[at + done].astype(np.uint64) * _P1), 23) * _P2 + _P3
        done += 4
    while done < length:
        h = _turn(h ^ (buffer.data[at + done].astype(np.uint64) * _P5), 11) * _P1
        done += 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _crc_alike(buffer: Buffer, at: np.ndarray, length: int) -> np.ndarray:
    crc = np.full(len(at), 0xFFFFFFFF, dtype=np.uint32)
    for i in range(length):
        crc = _CRC[(crc ^ buffer.data[at + i]) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def _of_slices(buffer: Buffer, starts, lengths, alike, one, dtype) -> np.ndarray:
    out = np.empty(len(starts), dtype=dtype)
    with np.errstate(over="ignore"):
        for length, own in _by_length(lengths):
            if length <= SHORT and len(own) > 8:
                out[own] = alike(buffer, starts[own], length)
            else:
                places = zip(starts[own].tolist(), lengths[own].tolist(), strict=True)
                out[own] = [one(buffer.slice(s, n)) for s, n in places]
    return out


def hashes(buffer: Buffer, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return _of_slices(buffer, starts, lengths, _hash_alike, xxhash.xxh64_intdigest, np.uint64)


def checksums(buffer: Buffer, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of each slice."""
    return _of_slices(buffer, starts, lengths, _crc_alike, zlib.crc32, np.uint32)


def _equal(buffer: Buffer, one: np.ndarray, two: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether two slices of one length hold the same bytes, for each row."""
    eights = buffer.eights
    mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * np.minimum(lengths, 8).astype(np.uint64))
    same = ((eights[one] ^ eights[two]) & mask) == 0
    left = np.flatnonzero(same & (lengths > 8) & (lengths <= SHORT))
    done = 8
    while len(left):
        # the last eight bytes may be looked at twice
        at = np.minimum(done, lengths[left] - 8)
        fits = eights[one[left] + at] == eights[two[left] + at]
        same[left[~fits]] = False
        done += 8
        left = left[fits & (lengths[left] > done)]
    for i in np.flatnonzero(same & (lengths > SHORT)).tolist():
        n = int(lengths[i])
        same[i] = buffer.slice(int(one[i]), n) == buffer.slice(int(two[i]), n)
    return same


class NgramTable:
    """The distinct slices of a buffer, with a slot for each place's slice.

    ``slots``: the slot of each place. ``used``: the slots that are taken. ``counts`` and
    ``buckets``: by slot, the number of places and the checksum modulo ``n_buckets``.
    """

    def __init__(self, buffer: Buffer, starts: np.ndarray, lengths: np.ndarray, n_buckets: int):
        n = len(starts)
        size = 1 << max(4, (2 * n).bit_length())
        mask = size - 1
        keys = hashes(buffer, starts, lengths)
        owner = np.full(size, -1, dtype=np.int64)
        slots = np.empty(n, dtype=np.int64)
        at = (keys & np.uint64(mask)).astype(np.int64)
        left = np.arange(n)
        while len(left):
            here = at[left]
            free = owner[here] < 0
            owner[here[free]] = left[free]
            held = owner[here]
            same = (keys[held] == keys[left]) & (lengths[held] == lengths[left])
            check = np.flatnonzero(same & (held != left))
            same[check] = _equal(buffer, starts[held[check]], starts[left[check]], lengths[left[check]])
            slots[left[same]] = here[same]
            left = left[~same]
            at[left] = (at[left] + 1) & mask
        self.slots = slots
        self.used = np.flatnonzero(owner >= 0)
        self.counts = np.bincount(slots, minlength=size)
        first = owner[self.used]
        self.buckets = np.zeros(size, dtype=np.int64)
        self.buckets[self.used] = checksums(buffer, starts[first], lengths[first]) % np.uint32(n_buckets)


def _last_word(piece: bytes) -> bytes:
    inside = np.flatnonzero(_IS_WORD[np.frombuffer(piece, dtype=np.uint8)])
    if not len(inside):
        return b""
    end = int(inside[-1]) + 1
    gaps = np.flatnonzero(np.diff(inside) > 1)
    return piece[int(inside[gaps[-1] + 1] if len(gaps) else inside[0]) : end]


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, bytes, bool]]:
    """(text, bytes, whether its first word ended the piece before), cut behind separators."""
    for i, raw in enumerate(texts):
        at, word = 0, b""
        while at < len(raw):
            end = at + STRETCH
            gap = _SEPARATOR.search(raw, end) if end < len(raw) else None
            end = gap.start() + 1 if gap else len(raw)
            # a pair of words may reach over the cut: the last word starts the next piece
            piece = word + b"\x00" + raw[at:end] if word else raw[at:end]
            yield i, piece, bool(word)
            if end < len(raw):
                word = _last_word(piece)
            at = end


def _stretches(texts: list[bytes]) -> Iterator[list[tuple[int, bytes, bool]]]:
    group, size = [], 0
    for piece in _pieces(texts):
        group.append(piece)
        size += len(piece[1])
        if size >= STRETCH:
            yield group
            group, size = [], 0
    if group:
        yield group


def features(texts: list[bytes], n_buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, NgramTable]]:
    """For stretches of the texts: the text of each place of a word and of a pair of
    neighbouring words, whether it is a single word, and the table of the places."""
    for group in _stretches(texts):
        data = np.frombuffer(b"\x00".join([x for _, x, _ in group]) + b"\x00", dtype=np.uint8)
        inside = _IS_WORD[data]
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        begin, end = edges[::2], edges[1::2]
        if not len(begin):
            continue
        # keep the words and one byte behind each, which becomes the space
        keep = inside.copy()
        keep[end] = True
        buffer = Buffer(np.where(inside, _LOWER[data], np.uint8(32))[keep])
        lengths = end - begin
        starts = np.cumsum(lengths + 1) - lengths - 1
        offsets = np.cumsum([0, *(len(x) + 1 for _, x, _ in group)])
        piece = np.searchsorted(offsets, begin, side="right") - 1
        new = np.ones(len(begin), dtype=bool)
        heads = np.searchsorted(begin, offsets[:-1])
        for k, (_, _, again) in enumerate(group):
            if again:
                new[heads[k]] = False
        pair = np.flatnonzero(piece[1:] == piece[:-1])
        single = np.flatnonzero(new)
        text_of = np.array([i for i, _, _ in group])[piece]
        yield (
            np.concatenate([text_of[single], text_of[pair]]),
            np.arange(len(single) + len(pair)) < len(single),
            NgramTable(
                buffer,
                np.concatenate([starts[single], starts[pair]]),
                np.concatenate([lengths[single], lengths[pair] + 1 + lengths[pair + 1]]),
                n_buckets,
            ),
        )
