"""Vectorised text kernels: word, shingle and line hashes of many texts at once, over their UTF-8 bytes.

A batch is cut into slices of a few megabytes, so memory is bounded by the slice or by the longest single text.
A word's hash is a polynomial over table values of its bytes, taken from one running sum, then mixed; equal
words always have equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

SLICE_BYTES = 1 << 21
_BLOCK = 1 << 18
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.RandomState(20260101).randint(1, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64)
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Every ASCII byte that is neither letter nor digit; bytes of other scripts are part of words.
PUNCTUATED = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_of(base: int, length: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < length:
        values = np.full(max(length, 2 * _BLOCK), base, np.uint64)
        values[0] = 1
        have = np.multiply.accumulate(values)
        if length <= 2 * _BLOCK:
            _powers[base] = have
    return have[:length]


def slices(texts: Sequence[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, encoded texts) for runs of about SLICE_BYTES; null is empty."""
    first, run, size = 0, [], 0
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if run and size + len(data) > SLICE_BYTES:
            yield first, run
            first, run, size = i, [], 0
        run.append(data)
        size += len(data) + 1
    if run:
        yield first, run


def joined(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with one newline after each, and where each text starts (one more entry for the end)."""
    data = np.frombuffer(b"\n".join(run) + b"\n", np.uint8)
    starts = np.zeros(len(run) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in run], out=starts[1:])
    return data, starts


def span_hashes(data: np.ndarray, counted: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span [begin, end) over its counted bytes; the spans come in order of their begin.

    Spans are taken block by block with positions from the block's start, so the tables of powers stay small; only a
    span longer than a block needs, and then drops, larger ones.
    """
    out = np.empty(len(begin), np.uint64)
    at = 0
    while at < len(begin):
        low = int(begin[at])
        stop = int(np.searchsorted(begin, low + _BLOCK))
        b, e = begin[at:stop] - low, end[at:stop] - low
        high = int(e.max())
        values = _BYTE_VALUES[data[low : low + high]]
        values[~counted[low : low + high]] = 0
        values *= _powers_of(_MULTIPLIER, high)
        total = np.zeros(high + 1, np.uint64)
        np.cumsum(values, out=total[1:])
        out[at:stop] = mix((total[e] - total[b]) * _powers_of(_INVERSE, high + 1)[b] + (e - b).astype(np.uint64))
        at = stop
    return out


def words(run: list[bytes], lower: bool = True, separators: np.ndarray = _SPACES) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets of each text's words): words are runs of bytes other than the separators.

    The separators are space and 0x09-0x0D unless given as a table by byte, which must include the line feed.
    """
    data, starts = joined(run)
    if lower:
        data = _LOWER[data]
    inside = ~separators[data]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return span_hashes(data, inside, begin, end), np.searchsorted(begin, starts)


def words_and_stems(run: list[bytes], stems: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word and of its leading ``stems`` bytes, number of its text); words are split at punctuation too.

    A word and a stem of the same bytes have different hashes; a word shorter than a stem has none of that length.
    """
    data, starts = joined(run)
    data = _LOWER[data]
    inside = ~PUNCTUATED[data]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(starts, begin, side="right") - 1
    found, owners = [span_hashes(data, inside, begin, end)], [owner]
    for length in stems:
        long = end - begin >= length
        found.append(mix(span_hashes(data, inside, begin[long], begin[long] + length) + np.uint64(length)))
        owners.append(owner[long])
    return np.concatenate(found), np.concatenate(owners)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct sorted shingle hashes of one text's word hashes; fewer words than n make one shingle of all."""
    if len(hashes) == 0:
        return hashes
    width = min(n, len(hashes))
    out = np.full(len(hashes) - width + 1, width, np.uint64)
    for i in range(width):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[i : len(out) + i])
    return np.unique(out)
