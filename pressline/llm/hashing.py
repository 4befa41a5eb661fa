"""Array hashing of many texts at once: word spans, word hashes and mixers (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
"""Texts are joined up to about this many bytes before they are hashed; one longer text is a chunk."""

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


_POWERS: dict[int, np.ndarray] = {}
"""Powers of a few bases for chunks of the usual length, so that they are not made anew for each."""


def powers(n: int, base: np.uint64) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; not to be written to."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        out = np.full(max(n, CHUNK + 2 if n > CHUNK >> 4 else n), base, dtype=np.uint64)
        out[:1] = 1
        known = np.multiply.accumulate(out)
        if len(known) <= 2 * CHUNK and len(_POWERS) < 8:
            _POWERS[int(base)] = known
    return known[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span. Equal bytes give equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    n = len(data)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODES[data] * powers(n, _P), out=total[1:])
    raw = (total[ends] - total[starts]) * powers(n, _P_INVERSE)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def word_spans(data: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes for which ``separator`` is False."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~separator[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, joined bytes with a space after each text, start of each text)."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (size == 0 or size + len(texts[last]) <= limit):
            size += len(texts[last]) + 1
            last += 1
        part = texts[first:last]
        data = np.frombuffer(b" ".join(part) + b" ", dtype=np.uint8)
        lengths = np.fromiter((len(x) + 1 for x in part), dtype=np.int64, count=len(part))
        yield first, data, np.concatenate(([0], np.cumsum(lengths)))
        first = last


def spans_taken(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all spans in a row, offset of each span and the end)."""
    length = ends - starts
    offsets = np.concatenate(([0], np.cumsum(length)))
    return data[np.repeat(starts - offsets[:-1], length) + np.arange(offsets[-1])], offsets


def same_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Whether each span has the bytes of span number ``like``, compared byte by byte."""
    same = ends - starts == (ends - starts)[like]
    length = np.where(same, ends - starts, 0)
    offsets = np.cumsum(length) - length
    here = np.repeat(starts - offsets, length) + np.arange(length.sum())
    equal = data[here] == data[here + np.repeat(starts[like] - starts, length)]
    wrong = np.repeat(np.arange(len(starts)), length)[~equal]
    same[wrong] = False
    return same
