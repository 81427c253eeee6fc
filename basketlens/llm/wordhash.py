"""Vectorised words and word hashes of Arrow text columns, used inside tasks.

A text is read as bytes in slices of bounded size, so that one very long text needs little
more memory than its bytes and eight bytes per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = np.asarray(x, dtype=U).copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> U(shift)
        x *= U(factor)
    x ^= x >> U(31)
    return x


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


BYTE_VALUES = _byte_values()
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = U(0xD1342543DE82EF95)
INVERSE = U(pow(int(BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[:1] = 1
    return np.multiply.accumulate(out)


BASE_POWERS = powers(BASE, SLICE_BYTES + 1)
INVERSE_POWERS = powers(INVERSE, SLICE_BYTES + 1)


def _slice_words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of the words of a slice; ``breaks`` are places where texts begin."""
    n = len(data)
    solid = ~IS_SPACE[data]
    first = np.empty(n, dtype=bool)
    first[:1] = True
    np.logical_not(solid[:-1], out=first[1:])
    first[breaks[breaks < n]] = True
    starts = np.flatnonzero(first & solid)
    after = np.empty(n, dtype=bool)
    after[-1:] = True
    after[:-1] = ~solid[1:] | first[1:]
    ends = np.flatnonzero(after & solid) + 1
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum(BYTE_VALUES[data] * BASE_POWERS[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * INVERSE_POWERS[starts]
    return mix(hashes + (ends - starts).astype(U)), starts, ends


def _long_word(data: np.ndarray) -> np.ndarray:
    """The hash of one word of any length, in slices."""
    total, scale = U(0), U(1)
    for at in range(0, len(data), SLICE_BYTES):
        piece = data[at : at + SLICE_BYTES]
        total = total + scale * np.sum(BYTE_VALUES[piece] * BASE_POWERS[: len(piece)], dtype=U)
        scale = scale * BASE_POWERS[SLICE_BYTES]
    return mix(np.array([total + U(len(data))], dtype=U))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins and the last one ends."""
    column = column.cast(pa.large_string()).fill_null("")
    if column.offset:
        column = pa.concat_arrays([column])
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, byte starts and ends of all words, the first word of each text, and the bytes.

    Words are ``[^\\x20\\x09-\\x0D]+``; A-Z hash as a-z. Null is an empty text.
    """
    data, offsets = text_bytes(column)
    parts, at, n = [], 0, len(data)
    with np.errstate(over="ignore"):
        while at < n:
            stop = min(n, at + SLICE_BYTES)
            if stop < n:
                # Cut at the last space or text border; a longer word is taken whole.
                borders = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, stop, "right")]
                spaces = np.flatnonzero(IS_SPACE[data[at:stop]])
                cut = max(borders[-1] if len(borders) else at, at + spaces[-1] + 1 if len(spaces) else at)
                if cut == at:
                    border = offsets[np.searchsorted(offsets, at, "right")]
                    space = at + SLICE_BYTES
                    while space < border and not IS_SPACE[data[space]]:
                        space += 1
                    stop = min(space, border)
                    parts.append((_long_word(data[at:stop]), np.array([at]), np.array([stop])))
                    at = stop
                    continue
                stop = cut
            breaks = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, stop)] - at
            found, starts, ends = _slice_words(data[at:stop], breaks)
            parts.append((found, starts + at, ends + at))
            at = stop
    if parts:
        hashes, starts, ends = (np.concatenate(x) for x in zip(*parts))
    else:
        hashes, starts, ends = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return hashes, starts, ends, np.searchsorted(starts, offsets), data


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of every ``k`` consecutive words; the caller leaves out runs over borders."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    with np.errstate(over="ignore"):
        out = hashes[:n].copy()
        for i in range(1, k):
            out = out * BASE + hashes[i : i + n]
        return mix(out)


def batches(batch: pa.RecordBatch, column: str = "text", most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece has few bytes of text; a longer text stands alone."""
    sizes = np.diff(text_bytes(batch.column(column))[1])
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held + size > most_bytes and i > start:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)
