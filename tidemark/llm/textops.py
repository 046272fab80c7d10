"""Vectorised helpers over Arrow string columns: word boundaries, hashes and windows as numpy arrays.

Everything works on the UTF-8 bytes of a slice of a column, so a task handles a few megabytes at a
time whatever the number of rows in an Arrow batch. Hashes are polynomials modulo 2^64 (Rabin-Karp)
over random byte values; prefix sums give the hash of any range in constant time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 4 << 20
HASH_BYTES = 1 << 20


def byte_table(ranges: list[tuple[int, int]]) -> np.ndarray:
    """True for the byte values inside any of the closed ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# Fixed word rules. Separators of the first: space and the controls 0x09-0x0D.
NOT_SPACE = ~byte_table([(0x20, 0x20), (0x09, 0x0D)])
# Digits, lower-case letters and everything beyond ASCII (upper case is folded before).
ALNUM = ~byte_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.int64).astype(U64) | U64(1)
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2^64
_WORD_BASE = 0xD1342543DE82EF95
# A second family of the same kind of hash, with byte values and bases of its own.
_OTHER_VALUES = np.random.default_rng(77003141).integers(1, 2**63, 256, dtype=np.int64).astype(U64) | U64(1)
_OTHER_BASE = 0xC2B2AE3D27D4EB4F
_OTHER_WORD_BASE = 0xA0761D6478BD642F


def strings(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_string())


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes; a longer text stands alone."""
    if batch.num_rows == 0:
        return
    _, bounds = text_bytes(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(bounds, bounds[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the n + 1 row bounds; a null is an empty text."""
    column = strings(column)
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_spans(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (maximal run of bytes in ``table`` inside a row) and n + 1 word bounds of rows."""
    inside = table[data]
    edge = np.zeros(len(data) + 1, bool)  # a row starts at this byte, or the data ends
    edge[bounds] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, bounds)


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, base, U64)
    up[0] = 1
    down = np.full(size, pow(base, -1, 1 << 64), U64)
    down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < size; tables come in sizes of powers of two."""
    full = 1 << max(10, int(size - 1).bit_length())
    up, down = _powers(base, full)
    return up[:size], down[:size]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = x + U64(0x9E3779B97F4A7C15 * (salt + 1) & (2**64 - 1))
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def _prefix(values: np.ndarray, base: int) -> np.ndarray:
    up, _ = powers(base, len(values))
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up, out=out[1:])
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: bool = False) -> np.ndarray:
    """A 64-bit hash of every word's bytes, computed in runs of about HASH_BYTES so that long texts need no more memory.
    ``other`` takes the second family."""
    values, base = (_OTHER_VALUES, _OTHER_BASE) if other else (_BYTE_VALUES, _BASE)
    out = np.zeros(len(starts), U64)
    at = 0
    while at < len(starts):
        low = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, low + HASH_BYTES, side="right")))
        s, e = starts[at:stop] - low, ends[at:stop] - low
        piece = data[low : low + e[-1]]
        sums = _prefix(values[piece], base)
        _, down = powers(base, len(piece))
        out[at:stop] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64))
        at = stop
    return out


def window_hashes(words: np.ndarray, size: int, other: bool = False) -> np.ndarray:
    """The hash of every ``size`` consecutive words; windows may cross rows, see :func:`window_mask`."""
    if len(words) < size:
        return np.zeros(0, U64)
    base = _OTHER_WORD_BASE if other else _WORD_BASE
    sums = _prefix(words, base)
    _, down = powers(base, len(words))
    return mix((sums[size:] - sums[:-size]) * down[: len(words) - size + 1])


def window_mask(word_bounds: np.ndarray, size: int) -> np.ndarray:
    """True for window starts whose ``size`` words lie in one row."""
    total = int(word_bounds[-1])
    if total < size:
        return np.zeros(0, bool)
    mask = np.ones(total - size + 1, bool)
    for k in word_bounds[1:-1]:
        mask[max(0, int(k) - size + 1) : int(k)] = False
    return mask


def covered(starts: np.ndarray, size: int | np.ndarray, total: int) -> np.ndarray:
    """True for positions below ``total`` inside any range [start, start + size)."""
    steps = np.zeros(total + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + size, -1)
    return np.cumsum(steps[:-1]) > 0


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (first axis) per row; empty rows give 0."""
    sums = np.zeros((len(values) + 1, *values.shape[1:]), np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, axis=0, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def joined_words(data: np.ndarray, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray):
    """Bytes and row bounds of the kept words, each followed by one space."""
    lengths = np.where(keep, ends - starts + 1, 0)
    out_ends = np.cumsum(lengths)
    total = int(out_ends[-1]) if len(out_ends) else 0
    out = np.full(total, 0x20, np.uint8)
    kept_len = (ends - starts)[keep]
    kept_out = (out_ends - lengths)[keep]
    source = ranges(starts[keep], kept_len)
    out[ranges(kept_out, kept_len)] = data[source]
    word_bounds = np.searchsorted(starts, bounds)
    return out, np.concatenate([[0], out_ends])[word_bounds].astype(np.int64)


def fresh(name: str, taken: list[str]) -> str:
    """A column name that is not taken, whatever the case."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated integers of all [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)


def run_starts(ordered: np.ndarray) -> np.ndarray:
    """Indices at which a new value starts in a sorted array."""
    if not len(ordered):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
