"""Words, hashes and windows of whole Arrow batches, as numpy arrays over the text bytes.

Texts are cut into chunks of whole documents, so memory follows the chunk size;
a document longer than that is a chunk of its own.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 4 << 20
#: Spans of more bytes are hashed and compared one by one.
LONG = 64

#: [^\x20\x09-\x0D]+
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S32, _S29 = np.uint64(32), np.uint64(29)


@dataclass
class Chunk:
    """Rows ``first`` to ``first + n`` of a batch; ``data`` ends in 8 bytes of padding."""

    first: int
    n: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def text_chunks(
    column: pa.Array, table: np.ndarray | None = None, size: int = CHUNK_BYTES
) -> Iterator[Chunk]:
    """Chunks of a string column; null is empty. ``table`` maps every byte, e.g. ``LOWER``."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        part = data[offsets[lo] : offsets[hi]]
        padded = np.zeros(len(part) + 8, np.uint8)
        padded[:-8] = part if table is None else table[part]
        yield Chunk(lo, hi - lo, padded, offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def word_spans(chunk: Chunk, separators: np.ndarray = SPACES):
    """(starts, lengths, document number) of every word, in order."""
    n = int(chunk.offsets[-1])
    inside = ~separators[chunk.data[:n]]
    first = np.zeros(n + 1, bool)
    first[chunk.offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:n]
    ends = inside
    ends[:-1] = inside[:-1] & (~inside[1:] | first[1:n]) if n else inside[:-1]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) + 1 - starts
    return starts, lengths, np.searchsorted(chunk.offsets, starts, "right") - 1


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two, element by element; the order of the two counts."""
    z = a * _A
    z ^= z >> _S29
    z += b
    z *= _B
    z ^= z >> _S32
    z *= _A
    z ^= z >> _S29
    return z


def span_hashes(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 0
) -> np.ndarray:
    """A 64-bit hash of every byte span; ``data`` is padded by 8 bytes."""
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    out = lengths.astype(np.uint64) + np.uint64(seed)
    long = lengths > LONG
    active = np.flatnonzero(~long)
    at = 0
    while len(active):
        left = lengths[active] - at
        piece = words[starts[active] + at] & _MASKS[np.minimum(left, 8)]
        out[active] = mix(out[active], piece)
        active = active[left > 8]
        at += 8
    for i in np.flatnonzero(long):
        span = data[starts[i] : starts[i] + lengths[i]]
        out[i] = xxhash.xxh3_64_intdigest(span, seed=seed + 1)
    return out


def window_hashes(hashes: np.ndarray, size: int, have: int = 1) -> np.ndarray:
    """Hashes of all windows of ``size`` words from those of ``have`` words, by doubling.

    Entry p is the window from p on. Windows reaching into the next document
    are in the result too; ``inside`` tells which do not.
    """
    while have < size:
        step = min(have, size - have)
        if len(hashes) <= step:
            return hashes[:0]
        hashes = mix(hashes[:-step], hashes[step:])
        have += step
    return hashes


def inside(document: np.ndarray, size: int) -> np.ndarray:
    """Which windows of ``size`` words lie in one document."""
    if len(document) < size:
        return np.zeros(0, bool)
    return document[: len(document) - size + 1] == document[size - 1 :]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the runs ``starts[i], ..., starts[i] + lengths[i] - 1``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def bounds(lengths: np.ndarray) -> np.ndarray:
    """Start of each run, and the end of the last."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
