"""Encoding a whole batch by its distinct units: runs of text that a tokenizer never joins.

Each distinct unit goes to the tokenizer once; a worker remembers up to
``REMEMBERED`` units in flat arrays, about 60 bytes each, and starts anew beyond.
"""

import sys
import types
from collections.abc import Callable

import numpy as np

from vialens.llm.bytewords import LONG, Chunk, bounds, ragged, span_hashes

REMEMBERED = 1_000_000

Encode = Callable[[list[bytes]], list[bytes]]


def worker_state(name: str, make: Callable):
    """A value kept by the Python worker between its tasks."""
    holder = sys.modules.setdefault("_worker_state", types.ModuleType("_worker_state"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


class _Flat:
    """Runs of numbers one after the other, with room to grow and 8 cells of padding."""

    def __init__(self, dtype):
        self.cells, self.used = np.zeros(1 << 16, dtype), 0

    def append(self, cells: np.ndarray) -> int:
        at, need = self.used, self.used + len(cells) + 8
        if need > len(self.cells):
            grown = np.zeros(max(need, len(self.cells) * 3 // 2), self.cells.dtype)
            grown[: self.used] = self.cells[: self.used]
            self.cells = grown
        self.cells[at : at + len(cells)] = cells
        self.used += len(cells)
        return at


class Units:
    """Spans of text and their token ids, by the hash of the text."""

    def __init__(self, encode: Encode):
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.places = np.zeros((0, 4), np.int64)  # ids from, ids, bytes from, bytes
        self.ids, self.bytes = _Flat(np.uint32), _Flat(np.uint8)

    def spans(self, chunk: Chunk, starts: np.ndarray, lengths: np.ndarray):
        """(index of each span's unit, first id and number of ids by unit, all ids).

        ``encode`` gives the ids of contents as little-endian uint32. Spans meet
        by a 64-bit hash and are compared byte by byte with what they met; if
        two contents share a hash, every span of the chunk is encoded by itself.
        """
        hashes = span_hashes(chunk.data, starts, lengths)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        met = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        met[inside] = self.hashes[at[inside]] == distinct[inside]
        if len(self.hashes) + (~met).sum() > REMEMBERED:
            self.forget()
            at, met = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), bool)
        new = np.flatnonzero(~met)
        if len(new):
            added = self._added(chunk, starts[first[new]], lengths[first[new]])
            self.places = np.insert(self.places, at[new], added, axis=0)
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            at = np.searchsorted(self.hashes, distinct)
        unit = at[which]
        of = self.places[unit]
        if not same_bytes(chunk.data, starts, lengths, self.bytes.cells, of[:, 2], of[:, 3]):
            places = self._added(chunk, starts, lengths)
            return np.arange(len(starts)), places[:, 0], places[:, 1], self.ids.cells
        return unit, self.places[:, 0], self.places[:, 1], self.ids.cells

    def ids_of(self, chunk: Chunk, starts: np.ndarray, lengths: np.ndarray):
        """(ids of all spans in order, number of ids of each span)."""
        unit, first, count, ids = self.spans(chunk, starts, lengths)
        counts = count[unit]
        return ids[ragged(first[unit], counts)], counts

    def _added(self, chunk: Chunk, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        data = chunk.data.tobytes()
        contents = [
            data[a:b] for a, b in zip(starts.tolist(), (starts + lengths).tolist(), strict=True)
        ]
        found = self.encode(contents)
        n_ids = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids_at = self.ids.append(np.frombuffer(b"".join(found), "<u4"))
        bytes_at = self.bytes.append(np.frombuffer(b"".join(contents), np.uint8))
        return np.stack(
            [ids_at + bounds(n_ids)[:-1], n_ids, bytes_at + bounds(lengths)[:-1], lengths], axis=1
        )


def same_bytes(data: np.ndarray, starts, lengths, other: np.ndarray, at, sizes) -> bool:
    """Whether every span of ``data`` equals its span of ``other``; both are padded."""
    if not np.array_equal(lengths, sizes):
        return False
    mine = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    theirs = np.ndarray((len(other) - 7,), "<u8", other, 0, (1,))
    long, done = lengths > LONG, 0
    for i in np.flatnonzero(long):
        a, b, n = starts[i], at[i], lengths[i]
        if not np.array_equal(data[a : a + n], other[b : b + n]):
            return False
    active = np.flatnonzero(~long & (lengths > 0))
    while len(active):
        left = lengths[active] - done
        unused = np.uint64(64) - np.minimum(left, 8).astype(np.uint64) * np.uint64(8)
        differ = mine[starts[active] + done] ^ theirs[at[active] + done]
        if (differ << unused).any():
            return False
        active = active[left > 8]
        done += 8
    return True
