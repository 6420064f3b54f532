"""Interpolated modified Kneser-Ney: counted in Spark, stored as sorted hash arrays, memory-mapped.

Counting. Words, known by 64-bit hashes, are counted first and get ids, low
ones the frequent words. Then every task counts the n-grams of its texts and
sends them to buckets by the context's hash: one row a bucket, equal n-grams
once, as compressed steps from one n-gram to the next. A bucket adds up its
n-grams and keeps them by context. Then it sends the next lower order: each
distinct n-gram counts its suffix once (the continuation counts). Contexts are
split by hash; what one context brings together are its distinct next words.

The model is a folder of Arrow files, one for every order and bucket, and one
for every bucket of words. Contexts lie in order of their 64-bit hashes. An
index of cells, of ``_CELL`` contexts at most on average, stands for the
leading bits; the 40 bits below are kept, so a context never seen is taken for
another in one of 2**36 cases. A context's next words are a run of ascending
ids with their counts; totals are kept where a run is longer than ``_FEW`` and
added up elsewhere. Workers map the files, so memory holds the pages they
touch. Mapping needs a shared folder that is mounted on all machines; a store
without file paths is refused.

Texts are lower-cased (A-Z), split at white space, and end in one end token,
after ``order`` - 1 marks of the beginning that are context only. Null texts
are empty. Repeated rows count each time. A model of no texts gives every word
the probability of an unknown one.
"""

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialens.llm.bytewords import LOWER, bounds, mix, ragged, span_hashes, text_chunks, word_spans
from vialens.llm.shared import new_folder, partitions

BEGIN, END = np.uint64(1), np.uint64(2)
#: Ids of the mark of the beginning and of words never seen; no n-gram has the second.
_BEGIN, _UNKNOWN = 0, 0xFFFFFFFF
_CHUNK = 32 << 20
#: Contexts in a cell of the index, and how many next words are added up rather than kept as totals.
_CELL, _FEW = 16, 16
_KEY_BYTES = 5
_GRAMS = pa.schema([("bucket", pa.int32()), ("n", pa.int64()), ("grams", pa.binary())])
_GRAMS_SQL = "bucket int, n long, grams binary"


def _tokens(chunk, order: int):
    """(token hashes with begin and end marks, position of each real token, its document)."""
    starts, lengths, document = word_spans(chunk)
    words = span_hashes(chunk.data, starts, lengths)
    words[words <= END] += np.uint64(3)
    n = np.bincount(document, minlength=chunk.n)
    at = bounds(n + order)
    flat = np.full(int(at[-1]), BEGIN)
    flat[ragged(at[:-1] + order - 1, n)] = words
    flat[at[1:] - 1] = END
    return flat, ragged(at[:-1] + order - 1, n + 1), np.repeat(np.arange(chunk.n), n + 1)


def _hash(context: list[np.ndarray]) -> np.ndarray:
    """Hashes of contexts, given as columns of ids."""
    h = context[0].astype(np.uint64)
    for column in context[1:]:
        h = mix(h, column.astype(np.uint64))
    return mix(h, np.full(len(h), len(context), np.uint64))


def _bucket(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(48)) * np.uint64(n_buckets) >> np.uint64(16)).astype(np.uint16)


def _context_bucket(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """From other bits than those a bucket's contexts are sorted by."""
    return _bucket(mix(hashes, np.zeros(len(hashes), np.uint64)), n_buckets)


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """Where a row differs from the one before; the first does."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _parts(bucket: np.ndarray, n_buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its rows in their order) of every bucket that has any."""
    order = np.argsort(bucket, kind="stable")
    limits = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    for b in np.flatnonzero(np.diff(limits)).tolist():
        yield b, order[limits[b] : limits[b + 1]]


# n-grams on their way: a row for every bucket


def _squeezed(columns: list[np.ndarray]) -> bytes:
    """32-bit columns byte plane by byte plane, compressed."""
    planes = [np.ascontiguousarray(c, "<u4").view(np.uint8).reshape(-1, 4).T for c in columns]
    return pa.compress(np.concatenate(planes).tobytes(), codec="zstd", asbytes=True)


def _spread(blob: bytes, n: int, n_columns: int) -> list[np.ndarray]:
    data = pa.decompress(blob, decompressed_size=4 * n * n_columns, codec="zstd")
    planes = np.frombuffer(data, np.uint8).reshape(n_columns, 4, n)
    return [np.ascontiguousarray(p.T).view("<u4")[:, 0] for p in planes]


def _encoded(columns: list[np.ndarray], counts: np.ndarray) -> bytes:
    """N-grams in ascending order: each id less that of the row before, as far as rows begin alike."""
    fresh, out = _changes([np.zeros(len(counts))]), []
    for c in columns:
        step = c.copy()
        step[1:] -= c[:-1]
        out.append(np.where(fresh, c, step))
        fresh = fresh | _changes([c])
    return _squeezed([*out, counts])


def _decoded(blob: bytes, n: int, size: int):
    *steps, counts = _spread(blob, n, size + 1)
    fresh, columns = _changes([counts * 0]), []
    for step in steps:
        begin = np.flatnonzero(fresh)
        sums = np.cumsum(step, dtype=np.uint32)
        columns.append(sums - np.repeat((sums - step)[begin], np.diff(np.r_[begin, n])))
        fresh = fresh | _changes(columns[-1:])
    return columns, counts


def _rows(columns: list[np.ndarray], counts: np.ndarray, n_buckets: int) -> list[dict]:
    """Distinct n-grams in ascending order, sent to the buckets of their contexts."""
    if len(columns) > 1:
        begin = np.flatnonzero(_changes(columns[:-1]))
        of = _context_bucket(_hash([c[begin] for c in columns[:-1]]), n_buckets)
        bucket = np.repeat(of, np.diff(np.r_[begin, len(counts)]))
    else:
        bucket = ((columns[0] - 1) % n_buckets).astype(np.uint16)
    return [
        {"bucket": b, "n": len(i), "grams": _encoded([c[i] for c in columns], counts[i])}
        for b, i in _parts(bucket, n_buckets)
    ]


def _counted(columns: list[np.ndarray]):
    """(distinct n-grams in ascending order, how often each is there)."""
    bits = [int(c.max()).bit_length() for c in columns]
    if sum(bits) <= 64:
        key = columns[0].astype(np.uint64)
        for c, b in zip(columns[1:], bits[1:], strict=True):
            key = key << np.uint64(b) | c
        key.sort()
        begin = np.flatnonzero(_changes([key]))
        counts, key, out = np.diff(np.r_[begin, len(key)]), key[begin], []
        for b in reversed(bits):
            out.append((key & np.uint64((1 << b) - 1)).astype(np.uint32))
            key = key >> np.uint64(b) if b < 64 else key * 0
        return out[::-1], counts
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    begin = np.flatnonzero(_changes(columns))
    return [c[begin] for c in columns], np.diff(np.r_[begin, len(order)])


def _merged(table: pa.Table, size: int):
    """(hashes of the contexts, context of each n-gram, n-grams, counts) in order of (hash, word)."""
    parts = [_decoded(r["grams"], r["n"], size) for r in table.select(["n", "grams"]).to_pylist()]
    columns = [np.concatenate(c) for c in zip(*(p[0] for p in parts), strict=True)]
    counts = np.concatenate([p[1] for p in parts]).astype(np.int64)
    del parts
    begin = np.flatnonzero(_changes(columns[:-1]))
    hashes, which = np.unique(_hash([c[begin] for c in columns[:-1]]), return_inverse=True)
    key = np.repeat(which.astype(np.uint64), np.diff(np.r_[begin, len(counts)]))
    key = key << np.uint64(32) | columns[-1]
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(_changes([key]))
    context = (key[first] >> np.uint64(32)).astype(np.int64)
    return hashes, context, [c[order[first]] for c in columns], np.add.reduceat(counts[order], first)


# the model's files


def _save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """A file that is there whole or not at all, however often its task runs."""
    path, own = f"{folder}/{name}.arrow", f"{folder}/.{name}.{uuid.uuid4().hex}"
    types = pa.schema([(k, pa.large_binary()) for k in arrays])
    row = [pa.array([v.tobytes()], pa.large_binary()) for v in arrays.values()]
    with pa.OSFile(own, "wb") as f, pa.ipc.new_file(f, types) as out:
        out.write_batch(pa.RecordBatch.from_arrays(row, schema=types))
    os.replace(own, path)


def _load(folder: str, name: str) -> dict[str, pa.Buffer]:
    """The file's arrays, memory-mapped."""
    batch = pa.ipc.open_file(pa.memory_map(f"{folder}/{name}.arrow")).get_batch(0)
    # a scalar would be a copy
    return {k: batch.column(k).buffers()[2] or pa.py_buffer(b"") for k in batch.schema.names}


def _narrow(name: str, values: np.ndarray, width: int = 0) -> dict[str, np.ndarray]:
    """Numbers in as few bytes as the largest needs, lowest byte first."""
    width = width or max(1, (int(values.max()).bit_length() + 7) // 8)
    cells = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return {name: np.ascontiguousarray(cells), f"{name}-width": np.array([width])}


class _Narrow:
    def __init__(self, file: dict, name: str):
        self.width = int(np.frombuffer(file[f"{name}-width"], np.int64)[0])
        self.cells = np.frombuffer(file[name], np.uint8).reshape(-1, self.width)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), 8), np.uint8)
        out[:, : self.width] = self.cells.take(at, axis=0)
        return out.view("<u8")[:, 0]

    def find(self, wanted: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """(which numbers are there, their places), each sought in an ascending run of its own."""
        place, end = lo.copy(), hi
        left = np.flatnonzero(lo < hi)
        lo, hi, number = lo[left], hi[left], wanted[left]
        while len(left):
            middle = (lo + hi) >> 1
            less = self[middle] < number
            lo, hi = np.where(less, middle + 1, lo), np.where(less, hi, middle)
            place[left] = lo
            more = np.flatnonzero(lo < hi)
            left, lo, hi, number = left[more], lo[more], hi[more], number[more]
        hit = np.flatnonzero(place < end)
        hit = hit[self[place[hit]] == wanted[hit]]
        return hit, place[hit]


def _bytes(name: str, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Counts in one byte each, those of 255 and more in a list of their own."""
    big = np.flatnonzero(counts >= 255)
    small = np.minimum(counts, 255).astype(np.uint8)
    return {name: small, f"{name}-big": np.stack([big, counts[big]]).astype(np.int64)}


class _Bytes:
    def __init__(self, file: dict, name: str):
        self.small = np.frombuffer(file[name], np.uint8)
        self.big = np.frombuffer(file[f"{name}-big"], np.int64).reshape(2, -1)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        n = self.small.take(at).astype(np.int64)
        over = np.flatnonzero(n == 255)
        n[over] = self.big[1][np.searchsorted(self.big[0], at[over])]
        return n


def _cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(40) >> np.uint64(24 - bits)).astype(np.int64)


def _short(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The ``_KEY_BYTES`` bytes below the cell's bits."""
    return hashes >> np.uint64(24 - bits) & np.uint64((1 << 8 * _KEY_BYTES) - 1)


def _sums(counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The total and how many counts are 1, 2 and more, of each run."""
    of = (counts, counts == 1, counts == 2, counts > 2)
    return np.stack([np.add.reduceat(x, starts, dtype=np.int64) for x in of])


def _level_file(hashes, context, words, counts) -> dict[str, np.ndarray]:
    starts = np.flatnonzero(_changes([context]))
    bits = min(24, (len(hashes) // _CELL).bit_length())
    cell = _cells(hashes, bits)
    first = np.searchsorted(cell, np.arange((1 << bits) + 1))
    ends = np.r_[starts, len(words)]
    many = np.flatnonzero(np.diff(ends) > _FEW)
    stats = [int((counts == i).sum()) for i in (1, 2, 3, 4)]
    return {
        **_narrow("contexts", _short(hashes, bits), _KEY_BYTES),
        **_bytes("offsets", starts - ends[first[cell]]),
        "first": np.stack([first, ends[first]]).astype(np.uint32),
        "many": many,
        "totals": _sums(counts, starts)[:, many],
        **_narrow("words", words),
        **_bytes("counts", counts),
        "stats": np.array(stats),
    }


def _mounted(path: str) -> str:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if not path.startswith("/"):
        raise ValueError(f"the model is memory-mapped: {path} must be on a mounted file system")
    return path


def _fit_words(texts: DataFrame, folder: str, n_buckets: int) -> None:
    """Counts words and gives them ids, low ones to frequent words."""

    def count(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for chunk in text_chunks(batch.column(0), LOWER, _CHUNK):
                words, counts = np.unique(_tokens(chunk, 1)[0], return_counts=True)
                rows = []
                for b, i in _parts(_bucket(words, n_buckets), n_buckets):
                    halves = words[i].view("<u4").reshape(-1, 2)
                    blob = _squeezed([halves[:, 0], halves[:, 1], counts[i]])
                    rows.append({"bucket": b, "n": len(i), "grams": blob})
                yield pa.RecordBatch.from_pylist(rows, _GRAMS)

    def add(table: pa.Table) -> pa.Table:
        b = table["bucket"][0].as_py()
        parts = [_spread(r["grams"], r["n"], 3) for r in table.to_pylist()]
        low, high, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        words = high.astype(np.uint64) << np.uint64(32) | low
        words, which = np.unique(words, return_inverse=True)
        total = np.zeros(len(words), np.int64)
        np.add.at(total, which, counts)
        ids = np.zeros(len(words), np.int64)
        ids[np.argsort(-total, kind="stable")] = 1 + b + n_buckets * np.arange(len(words))
        if ids.max() >= _UNKNOWN:
            raise ValueError("ids have 32 bits: too many different words")
        sums = np.array([total.sum(), len(words)])
        _save(folder, f"words-{b:05d}", {"words": words, **_narrow("ids", ids), **_bytes("raw", total), "sums": sums})
        return _GRAMS.empty_table()

    texts.mapInArrow(count, _GRAMS_SQL).groupBy("bucket").applyInArrow(add, _GRAMS_SQL).count()


class _Words:
    """The words' ids and counts, memory-mapped."""

    def __init__(self, folder: str, n_buckets: int):
        self.n_buckets, self.buckets, self.sums = n_buckets, {}, np.zeros(2, np.int64)
        there = set(os.listdir(folder))
        for b in range(n_buckets):
            if f"words-{b:05d}.arrow" in there:
                file = _load(folder, f"words-{b:05d}")
                words = np.frombuffer(file["words"], np.uint64)
                self.buckets[b] = words, _Narrow(file, "ids"), _Bytes(file, "raw")
                self.sums += np.frombuffer(file["sums"], np.int64)

    def of(self, hashes: np.ndarray):
        """(ids, counts) of ascending hashes."""
        ids, raw = np.full(len(hashes), _UNKNOWN, np.uint32), np.zeros(len(hashes), np.int64)
        for b, i in _parts(_bucket(hashes, self.n_buckets), self.n_buckets):
            if b in self.buckets:
                words, of, counts = self.buckets[b]
                at = np.minimum(np.searchsorted(words, hashes[i]), len(words) - 1)
                hit = words[at] == hashes[i]
                ids[i[hit]], raw[i[hit]] = of[at[hit]], counts[at[hit]]
        ids[hashes == BEGIN] = _BEGIN
        return ids, raw


def fit(docs: DataFrame, order: int = 3, text: str = "text") -> str:
    """Counts all texts of ``docs`` into a model; returns its folder."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark = docs.sparkSession
    folder = _mounted(new_folder(spark, "model"))
    os.makedirs(folder)
    n_buckets = min(partitions(spark), 1 << 16)
    texts = docs.select(F.col(text))
    _fit_words(texts, folder, n_buckets)

    def grams(chunk, words: _Words):
        flat, at, _ = _tokens(chunk, order)
        distinct, which = np.unique(flat, return_inverse=True)
        # numbers within the chunk, in the order of the ids, are small enough to sort as one
        ids, number = np.unique(words.of(distinct)[0], return_inverse=True)
        which = number.astype(np.uint32)[which]
        columns, counts = _counted([which[at - back] for back in range(order - 1, -1, -1)])
        return [ids[c] for c in columns], counts

    def count(batches: Iterator[pa.RecordBatch]):
        words = _Words(folder, n_buckets)
        for batch in batches:
            for chunk in text_chunks(batch.column(0), LOWER, _CHUNK):
                yield pa.RecordBatch.from_pylist(_rows(*grams(chunk, words), n_buckets), _GRAMS)

    def level(size: int):
        def reduce(table: pa.Table) -> pa.Table:
            name = f"{size}-{table['bucket'][0].as_py():05d}"
            hashes, context, grams, counts = _merged(table, size)
            _save(folder, name, _level_file(hashes, context, grams[-1], counts))
            return pa.Table.from_pylist(_rows(*_counted(grams[1:]), n_buckets), _GRAMS)

        return reduce

    def lowest(table: pa.Table) -> pa.Table:
        b, counts = table["bucket"][0].as_py(), np.zeros(0, np.int64)
        for row in table.select(["n", "grams"]).to_pylist():
            (ids,), n = _decoded(row["grams"], row["n"], 1)
            place = (ids.astype(np.int64) - 1) // n_buckets
            counts = np.pad(counts, (0, max(0, int(place.max()) + 1 - len(counts))))
            counts[place] += n
        stats = [int((counts == i).sum()) for i in (1, 2, 3, 4)]
        stats += [int(counts.sum()), int((counts > 2).sum())]
        _save(folder, f"1-{b:05d}", {**_bytes("counts", counts), "stats": np.array(stats)})
        return _GRAMS.empty_table()

    rows = texts.mapInArrow(count, _GRAMS_SQL)
    for size in range(order, 1, -1):
        rows = rows.groupBy("bucket").applyInArrow(level(size), _GRAMS_SQL)
    rows.groupBy("bucket").applyInArrow(lowest, _GRAMS_SQL).count()
    _save(folder, "model", {"shape": np.array([order, n_buckets])})
    return folder


# scoring


def _discounts(n: np.ndarray) -> np.ndarray:
    """For counts of 0, 1, 2 and more; a level too small to estimate them takes three quarters."""
    n1, n2, n3, n4 = (float(x) for x in n[:4])
    if min(n1, n2, n3) == 0:
        return np.array([0, 0.75, 0.75, 0.75])
    y = n1 / (n1 + 2 * n2)
    found = [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.clip(found, 0, [0, 1, 2, 3])


class _Level:
    """The n-grams of one order and bucket, memory-mapped."""

    def __init__(self, file: dict):
        self.contexts, self.offsets = _Narrow(file, "contexts"), _Bytes(file, "offsets")
        self.first = np.frombuffer(file["first"], np.uint32).reshape(2, -1)
        self.bits = (self.first.shape[1] - 1).bit_length() - 1
        self.many = np.frombuffer(file["many"], np.int64)
        self.totals = np.frombuffer(file["totals"], np.int64).reshape(4, -1)
        self.words, self.counts = _Narrow(file, "words"), _Bytes(file, "counts")

    def runs(self, hashes: np.ndarray):
        """(which contexts are there, totals of these, first next word of each, end of them)."""
        cell = _cells(hashes, self.bits)
        lo, hi = (self.first[0][cell + i].astype(np.int64) for i in (0, 1))
        hit, at = self.contexts.find(_short(hashes, self.bits), lo, hi)
        cell, last = cell[hit], at + 1 == hi[hit]
        base = self.first[1]
        start = base[cell].astype(np.int64) + self.offsets[at]
        end = base[cell + 1].astype(np.int64)
        end[~last] = base[cell[~last]] + self.offsets[at[~last] + 1]
        totals = np.zeros((4, len(at)), np.int64)
        few = end - start <= _FEW
        if few.any():
            n = (end - start)[few]
            totals[:, few] = _sums(self.counts[ragged(start[few], n)], bounds(n)[:-1])
        totals[:, ~few] = self.totals[:, np.searchsorted(self.many, at[~few])]
        return hit, totals, start, end


class Model:
    """A fitted model, memory-mapped."""

    def __init__(self, folder: str):
        shape = np.frombuffer(_load(folder, "model")["shape"], np.int64)
        self.order, self.n_buckets = (int(x) for x in shape)
        self.words = _Words(folder, self.n_buckets)
        self.train_tokens, self.n_types = (int(x) for x in self.words.sums)
        there = set(os.listdir(folder))
        self.lowest, self.levels, self.stats = {}, [], np.zeros(6, np.int64)
        self.discounts = []
        for size in range(1, self.order + 1):
            level, stats = {}, 0
            for b in range(self.n_buckets):
                if f"{size}-{b:05d}.arrow" in there:
                    file = _load(folder, f"{size}-{b:05d}")
                    level[b] = _Level(file) if size > 1 else _Bytes(file, "counts")
                    stats = stats + np.frombuffer(file["stats"], np.int64)
            if size == 1:
                self.lowest, self.stats = level, stats + self.stats
            else:
                self.levels.append(level)
            self.discounts.append(_discounts(stats if level else np.zeros(4)))

    def _unigrams(self, ids: np.ndarray) -> np.ndarray:
        """Probabilities of single words from the words they follow."""
        n = self.stats
        if not n[4]:
            return np.ones(len(ids))
        seen, d = np.zeros(len(ids), np.int64), self.discounts[0]
        known = np.flatnonzero((ids != _UNKNOWN) & (ids != _BEGIN))
        place, bucket = divmod(ids[known].astype(np.int64) - 1, self.n_buckets)
        for b, i in _parts(bucket.astype(np.uint16), self.n_buckets):
            seen[known[i]] = self.lowest[b][place[i]]
        spare = (d[1:] * [*n[:2], n[5]]).sum() / n[4]
        return np.maximum(seen - d[np.minimum(seen, 3)], 0) / n[4] + spare / (self.n_types + 1)

    def score(self, flat: np.ndarray, at: np.ndarray):
        """(log10 probability, raw count) of each token."""
        distinct, which = np.unique(flat, return_inverse=True)
        ids, raw = self.words.of(distinct)
        p, raw, ids = self._unigrams(ids)[which[at]], raw[which[at]], ids[which]
        for size in range(2, self.order + 1):
            level, d = self.levels[size - 2], self.discounts[size - 1]
            context = _hash([ids[at - back] for back in range(size - 1, 0, -1)])
            hashes, place = np.unique(context, return_inverse=True)
            bucket = _context_bucket(hashes, self.n_buckets)
            totals = np.zeros((4, len(hashes)), np.int64)
            runs, count = np.zeros((2, len(hashes)), np.int64), np.zeros(len(at), np.int64)
            for b, i in _parts(bucket, self.n_buckets):
                if b in level:
                    hit, *found = level[b].runs(hashes[i])
                    totals[:, i[hit]], runs[0, i[hit]], runs[1, i[hit]] = found
            for b, i in _parts(bucket[place], self.n_buckets):
                if b in level:
                    lo, hi = runs[:, place[i]]
                    hit, there = level[b].words.find(ids[at[i]].astype(np.uint64), lo, hi)
                    count[i[hit]] = level[b].counts[there]
            n = totals[0]
            spare = np.where(n > 0, (d[1:, None] * totals[1:]).sum(axis=0) / np.maximum(n, 1), 1)
            own = np.maximum(count - d[np.minimum(count, 3)], 0) / np.maximum(n, 1)[place]
            p = own + spare[place] * p
        return np.log10(p), raw


def held_out(id: str = "doc_id", folds: int = 10) -> Column:
    """Rows that training never sees: crc32 of the id as text divides by ``folds``."""
    name = F.coalesce(F.col(id).cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % folds == 0


def score_documents(docs: DataFrame, folder: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every text.

    ``base_score`` is the log10 probability under the counts of single words
    with 0.1 added, ``score`` that of the model.
    """

    def scored(batches: Iterator[pa.RecordBatch]):
        model = Model(folder)
        for batch in batches:
            for chunk in text_chunks(batch.column(1), LOWER, 4 << 20):
                flat, at, document = _tokens(chunk, model.order)
                logs, raw = model.score(flat, at)
                n = model.train_tokens + 0.1 * (model.n_types + 1)
                add = lambda x: np.bincount(document, x, chunk.n)  # noqa: B023, E731
                tokens, score = add(np.ones(len(at))), add(logs)
                columns = [
                    pa.array(tokens.astype(np.int64)),
                    pa.array(add(raw > 0).astype(np.int64)),
                    pa.array(np.full(chunk.n, model.train_tokens, np.int64)),
                    pa.array(add(np.log10((raw + 0.1) / n))),
                    pa.array(score),
                    pa.array(10 ** (-score / tokens)),
                ]
                keys = batch.column(0).slice(chunk.first, chunk.n)
                names = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
                yield pa.RecordBatch.from_arrays([keys, *columns], ["doc_id", *names])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text))
    schema = (
        "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, perplexity double"
    )
    return rows.mapInArrow(scored, schema)


def perplexities(docs: DataFrame, order: int = 3) -> DataFrame:
    """Scores of all texts by a model of those that are not held out."""
    folder = fit(docs.filter(~held_out()), order)
    return score_documents(docs, folder).withColumn("held_out", held_out())
