"""Removal of repeated passages: windows of words that start anywhere else as well.

Level-wise doubling. The first level takes windows of a quarter of the length,
not at every word but at anchors: the places whose short window has the least
hash among all that fit into one whole window. Equal whole windows hold equal
anchors at equal offsets, so nothing is missed, and only one word in some
fourteen is an anchor. Anchors that repeat are extended to twice the length, to
the right and to the left (whichever lies inside a whole window); those that
still repeat have their whole windows compared. What does not repeat at one
level never reaches the next.

Hashes meet in buckets, packed into arrays. Before the shuffle every chunk
keeps one of the equal hashes it has seen, so a passage in a third of all texts
sends each bucket a row a chunk, not a row a text; equal texts count once a
chunk for the same reason. Short hashes have 64 bits, whole windows 128.

Defined cases: null and empty texts have no words; texts under one window lose
nothing; repeated rows repeat each other's windows. Windows are judged on the
input, not on what is left.
"""

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vialens.llm.bytewords import (
    Chunk,
    bounds,
    inside,
    mix,
    span_hashes,
    text_chunks,
    window_hashes,
    word_spans,
)
from vialens.llm.shared import partitions, settle

_CHUNK = 8 << 20
_FIELDS = ("keys", "doc", "at", "weight", "h0", "h1", "h2")
_PACKED = "bucket int, " + ", ".join(f"{f} binary" for f in _FIELDS)
_PLACES = "key binary, places binary"


def _rolling(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``size`` neighbours, by doubling."""
    have = 1
    while have < size and len(values):
        step = min(have, size - have)
        values = pick(values[:-step], values[step:])
        have += step
    return values


class _Words:
    """The words of a chunk's texts, each text once, and their window hashes."""

    def __init__(self, chunk: Chunk, keys: np.ndarray, size: int):
        self.size, self.short = size, -(-size // 4)
        _, first, copies = np.unique(keys, return_index=True, return_counts=True)
        order = np.argsort(first)
        self.texts = first[order]
        self.weight = np.minimum(copies, 2).astype(np.uint8)[order]
        starts, lengths, document = word_spans(chunk)
        renumbered = np.full(chunk.n, -1)
        renumbered[self.texts] = np.arange(len(self.texts))
        document = renumbered[document]
        kept = document >= 0
        starts, lengths, self.document = starts[kept], lengths[kept], document[kept]
        self.keys = keys[self.texts]
        self.hashes = [span_hashes(chunk.data, starts, lengths, s) for s in (0, 77)]
        counts = np.bincount(self.document, minlength=len(self.texts))
        self.first = bounds(counts)
        self.at = np.arange(len(self.document)) - self.first[self.document]

    def least(self) -> np.ndarray:
        """For every whole window, the least short hash inside; 0 if it leaves its text."""
        self.short_hashes = window_hashes(self.hashes[0], self.short)
        least = _rolling(self.short_hashes, self.size - self.short + 1, np.minimum)
        return least * inside(self.document, self.size)

    def anchors(self) -> np.ndarray:
        """Places of the short windows that are least in some whole window."""
        span = self.size - self.short
        least = np.concatenate([np.zeros(span, np.uint64), self.least(), np.zeros(span, np.uint64)])
        most = _rolling(least, span + 1, np.maximum)[: len(self.short_hashes)]
        return np.flatnonzero((most == self.short_hashes[: len(most)]) & (most > 0))

    def doubled(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows of twice the short length, to the right and to the left; 0: none."""
        long = 2 * self.short
        hashes = window_hashes(self.short_hashes, long, self.short)
        inner = inside(self.document, long)
        out = []
        for begin in (place, place - self.short):
            ok = (begin >= 0) & (begin < len(hashes))
            ok[ok] = inner[begin[ok]]
            ok &= self.document[np.maximum(begin, 0)] == self.document[place]
            found = np.zeros(len(place), np.uint64)
            found[ok] = hashes[begin[ok]] | np.uint64(1)
            out.append(found)
        return out[0], out[1]


def _pack(words: _Words, place, bucket, n_buckets: int, hashes) -> Iterator[dict]:
    """A row for every bucket; of equal hashes in the chunk, one, with the weight of all."""
    whole = hashes[0]
    for h in hashes[1:]:
        whole = mix(whole, h)
    _, first, which = np.unique(whole, return_index=True, return_inverse=True)
    weight = np.minimum(np.bincount(which, words.weight[words.document[place]]), 2)
    bucket = (bucket >> np.uint64(32)) % np.uint64(n_buckets)
    # what repeats in the chunk is known here; the other copies only report their places
    known = weight[which] > 1
    order = np.lexsort((place, bucket))
    chosen = np.zeros(len(place), bool)
    chosen[first] = True
    order = order[(known | chosen)[order]]
    limits = np.searchsorted(bucket[order], np.arange(n_buckets + 1, dtype=np.uint64))
    for b in np.flatnonzero(np.diff(limits)):
        i = order[limits[b] : limits[b + 1]]
        texts, doc = np.unique(words.document[place[i]], return_inverse=True)
        sent = chosen[i]
        row = {
            "bucket": int(b),
            "keys": words.keys[texts].tobytes().ljust(16 * len(texts), b"\0"),
            "doc": doc.astype("<u4").tobytes(),
            "at": words.at[place[i]].astype("<u4").tobytes(),
            "weight": np.where(sent, weight[which[i]], 0).astype(np.uint8).tobytes(),
        }
        for k, h in enumerate(hashes):
            row[f"h{k}"] = h[i][sent].tobytes()
        yield row


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


_SCHEMA = pa.schema([("bucket", pa.int32())] + [(f, pa.binary()) for f in _FIELDS])
_PLACES_SCHEMA = pa.schema([("key", pa.binary()), ("places", pa.binary())])


def _unpack(table: pa.Table):
    """Arrays of a bucket's rows: text keys, text of each place, places, weights and hashes.

    A weight of 0 stands for a place that is known to repeat; it brings no hash.
    """
    keys = np.frombuffer(b"".join(table["keys"].to_pylist()), "V16")
    sizes = [len(k) // 16 for k in table["keys"].to_pylist()]
    shift = bounds(np.array(sizes, np.int64))
    doc = [np.frombuffer(d, "<u4") + s for d, s in zip(table["doc"].to_pylist(), shift[:-1].tolist())]
    join = lambda c, kind: np.frombuffer(b"".join(table[c].to_pylist()), kind)
    hashes = [join(f, "<u8") for f in ("h0", "h1", "h2")]
    return keys, np.concatenate(doc), join("at", "<u4"), join("weight", np.uint8), hashes


def _repeated(weight: np.ndarray, *hashes: np.ndarray) -> np.ndarray:
    """Which entries have a hash that all entries together bring at least twice."""
    order = np.lexsort(hashes)
    new = np.ones(len(order), bool)
    for i, h in enumerate(hashes):
        s = h[order]
        new[1:] = (s[1:] != s[:-1]) | (new[1:] if i else False)
    group = np.cumsum(new) - 1
    out = np.zeros(len(order), bool)
    out[order] = np.bincount(group, weight[order])[group] > 1
    return out


def _found(keys, doc, at, keep) -> pa.Table:
    """(key, places) rows of the entries to keep, one for every distinct text.

    Copies of a text come from many chunks; a place of them is listed once. It
    has one hash and so one bucket: a text's lists hold its own places at most.
    """
    keys, same = np.unique(keys, return_inverse=True)
    doc, at = same[doc[keep]], at[keep]
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])
    doc, at = doc[new], at[new]
    begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, int)
    end = np.r_[begin[1:], len(doc)].astype(int) if len(doc) else begin
    rows = [
        {"key": keys[doc[a]].tobytes(), "places": at[a:b].astype("<u4").tobytes()}
        for a, b in zip(begin.tolist(), end.tolist(), strict=True)
    ]
    return pa.Table.from_pylist(rows, _PLACES_SCHEMA)


def _anchor_level(table: pa.Table) -> pa.Table:
    keys, doc, at, weight, (short, right, left) = _unpack(table)
    sent = np.flatnonzero(weight)
    weights = weight[sent].astype(np.int64)
    again = np.flatnonzero(_repeated(weights, short))
    alive = np.zeros(len(again), bool)
    for h in (right[again], left[again]):
        alive |= _repeated(weights[again], h) & (h > 0)
    keep = weight == 0
    keep[sent[again[alive]]] = True
    return _found(keys, doc, at, keep)


def _window_level(table: pa.Table) -> pa.Table:
    keys, doc, at, weight, (_, a, b) = _unpack(table)
    keep = weight == 0
    sent = np.flatnonzero(weight)
    keep[sent] = _repeated(weight[sent].astype(np.int64), a, b)
    return _found(keys, doc, at, keep)


def _merged(places: list[bytes]) -> np.ndarray:
    return np.unique(np.frombuffer(b"".join(places), "<u4").astype(np.int64))


def repeated_windows(texts: DataFrame, size: int) -> DataFrame:
    """(key, places): where windows start that start anywhere else too, by text.

    ``texts`` has (key, text), a row for every document; ``key`` is a digest of
    the text of 16 bytes. ``places`` is a list of packed word numbers.
    """
    n_buckets = partitions(texts.sparkSession)

    def anchors(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(0).to_pylist()), "V16")
            for chunk in text_chunks(batch.column(1), size=_CHUNK):
                words = _Words(chunk, keys[chunk.first : chunk.first + chunk.n], size)
                place = words.anchors()
                if len(place):
                    short = words.short_hashes[place]
                    rows = _pack(words, place, short, n_buckets, (short, *words.doubled(place)))
                    yield _rows(list(rows), _SCHEMA)

    def windows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(0).to_pylist()), "V16")
            found = batch.column(2).to_pylist()
            for chunk in text_chunks(batch.column(1), size=_CHUNK):
                words = _Words(chunk, keys[chunk.first : chunk.first + chunk.n], size)
                least = words.least()
                mark = np.zeros(len(least) + 1, np.int64)
                for i, text in enumerate(words.texts.tolist()):
                    at = _merged(found[chunk.first + text]) + words.first[i]
                    # whole windows that hold the anchor; those that leave the text are no windows
                    mark_from = np.clip(at - (size - words.short), 0, len(least))
                    np.add.at(mark, mark_from, 1)
                    np.add.at(mark, np.clip(at + 1, 0, len(least)), -1)
                place = np.flatnonzero((np.cumsum(mark)[:-1] > 0) & (least > 0))
                if len(place):
                    a, b = (window_hashes(h, size)[place] for h in words.hashes)
                    rows = _pack(words, place, least[place], n_buckets, (least[place], a, b))
                    yield _rows(list(rows), _SCHEMA)

    def level(rows: DataFrame, keep) -> DataFrame:
        return rows.groupBy("bucket").applyInArrow(keep, _PLACES)

    def by_text(places: DataFrame) -> DataFrame:
        return places.groupBy("key").agg(F.collect_list("places").alias("places"))

    alive = settle(level(texts.mapInArrow(anchors, _PACKED), _anchor_level))
    candidates = texts.join(by_text(alive), "key").select("key", "text", "places")
    return by_text(settle(level(candidates.mapInArrow(windows, _PACKED), _window_level)))


def keep_unrepeated(
    docs: DataFrame, size: int = 35, text: str = "text", untouched: bool = False
) -> DataFrame:
    """``docs`` without the words of repeated windows, with ``n_words`` and ``n_removed`` added.

    What is left of a text is joined by one space; with ``untouched`` a text
    that loses nothing stays as it is. All other columns are carried along
    (those named ``n_words`` or ``n_removed`` are replaced).
    """
    if size < 8:
        raise ValueError("a window has at least 8 words")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (text, "n_words", "n_removed")]
    rows = docs.select(
        F.struct(F.lit(0).alias("_"), *rest).alias("row"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("key", F.unhex(F.md5(F.col("text").cast("binary"))))
    places = repeated_windows(rows.select("key", "text"), size)
    joined = rows.join(places, "key", "left").select("row", "text", "places")

    def remove(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            kept, n_words, n_removed = [], [], []
            for t, p in zip(texts, batch.column(2).to_pylist(), strict=True):
                words = t.split()
                n = len(words)
                if p:
                    at = _merged(p)
                    mark = np.bincount(at, minlength=n + 1)
                    mark -= np.bincount(np.minimum(at + size, n), minlength=n + 1)
                    words = list(compress(words, (np.cumsum(mark)[:-1] == 0).tolist()))
                n_words.append(n)
                n_removed.append(n - len(words))
                kept.append(t if untouched and n == len(words) else b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                ],
                ["row", "text", "n_words", "n_removed"],
            )

    schema = T.StructType([joined.schema["row"], joined.schema["text"]])
    schema = schema.add("n_words", "long").add("n_removed", "long")
    done = joined.mapInArrow(remove, schema)
    columns = [F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    columns = [c for c, name in zip(columns, docs.columns) if name not in ("n_words", "n_removed")]
    return done.select(*columns, "n_words", "n_removed")


def kept_digests(docs: DataFrame, size: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    return keep_unrepeated(docs.select("doc_id", "text"), size).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words",
        "n_removed",
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )
