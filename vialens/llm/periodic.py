"""Periodic runs: maximal stretches of words that repeat a block four times or more.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and a length of at least ``max(SHORTEST, TIMES * q)`` that no
neighbouring word extends keeping q. Where words q apart agree over [begin, end)
the run is [begin, end + q).

Scale-tiled distribution. The periods from B = 2^k to 2B - 1 are one octave. A
document is exploded into tiles; a tile has boundaries every B words. From each
boundary the window of 2B words is compared with those B to 2B - 1 words on:
every run of the octave holds such a boundary, because it is at least 4B long.
For pairs that agree, the boundary's Z-values, forward and backward, are taken
up to 4B words. They make an interval fragment. Multiples of a shorter period
are dropped: the stretch seen is over two periods long, so it has the shorter
period exactly if the whole run has it. Neighbouring boundaries see overlapping
fragments, so their union is the whole run.

Documents up to ``tile`` words are one tile for all their octaves. Longer ones
become rows of overlapping tiles, one set for the octaves up to ``tile`` / 16 and
one set for each octave above, dealt over the cluster and solved apart. The
fragments, joined within a tile, meet by document and period, where overlapping
ones are stitched. Words are compared by 64-bit hashes.

Defined cases: null and empty texts have no words and no runs; repeated rows and
ids are documents of their own; columns that are named like the added ones are
replaced; an empty table gives no rows.
"""

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vialens.functions.let import let
from vialens.llm.bytewords import bounds, mix, ragged, span_hashes, text_chunks, word_spans
from vialens.llm.shared import partitions, settle

SHORTEST = 6
TIMES = 4
TILE_WORDS = 1 << 14
#: Cells compared at once while fragments are extended.
_CELLS = 1 << 20

_ADDED = ("n_words", "runs", "collapsed_sha256", "collapsed")


# tiles


def tiles(n: int, tile: int) -> list[tuple[int, int, int, int]]:
    """(first octave, octave after the last, first word, word after the last) of a document's tiles.

    A boundary sees 4B words back and 6B words on; overlaps of 12B let the
    boundaries of both tiles be whole around a seam.
    """
    top = max(1, (max(n, TIMES) // TIMES).bit_length())
    if n <= tile:
        return [(0, top, 0, n)]
    shared = max(1, (tile // 16).bit_length())
    groups = [(0, min(shared, top), tile)]
    groups += [(k, k + 1, 16 << k) for k in range(shared, top)]
    out = []
    for low, high, core in groups:
        b = 1 << (high - 1)
        out += [(low, high, max(0, at - 4 * b), min(n, at + core + 8 * b)) for at in range(0, n, core)]
    return out


def _smallest_factors(n: int) -> np.ndarray:
    """The smallest prime factor of every number up to n."""
    out = np.arange(n + 1)
    for p in range(2, int(n**0.5) + 1):
        if out[p] == p:
            multiples = out[p * p :: p]
            multiples[multiples == np.arange(p * p, n + 1, p)] = p
    return out


def _primitive(windows: np.ndarray, at: np.ndarray, period: np.ndarray, factors) -> np.ndarray:
    """Which stretches, known to have ``period``, have no shorter one that divides it."""
    keep = np.ones(len(at), bool)
    rest = period.copy()
    while (rest > 1).any():
        p = factors[rest]
        short = period // np.maximum(p, 1)
        left = windows[at] == windows[at + short]
        left &= windows[at + period - short] == windows[at + period]
        keep &= ~(left & (rest > 1))
        rest = np.where(rest % np.maximum(p, 2) == 0, rest // np.maximum(p, 1), rest)
    return keep


def _extended(words: np.ndarray, at: np.ndarray, period: np.ndarray, reach: int):
    """(begin, end) of the agreement around every boundary, up to ``reach`` words each way."""
    begin, end = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    steps = np.arange(reach)
    step = max(1, _CELLS // reach)
    for i in range(0, len(at), step):
        c, q = at[i : i + step, None], period[i : i + step, None]
        for side, out in ((c + steps, end), (c - 1 - steps, begin)):
            inner = (side >= 0) & (side + q < len(words))
            a = np.where(inner, side, 0)
            differ = (words[a] != words[np.where(inner, side + q, 0)]) | ~inner
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), reach)
            out[i : i + step] = c[:, 0] + first if out is end else c[:, 0] - first
    return begin, end


def _joined(period: np.ndarray, begin: np.ndarray, end: np.ndarray, n: int):
    """Overlapping and touching intervals of a period as one."""
    order = np.lexsort((begin, period))
    period, begin, end = period[order], begin[order], end[order]
    line = np.cumsum(np.diff(period, prepend=period[:1]) > 0) * (n + 1)
    reached = np.maximum.accumulate(end + line)
    new = np.ones(len(period), bool)
    new[1:] = begin[1:] + line[1:] > reached[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(period)) - 1
    return period[first], begin[first], reached[last] - line[last]


def fragments(words: np.ndarray, owner: np.ndarray, sizes: np.ndarray, low: int, high: int):
    """(period, begin, end) where words a period apart agree, for octaves low to high - 1.

    ``words`` are hashes; a separator that equals no other word stands before
    and after every text. ``owner`` is the text of each word (a text's closing
    separator counts as its own), ``sizes`` the number of words of each text.
    """
    windows, origin, found = words, np.arange(len(words)), []
    owner = owner.copy()
    factors = _smallest_factors(2 << high)
    for k in range(high):
        b = 1 << k
        alive = sizes[owner] >= TIMES * b
        if alive.sum() < 0.7 * len(origin):
            # windows that leave a text hold its separator, so none of them agrees with another
            kept = np.flatnonzero(alive)
            origin, owner = origin[kept], owner[kept]
            windows = windows[kept[: np.searchsorted(kept, len(windows))]]
        if len(windows) <= 2 * b:
            break
        windows = mix(windows[:-b], windows[b:])
        if k < low:
            continue
        blocks = len(windows) // b
        body = windows[: blocks * b].reshape(blocks, b)
        pairs = []
        if b <= 8:
            for r in range(b):
                j = np.flatnonzero(body[1:, r] == body[:-1, 0])
                pairs.append((j * b, np.full(len(j), b + r)))
        else:
            j, r = np.nonzero(body[1:] == body[:-1, :1])
            pairs.append((j * b, b + r))
        if blocks and blocks * b < len(windows):
            r = np.flatnonzero(windows[blocks * b :] == windows[(blocks - 1) * b])
            pairs.append((np.full(len(r), (blocks - 1) * b), b + r))
        at = np.concatenate([p[0] for p in pairs])
        period = np.concatenate([p[1] for p in pairs])
        keep = _primitive(windows, at, period, factors)
        at, period = origin[at[keep]], period[keep]
        begin, end = _extended(words, at, period, 4 * b)
        enough = end - begin >= np.maximum((TIMES - 1) * period, SHORTEST - period)
        keep = enough | (end - at == 4 * b) | (at - begin == 4 * b)
        found.append((period[keep], begin[keep], end[keep]))
    period, begin, end = (
        np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in range(3)
    )
    return _joined(period, begin, end, len(words)) if len(period) else (period, begin, end)


def _lined_up(hashes: np.ndarray, document: np.ndarray, n: int):
    """(words with separators, owner of each, place of each text's first word, sizes)."""
    sizes = np.bincount(document, minlength=n)
    first = bounds(sizes + 1)[:-1] + 1
    seps = mix(np.arange(n + 1, dtype=np.uint64), np.full(n + 1, 0x5EBA, np.uint64))
    words = np.empty(len(hashes) + n + 1, np.uint64)
    words[0] = seps[n]
    words[first + sizes] = seps[:n]
    words[ragged(first, sizes)] = hashes
    owner = np.repeat(np.arange(n), sizes + 1)
    return words, np.concatenate([owner[:1], owner]), first, sizes


# the distributed job


_FOUND = "period long, begin long, end long"
_TILE = "low long, high long, first long, tile string"


def _solved(docs: DataFrame, tile: int, texts: bool) -> DataFrame:
    """Documents, fragments and the tiles of long documents; (row, text) come in.

    A document row has ``text`` only if something may have to go from it (or
    ``texts`` is set), and else the digest of its words.
    """
    schema = T.StructType().add("key", "long").add("n_words", "long")
    schema = schema.add("row", docs.schema["row"].dataType).add("text", "string").add("digest", "string")
    for column in f"{_FOUND}, {_TILE}".split(", "):
        schema = schema.add(*column.split())
    names = schema.names

    def solve(batches: Iterator[pa.RecordBatch]):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            raw = batch.column(1).cast(pa.large_binary())
            for chunk in text_chunks(raw):
                starts, lengths, document = word_spans(chunk)
                hashes = span_hashes(chunk.data, starts, lengths)
                sizes = np.bincount(document, minlength=chunk.n)
                small = (sizes <= tile)[document]
                renamed = np.cumsum(sizes <= tile) - 1
                kept = np.flatnonzero(sizes <= tile)
                period = begin = end = at = np.zeros(0, np.int64)
                if small.any():
                    words, owner, first, n = _lined_up(hashes[small], renamed[document[small]], len(kept))
                    top = tiles(int(n.max()), tile)[0][1]
                    period, begin, end = fragments(words, owner, n, 0, top)
                    at = owner[begin]
                    begin, end = begin - first[at], end - first[at]
                    ok = end - begin >= np.maximum((TIMES - 1) * period, SHORTEST - period)
                    period, begin, end, at = period[ok], begin[ok], end[ok], kept[at[ok]]
                marked = sizes > tile
                marked[at] = True
                split = [chunk.text(i).split() for i in range(chunk.n)]
                out = {c: [] for c in names if c != "row"}

                def emit(**values):
                    for c in out:
                        out[c].append(values.get(c))  # noqa: B023

                for i in range(chunk.n):
                    whole = b" ".join(split[i])
                    keep = texts or marked[i]
                    emit(
                        key=number + i,
                        n_words=int(sizes[i]),
                        text=whole.decode() if keep else None,
                        digest=None if keep else hashlib.sha256(whole).hexdigest(),
                    )
                places = list(range(chunk.first, chunk.first + chunk.n))
                for i, q, a, b in zip(*(v.tolist() for v in (at, period, begin, end)), strict=True):
                    emit(key=number + i, period=q, begin=a, end=b)
                for i in np.flatnonzero(sizes > tile).tolist():
                    for low, high, a, b in tiles(int(sizes[i]), tile):
                        part = b" ".join(split[i][a:b]).decode()
                        emit(key=number + i, low=low, high=high, first=a, tile=part)
                number += chunk.n
                places += [None] * (len(out["key"]) - chunk.n)
                rows = batch.column(0).take(pa.array(places, pa.int64()))
                kinds = {c: pa.string() if c in ("text", "digest", "tile") else pa.int64() for c in out}
                columns = [rows if c == "row" else pa.array(out[c], kinds[c]) for c in names]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(solve, schema)


def _of_tiles(solved: DataFrame) -> DataFrame:
    """(key, period, begin, end) fragments of the tiles of long documents."""

    def solve(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                key, low, high, first = (batch.column(c)[i].as_py() for c in range(4))
                for chunk in text_chunks(batch.column(4).slice(i, 1)):
                    starts, lengths, document = word_spans(chunk)
                    hashes = span_hashes(chunk.data, starts, lengths)
                    words, owner, at, n = _lined_up(hashes, document, 1)
                    period, begin, end = fragments(words, owner, n, low, high)
                    shift = first - at[0]
                    columns = [np.full(len(period), key), period, begin + shift, end + shift]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in columns], ["key", "period", "begin", "end"]
                    )

    rows = solved.filter("tile is not null").select("key", "low", "high", "first", "tile")
    dealt = rows.repartition(partitions(solved.sparkSession), "key", "low", "first")
    return dealt.mapInArrow(solve, f"key long, {_FOUND}")


def stitched(found: DataFrame) -> DataFrame:
    """(key, start, length, period): the runs that fragments (key, period, begin, end) add up to."""
    along = Window.partitionBy("key", "period").orderBy("begin", "end")
    reached = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opened = found.withColumn("_new", (reached.isNull() | (F.col("begin") > reached)).cast("int"))
    islands = opened.withColumn("_island", F.sum("_new").over(along))
    whole = islands.groupBy("key", "period", "_island").agg(
        F.min("begin").alias("start"), F.max("end").alias("_end")
    )
    runs = whole.select(
        "key", "start", (F.col("_end") - F.col("start") + F.col("period")).alias("length"), "period"
    )
    return runs.filter(F.col("length") >= F.greatest(F.lit(SHORTEST), TIMES * F.col("period")))


def periodic_runs(
    docs: DataFrame, text: str = "text", texts: bool = False, tile: int = TILE_WORDS
) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``n_words``, ``runs`` and ``collapsed_sha256``.

    ``runs`` are (start, period, length), sorted. The collapsed text has the
    words left when of every run only its first period stays, joined by one
    space; its digest is that of the UTF-8 bytes. With ``texts`` the text itself
    is in ``collapsed``.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text and c not in _ADDED]
    rows = docs.select(F.struct(F.lit(None).cast("int").alias("_"), *rest).alias("row"), F.col(f"`{text}`").alias("text"))
    solved = settle(_solved(rows, tile, texts), compression="zstd")
    found = solved.filter("period is not null").select("key", "period", "begin", "end")
    runs = stitched(found.union(_of_tiles(solved)))
    one = F.struct("start", "period", "length")
    by_document = runs.groupBy("key").agg(F.array_sort(F.collect_list(one)).alias("runs"))
    whole = solved.filter("n_words is not null").select("key", "row", "n_words", "text", "digest")
    joined = whole.join(by_document, "key", "left").select("row", "n_words", "text", "digest", "runs")
    schema = T.StructType([joined.schema[c] for c in ("row", "n_words", "runs")])
    schema = schema.add("digest", "string").add("text", "string")

    def collapse(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            all_runs = batch.column(4)
            digests, kept = batch.column(3).to_pylist(), batch.column(2).to_pylist()
            for i in [i for i, t in enumerate(kept) if t is not None]:
                words = kept[i].split(" ") if kept[i] else []
                mark = np.zeros(len(words) + 1, np.int64)
                for run in all_runs[i].as_py() or []:
                    mark[run["start"] + run["period"]] += 1
                    mark[run["start"] + run["length"]] -= 1
                left = " ".join(compress(words, (np.cumsum(mark)[:-1] == 0).tolist()))
                digests[i] = hashlib.sha256(left.encode()).hexdigest()
                kept[i] = left if texts else None
            columns = [batch.column(0), batch.column(1), all_runs, pa.array(digests, pa.string()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    done = joined.mapInArrow(collapse, schema)
    columns = [F.col(f"row.`{c}`") for c in docs.columns if c != text and c not in _ADDED]
    none = F.array().cast(joined.schema["runs"].dataType)
    return done.select(
        *columns,
        "n_words",
        F.coalesce("runs", none).alias("runs"),
        F.col("digest").alias("collapsed_sha256"),
        *([F.col("text").alias("collapsed")] if texts else []),
    )


# the query


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text), the text of every document whose crc32 ends in 0 with a periodic tail.

    With h the crc32 of the decimal id, g = h div 10 and n words, the words from
    a = g % n on repeat the first 1 + (n - a) div (3 + g % 8) of them. Null ids
    have no crc32 and keep their text.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        block = F.slice(words, a + 1, p)
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), n - a)
        changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
        return F.when(n > 0, changed).otherwise("")

    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    text = F.when((h % 10 == 0) & F.col("text").isNotNull(), let(words, repeated))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.otherwise(F.col("text")).alias("text"))


def run_report(docs: DataFrame, tile: int = TILE_WORDS) -> DataFrame:
    """Every document's longest run, and digests of all its runs and of what is left without them."""
    found = periodic_runs(planted(docs), tile=tile)
    runs = F.col("runs")
    by_length = F.array_sort(
        F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    )
    best = F.get(by_length, F.lit(0))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    lines = F.array_join(F.transform(runs, line), "")
    length, period = -best["l"], best["p"]
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        best["s"].alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        "collapsed_sha256",
        "n_words",
    )
