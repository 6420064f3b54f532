"""Packing token sequences of one length, as a cutting-stock problem.

A document's ids are cut into whole blocks of ``length`` and a rest. Whole blocks
are sequences of their own. Rests are counted in ``CLASSES`` classes of equal
width; how many of which class share a sequence is a pattern.

Column generation. The linear program takes as few patterns as cover the
histogram. It starts with patterns of one class; its dual prices go into a
knapsack, solved by dynamic programming over the sequence's width, and the most
valuable pattern enters the basis by a simplex step, until no pattern is worth
more than it costs (to a gap of ``GAP``, or after ``STEPS``). The driver sees the histogram alone,
``CLASSES`` numbers whatever the size of the corpus. Patterns are taken as often
as the solution says, rounded down; what is left is filled up by falling class.
Documents are ranked within their class, slice after slice, and a rank gives
pattern, copy and place by arithmetic.

Rounding to classes leaves gaps of a few tokens. Rests under ``CRUMB`` tokens and
every ``SPARE``-th other rest are kept back as filler: laid end to end they are
cut where the gaps, laid end to end, are. What no gap needs makes sequences of
its own, and its last tokens go into sequences whose sizes are powers of two. A
sequence keeps padding only if the filler runs out.

Defined cases: null texts are empty and have the end id alone; repeated rows and
ids are documents of their own; other columns take no part; no rows give no
sequences.
"""

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vialens.llm.bytewords import Chunk, bounds, ragged, text_chunks, word_spans
from vialens.llm.shared import settle
from vialens.llm.units import Units, worker_state

CLASSES = 256
CRUMB = 64
SPARE = 32
GAP = 1e-3
#: Simplex steps; a basis covers the histogram at every step, so stopping costs no document its place.
STEPS = 2000

#: The split of words after which no token holds white space; other rules encode whole documents.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


# patterns


def _knapsack(value: np.ndarray, size: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """(worth, how many of each) of the most valuable filling; items repeat at will."""
    worths = np.full(capacity, -np.inf)
    worths[size - 1] = value
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for w in range(1, capacity + 1):
        worth = best[w - 1 :: -1] + worths[:w]
        i = worth.argmax()
        if worth[i] > best[w - 1] + 1e-12:
            best[w], choice[w] = worth[i], i + 1
        else:
            best[w] = best[w - 1]
    pattern, w = np.zeros(capacity, np.int64), capacity
    while w > 0:
        if choice[w] < 0:
            w -= 1
        else:
            pattern[choice[w] - 1] += 1
            w -= choice[w]
    return best[capacity], pattern[size - 1]


def relaxed(size: np.ndarray, count: np.ndarray, capacity: int, gap: float = GAP):
    """(patterns by row, how often) of the linear program; ``size`` ascends, ``count`` is positive."""
    m = len(size)
    count = count + 1e-4 * (1 + np.arange(m) / m)  # no ties among the rows, so no circles
    columns = np.diag(capacity // size).astype(float)
    cost, inverse = np.ones(m), np.diag(1 / (capacity // size))
    often = inverse @ count
    for _ in range(STEPS):
        price = cost @ inverse
        worth, pattern = _knapsack(price, size, capacity)
        enter, price_of = pattern.astype(float), 1.0
        if price.min() < -1e-9:  # more of a class than there is would be cheaper
            enter, price_of = np.zeros(m), 0.0
            enter[price.argmin()] = -1.0
        elif worth <= 1 + 1e-9 or price @ count / worth >= (1 - gap) * (cost @ often):
            break
        step = inverse @ enter
        ratio = np.full(m, np.inf)
        up = step > 1e-9
        ratio[up] = often[up] / step[up]
        r = ratio.argmin()
        columns[:, r], cost[r] = enter, price_of
        often = np.maximum(often - ratio[r] * step, 0)
        often[r] = ratio[r]
        inverse[r] /= step[r]
        step[r] = 0
        inverse -= step[:, None] * inverse[r]
    real = cost > 0
    return columns[:, real].T.round().astype(np.int64), often[real]


def cutting_stock(count: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(pattern, how often) that use up ``count`` exactly; ``count[c]`` items have size c + 1."""
    left = np.asarray(count, np.int64).copy()
    size = np.arange(1, len(left) + 1)
    have = np.flatnonzero(left)
    out = []

    def use(pattern, times):
        if times > 0:
            out.append((pattern, int(times)))
            left[:] -= times * pattern

    if len(have):
        found, often = relaxed(size[have], left[have].astype(float), capacity)
        for i in np.argsort(-(found @ size[have]), kind="stable"):
            pattern = np.zeros(len(left), np.int64)
            pattern[have] = found[i]
            held = pattern > 0
            use(pattern, min(int(often[i] + 1e-6), (left[held] // pattern[held]).min()))
    while left.any():
        pattern, room = np.zeros(len(left), np.int64), capacity
        for c in np.flatnonzero(left)[::-1]:
            pattern[c] = min(left[c], room // size[c])
            room -= pattern[c] * size[c]
        held = pattern > 0
        use(pattern, (left[held] // pattern[held]).min())
    return out


class _Places:
    """Sequence and place there of the item of a given rank in its class."""

    def __init__(self, patterns: list[tuple[np.ndarray, int]], whole: int, classes: int):
        self.n = sum(times for _, times in patterns)
        self.rank, self.base, self.each = ([[] for _ in range(classes)] for _ in range(3))
        done, sequence = np.zeros(classes, np.int64), 0
        for pattern, times in patterns:
            for c in np.flatnonzero(pattern).tolist():
                self.rank[c].append(int(done[c]))
                self.base[c].append(sequence)
                self.each[c].append(int(pattern[c]))
            done[: len(pattern)] += times * pattern
            sequence += times
        # items that fill a sequence
        self.rank[-1], self.base[-1], self.each[-1] = [0], [sequence], [1]
        self.n += whole

    def __call__(self, c: int, rank: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.rank[c], rank, "right") - 1
        first, base, each = (np.array(x[c], np.int64)[at] for x in (self.rank, self.base, self.each))
        return base + (rank - first) // each


# tokens


class ByWords:
    """A tokenizer of the tokenizers library, fed with distinct words.

    Where its rules take white space out before any token is made, what stands
    between ASCII white space is encoded by itself, each distinct word once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.units = Units(self._contents)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        normal = spec.get("normalizer") or {}
        normal = normal.get("normalizers", [normal] if normal else [])
        before = spec.get("pre_tokenizer") or {}
        before = before.get("pretokenizers", [before])
        self.by_words = (
            all(
                x["type"] in ("NFC", "Lowercase")
                or x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} and x["content"] == " "
                for x in normal
            )
            and before[0].get("type") == "Split"
            and before[0]["pattern"] == {"Regex": _WORDS}
            and before[0]["behavior"] == "Removed"
            and before[0]["invert"]
            and all(x["type"] == "ByteLevel" and not x["add_prefix_space"] for x in before[1:])
            and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in spec["added_tokens"])
        )

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, number of ids of each)."""
        if self.by_words:
            starts, lengths, document = word_spans(chunk)
        else:
            starts, lengths, document = chunk.offsets[:-1], np.diff(chunk.offsets), np.arange(chunk.n)
        ids, counts = self.units.ids_of(chunk, starts, lengths)
        return ids, np.bincount(document, counts, chunk.n).astype(np.int64)

    def _contents(self, contents: list[bytes]) -> list[bytes]:
        found = self.library.encode_batch_fast([c.decode() for c in contents], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]


def _loaded(path: str) -> ByWords:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return worker_state(f"by_words:{path}", lambda: ByWords(path))


_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("slice", pa.int64()),
        ("class", pa.int64()),
        ("rank", pa.int64()),
        ("ids", pa.binary()),
    ]
)
_PIECE_SQL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, slice long, "
    "class long, rank long, ids binary"
)
_FILLER = -1


def _ranked(classes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Number of each item in its class; ``seen`` has the items before, and is brought forward."""
    order = np.argsort(classes, kind="stable")
    n = np.bincount(classes, minlength=len(seen))
    out = np.empty(len(classes), np.int64)
    out[order] = ragged(seen, n)
    seen += n
    return out


def _pieces(docs: DataFrame, tokenizer: str, length: int, end_id: int, ids: bool) -> DataFrame:
    """Whole blocks and rests with their class (its width is ``length`` / ``CLASSES``) and rank in the slice.

    Filler has class -1 and for its rank the filler's tokens before it in the
    slice; it always brings its ids.
    """
    width = length // CLASSES

    def cut(batches: Iterator[pa.RecordBatch]):
        encoder, part = _loaded(tokenizer), TaskContext.get().partitionId()
        seen, rests, filled = np.zeros(CLASSES, np.int64), part, 0
        for batch in batches:
            for chunk in text_chunks(batch.column(1)):
                found, counts = encoder.encode(chunk)
                found = np.insert(found, np.cumsum(counts), end_id).astype("<u4")
                counts = counts + 1
                first = bounds(counts)[:-1]
                n_pieces = -(-counts // length)
                document = np.repeat(np.arange(chunk.n), n_pieces)
                start = ragged(np.zeros(chunk.n, np.int64), n_pieces) * length
                size = np.minimum(length, counts[document] - start)
                kind = -(-size // width) - 1
                rest = size < length
                number = rests + np.cumsum(rest)
                rests += int(rest.sum())
                filler = rest & ((size < CRUMB) | (number % SPARE == 0))
                rank = np.empty(len(size), np.int64)
                rank[~filler] = _ranked(kind[~filler], seen)
                ends = filled + np.cumsum(size[filler])
                rank[filler] = ends - size[filler]
                filled = int(ends[-1]) if len(ends) else filled
                raw = memoryview(found).cast("B")
                begin = (first[document] + start) * 4
                spans = list(zip(begin.tolist(), (begin + size * 4).tolist(), filler.tolist(), strict=True))
                columns = [
                    batch.column(0).slice(chunk.first, chunk.n).take(pa.array(document)),
                    start,
                    size,
                    [zlib.crc32(raw[a:b]) for a, b, _ in spans],
                    counts[document],
                    np.full(len(size), part),
                    np.where(filler, _FILLER, kind),
                    rank,
                    pa.array([raw[a:b].tobytes() if ids or f else None for a, b, f in spans], pa.binary()),
                ]
                arrays = [pa.array(c, t) for c, t in zip(columns, _PIECE.types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_PIECE)

    return docs.mapInArrow(cut, _PIECE_SQL)


# sequences


def _before(sums: DataFrame, order: str, *by: str) -> DataFrame:
    """(by, order, before): the sum of ``n`` over the earlier rows; few rows a key."""
    earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*by, order, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def _in_sequences(pieces: DataFrame, places: _Places) -> DataFrame:
    """Pieces of classes with ``sequence_id`` and ``offset``."""
    sizes = pieces.groupBy("class", "slice").agg(F.count("*").alias("n"))
    shifted = pieces.join(_before(sizes, "slice", "class"), ["class", "slice"])
    shifted = shifted.withColumn("rank", F.col("rank") + F.col("before")).drop("before", "slice")
    names = shifted.columns
    kind, rank = names.index("class"), names.index("rank")

    def place(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            kinds, ranks = (batch.column(i).to_numpy() for i in (kind, rank))
            sequence = np.empty(len(kinds), np.int64)
            for c in np.unique(kinds).tolist():
                of = kinds == c
                sequence[of] = places(c, ranks[of])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence)], [*names, "sequence_id"])

    schema = ", ".join(f"`{c}` {t}" for c, t in shifted.dtypes) + ", sequence_id long"
    placed = shifted.mapInArrow(place, schema)
    along = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank")
    earlier = F.sum("length").over(along.rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(earlier, F.lit(0))).drop("class", "rank")


def _gaps(used: DataFrame, length: int) -> DataFrame:
    """(sequence_id, offset, begin, size): what is missing at the end of sequences, laid end to end.

    ``used`` has (sequence_id, used); sizes that are a power of two are not padded.
    """
    power = (F.bit_count("used") == 1) | (F.col("used") == length)
    gaps = used.filter(~power).select("sequence_id", F.col("used").alias("offset"), (length - F.col("used")).alias("size"))
    gaps = gaps.withColumn("block", F.shiftright("sequence_id", 12))
    sums = gaps.groupBy("block").agg(F.sum("size").alias("n"))
    along = Window.partitionBy("block").orderBy("sequence_id").rowsBetween(Window.unboundedPreceding, -1)
    inner = gaps.withColumn("begin", F.coalesce(F.sum("size").over(along), F.lit(0)))
    joined = inner.join(_before(sums, "block"), "block")
    return joined.select("sequence_id", "offset", (F.col("begin") + F.col("before")).alias("begin"), "size")


def _more_gaps(spark, first: int, begin: int, size: int, length: int) -> DataFrame:
    """Sequences for filler that no gap takes: whole ones, and the binary digits of what is left."""
    whole = spark.range(size // length).select(
        (F.col("id") + first).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        (F.col("id") * length + begin).alias("begin"),
        F.lit(length).cast("long").alias("size"),
    )
    first, begin, rest = first + size // length, begin + size // length * length, size % length
    tail = []
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            tail.append((first + len(tail), 0, begin, 1 << bit))
            begin += 1 << bit
    return whole.union(spark.createDataFrame(tail, "sequence_id long, offset long, begin long, size long"))


def _laid(filler: DataFrame, gaps: DataFrame, length: int) -> DataFrame:
    """Filler cut where the gaps are; both are intervals laid end to end."""
    blocks = lambda begin, size: F.explode(
        F.sequence(F.floor(F.col(begin) / length), F.floor((F.col(begin) + F.col(size) - 1) / length))
    )
    sums = filler.groupBy("slice").agg(F.sum("length").alias("n"))
    laid = filler.join(_before(sums, "slice"), "slice")
    laid = laid.withColumn("at", F.col("rank") + F.col("before"))
    laid = laid.select("doc_id", "start", "length", "doc_tokens", "ids", "at", blocks("at", "length").alias("block"))
    gaps = gaps.select("*", blocks("begin", "size").alias("block"))
    low = F.greatest("at", "begin")
    high = F.least(F.col("at") + F.col("length"), F.col("begin") + F.col("size"))
    met = laid.join(gaps, "block").withColumns({"low": low, "high": high})
    met = met.filter("low < high").filter(F.floor(F.col("low") / length) == F.col("block"))
    size, skipped = F.col("high") - F.col("low"), F.col("low") - F.col("at")
    ids = F.substring("ids", (skipped * 4 + 1).cast("int"), (size * 4).cast("int"))
    return met.select(
        "doc_id",
        (F.col("start") + skipped).alias("start"),
        size.alias("length"),
        F.crc32(ids).alias("ids_crc32"),
        "doc_tokens",
        ids.alias("ids"),
        "sequence_id",
        (F.col("offset") + F.col("low") - F.col("begin")).alias("offset"),
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 4096,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    ids: bool = True,
) -> DataFrame:
    """A row for every piece: where it comes from and where it lies.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), and
    ``ids``, little-endian unsigned 32-bit numbers in a binary column, unless
    ``ids=False``. ``start`` counts the document's ids before the piece;
    ``doc_tokens`` counts the end id.
    """
    if length % CLASSES or length & (length - 1):
        raise ValueError(f"length is a power of two and a multiple of {CLASSES}")
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    pieces = settle(_pieces(rows, tokenizer, length, end_id, ids), compression="zstd")
    # one row a class
    counts = {r["class"]: (r.n, r.tokens) for r in pieces.groupBy("class").agg(F.count("*").alias("n"), F.sum("length").alias("tokens")).collect()}
    count = np.zeros(CLASSES, np.int64)
    for c, (n, _) in counts.items():
        if c != _FILLER:
            count[c] = n
    places = _Places(cutting_stock(count[:-1], CLASSES), int(count[-1]), CLASSES)
    extra = [] if ids else ["ids"]
    placed = settle(_in_sequences(pieces.filter(F.col("class") != _FILLER).drop(*extra), places), compression="zstd")
    gaps = settle(_gaps(placed.groupBy("sequence_id").agg(F.sum("length").alias("used")), length))
    room = gaps.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    _, tokens = counts.get(_FILLER, (0, 0))
    if tokens > room:
        gaps = gaps.union(_more_gaps(spark, places.n, room, tokens - room, length))
    filled = _laid(pieces.filter(F.col("class") == _FILLER), gaps, length)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    names += ["ids"] if ids else []
    return placed.select(names).union(filled.select(names))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, offsets): the packed sequences, without padding."""
    part = F.struct("offset", "doc_id", "ids")
    grouped = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return grouped.select(
        "sequence_id", joined.alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets")
    )
