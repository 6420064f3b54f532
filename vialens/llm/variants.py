"""Spelling variants: words one code point apart, grouped under their most frequent form.

Two words are near if one inserted, deleted or replaced code point makes one the
other. A word's form is its near word of the largest count (ties: the smaller
word in code-point order), if that count is at least ``ratio`` times its own; its
root is where the forms lead to in the end. Counts grow along the way, so there
are no circles.

Trie-node pair dictionary. The distinct words in order are cut into slices by
bounds, and each slice is read once from top to bottom: the prefix a word shares
with the one before keeps its nodes of the forward trie, every other prefix gets
a new number. A prefix that reaches over a bound is a prefix of the bound itself;
such nodes are numbered by the first bound that has them, alike in every slice.
The reversed words give the nodes of the reversed trie. A word of n code points
enters the dictionary with the pairs (node of the i code points before, node of
the code points after place i), once with place i skipped and once with a letter
to be inserted there. Two words that skip a place and meet in a pair differ by a
replacement; one that skips and one that inserts, by an insertion. Nodes that
hold one word only can't bring two together and are left out.

A pair determines all but one code point, so it holds at most one word for every
letter, and one more. Each of its words gets the number of its partners and the
best of them; no pairs of words are made. Of a run of equal letters only the
first is skipped towards an insertion, so each near word counts once.

``BOUND_ROWS`` words a slice, taken by hash, are sampled to find the bounds. They
decide which task numbers a word, and nothing else.

Defined cases: null and empty texts have no words; equal rows add to the counts;
a null id leaves the words of its text as they are; an empty table, or one
without words often enough, gives no rows. Other columns take no part.
"""

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialens.llm.bytewords import LONG, LOWER, Chunk, span_hashes, text_chunks
from vialens.llm.shared import partitions, settle
from vialens.llm.units import same_bytes

BOUND_ROWS = 32
#: Code points of a bound; longer prefixes don't cut finer.
BOUND_LENGTH = 32

#: The first byte of U+00C0 to U+00FF in UTF-8; any byte may follow it.
_LATIN = 0xC3

_SKIP_FIRST, _SKIP, _INSERT = 0, 1, 2


# words


def letter_spans(chunk: Chunk):
    """(starts, lengths, code points, document) of the runs of [a-z\\u00C0-\\u00FF] in lowered bytes."""
    n = int(chunk.offsets[-1])
    data = chunk.data[:n]
    latin = data == _LATIN
    inside = (data >= 97) & (data <= 122) | latin
    inside[1:] |= latin[:-1]
    first = np.zeros(n + 1, bool)
    first[chunk.offsets] = True
    edge = np.ones(n + 1, bool)
    edge[1:n] = ~inside[:-1] | first[1:n]
    starts = np.flatnonzero(inside & edge[:n])
    edge[1:n] = ~inside[1:] | first[1:n]
    ends = np.flatnonzero(inside & edge[1:]) + 1
    seconds = np.zeros(n + 1, np.int64)
    np.cumsum(latin, out=seconds[1:])
    points = ends - starts - (seconds[ends] - seconds[starts])
    return starts, ends - starts, points, np.searchsorted(chunk.offsets, starts, "right") - 1


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def continued_crc32(data: np.ndarray, starts, lengths, before: np.ndarray) -> np.ndarray:
    """crc32 of every span, going on from the crc32 ``before`` of what stands in front of it."""
    state = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    active, at = np.flatnonzero((lengths > 0) & (lengths <= LONG)), 0
    while len(active):
        now = state[active]
        state[active] = _CRC[(now ^ data[starts[active] + at]) & 0xFF] ^ (now >> 8)
        at += 1
        active = active[lengths[active] > at]
    state ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > LONG):
        state[i] = zlib.crc32(data[starts[i] : starts[i] + lengths[i]], int(before[i]))
    return state


def word_counts(docs: DataFrame, shortest: int, least: int, slips: int | None = None) -> DataFrame:
    """(word, n): words of ``shortest`` code points or more that occur ``least`` times or more.

    ``docs`` has (doc_id, text). With ``slips``, a word loses a code point where
    ``slips`` divides the crc32 h of ``<doc_id>:<word>``: that at h % length.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text"))

    def count(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for chunk in text_chunks(batch.column(1), table=LOWER):
                starts, lengths, points, document = letter_spans(chunk)
                keep = np.flatnonzero(points >= shortest)
                starts, lengths, points, document = (
                    x[keep] for x in (starts, lengths, points, document)
                )
                changed = []
                if slips and len(starts):
                    names = ids[chunk.first : chunk.first + chunk.n]
                    before = np.array([zlib.crc32(f"{i}:".encode()) for i in names], np.uint32)
                    named = np.array([i is not None for i in names])
                    h = continued_crc32(chunk.data, starts, lengths, before[document])
                    slip = (h % slips == 0) & named[document]
                    for i in np.flatnonzero(slip).tolist():
                        word = chunk.data[starts[i] : starts[i] + lengths[i]].tobytes().decode()
                        at = int(h[i]) % len(word)
                        if len(word) > shortest:
                            changed.append(word[:at] + word[at + 1 :])
                    starts, lengths = starts[~slip], lengths[~slip]
                hashes = span_hashes(chunk.data, starts, lengths)
                _, first, which, n = np.unique(
                    hashes, return_index=True, return_inverse=True, return_counts=True
                )
                of = first[which]
                if not same_bytes(chunk.data, starts, lengths, chunk.data, starts[of], lengths[of]):
                    first, n = np.arange(len(starts)), np.ones(len(starts), np.int64)
                data = chunk.data.tobytes()
                words = [data[a : a + m].decode() for a, m in zip(starts[first].tolist(), lengths[first].tolist(), strict=True)]
                counts = n.tolist() + [1] * len(changed)
                columns = [pa.array(words + changed, pa.string()), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["word", "n"])

    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least)


# tries


def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


class _Bounds:
    """Bounds of the slices, and the numbers of the nodes on their paths (all negative)."""

    def __init__(self, bounds: list[str]):
        self.bounds, self.paths = bounds, []
        for j, b in enumerate(bounds):
            path = [-1 - (j * (BOUND_LENGTH + 1) + d) for d in range(len(b) + 1)]
            if j:
                n = _shared(bounds[j - 1], b) + 1
                path[:n] = self.paths[-1][:n]
            self.paths.append(path)

    def around(self, part: int) -> list[tuple[str, list[int]]]:
        return [(self.bounds[j], self.paths[j]) for j in (part - 1, part) if 0 <= j < len(self.bounds)]


def _sample_bounds(words: DataFrame, n: int) -> _Bounds:
    cut = F.substring("word", 1, BOUND_LENGTH)
    rows = words.orderBy(F.xxhash64("word"), "word").limit(BOUND_ROWS * n).select(cut.alias("b"))
    found = sorted({r.b for r in rows.collect()})
    return _Bounds(found[BOUND_ROWS :: BOUND_ROWS] if n > 1 else [])


def trie_paths(words: DataFrame) -> DataFrame:
    """The columns of ``words`` with ``number`` and ``path``.

    ``word`` is distinct. ``number`` grows with the word in code-point order.
    ``path[d]`` is the trie node of the first d code points, as far as another
    word may share it.
    """
    n = partitions(words.sparkSession)
    bounds = _sample_bounds(words, n)
    names = words.columns
    at = names.index("word")

    def place(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [bisect_right(bounds.bounds, w) for w in batch.column(at).to_pylist()]
            columns = [*batch.columns, pa.array(found, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "part"])

    def number(batches: Iterator[pa.RecordBatch]):
        part, before, path, reach, nodes, row = None, "", [], 0, 0, 0
        waiting = None  # the last row of a batch is written once its successor is known
        for batch in batches:
            parts = batch.column(len(names)).to_pylist()
            numbers, paths = [], []
            for word, p in zip(batch.column(at).to_pylist(), parts, strict=True):
                if p != part:
                    common, edges = 0, bounds.around(p)
                    nodes, row = p << 40, p << 40
                else:
                    common = _shared(before, word)
                if part is not None:
                    paths.append(path[: max(reach, common if p == part else 0) + 1])
                now = path[: common + 1] if p == part else []
                reach = common
                for bound, known in edges:
                    d = _shared(bound, word)
                    now += known[len(now) : d + 1]
                    reach = max(reach, d)
                new = len(word) + 1 - len(now)
                now += range(nodes, nodes + new)
                nodes += new
                part, before, path = p, word, now
                numbers.append(row)
                row += 1
            rows = pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(numbers, pa.int64())], [*names, "number"]
            )
            yield from _with_paths(waiting, rows, paths)
            waiting = rows.slice(rows.num_rows - 1) if rows.num_rows else waiting
        if waiting is not None:
            yield from _with_paths(waiting, waiting.slice(0, 0), [path[: reach + 1]])

    def _with_paths(waiting, rows, paths):
        ready = [waiting] if waiting is not None and paths else []
        ready += [rows.slice(0, max(rows.num_rows - 1, 0))]
        table = pa.Table.from_batches(ready).combine_chunks()
        if table.num_rows:
            column = pa.array(paths, pa.list_(pa.int64()))
            yield from table.append_column("path", column).to_batches()

    schema = ", ".join(f"`{c}` {t}" for c, t in words.dtypes)
    placed = words.mapInArrow(place, f"{schema}, part int").repartition(n, "part")
    ordered = placed.sortWithinPartitions("part", "word")
    return ordered.mapInArrow(number, f"{schema}, number long, path array<long>")


# pairs


def _entries(words: DataFrame) -> DataFrame:
    """(prefix, suffix, number, n, kind): the dictionary's entries; (number, n, word, path, tail) come in."""

    def pairs(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = [[], [], [], [], []]
            for number, n, word, path, tail in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                size, top = len(word), len(path)
                for i in range(max(0, size - len(tail)), min(top, size)):
                    kind = _SKIP if i and word[i - 1] == word[i] else _SKIP_FIRST
                    for column, x in zip(out, (path[i], tail[size - 1 - i], number, n, kind), strict=True):
                        column.append(x)
                for i in range(max(0, size + 1 - len(tail)), min(top, size + 1)):
                    for column, x in zip(out, (path[i], tail[size - i], number, n, _INSERT), strict=True):
                        column.append(x)
            names = ["prefix", "suffix", "number", "n", "kind"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

    schema = "prefix long, suffix long, number long, n long, kind long"
    return words.select("number", "n", "word", "path", "tail").mapInArrow(pairs, schema)


def near_words(words: DataFrame) -> DataFrame:
    """(number, n_near, best): near words and the best of them, for words that have any.

    ``words`` has (word, n, number, path). ``best`` is (fewer, number), the
    negative count and the number of the near word.
    """
    turned = words.select("number", F.reverse("word").alias("word"))
    tails = trie_paths(turned.withColumnRenamed("number", "of")).select(F.col("of").alias("number"), F.col("path").alias("tail"))
    entries = _entries(words.join(tails, "number"))
    one = F.struct((-F.col("n")).alias("fewer"), F.col("number").alias("number"), F.col("kind").alias("kind"))
    met = entries.groupBy("prefix", "suffix").agg(F.collect_list(one).alias("met"))
    met = met.filter(F.size("met") > 1).select(F.array_sort("met").alias("met"))

    def partners(x):
        return F.filter(
            "met",
            lambda y: (y["number"] != x["number"])
            & F.when(y["kind"] == _INSERT, x["kind"] == _SKIP_FIRST)
            .when(x["kind"] == _INSERT, y["kind"] == _SKIP_FIRST)
            .otherwise(True),
        )

    each = met.select(
        F.explode(
            F.transform(
                "met", lambda x: F.struct(x["number"].alias("number"), partners(x).alias("near"))
            )
        ).alias("x")
    ).select("x.number", F.size("x.near").alias("n"), F.get("x.near", F.lit(0)).alias("first"))
    best = F.struct(F.col("first.fewer").alias("fewer"), F.col("first.number").alias("number"))
    return (
        each.filter("n > 0")
        .groupBy("number")
        .agg(F.sum("n").alias("n_near"), F.min(best).alias("best"))
    )


def _roots(links: DataFrame) -> DataFrame:
    """(number, root) of links (number, form); every round doubles the steps taken."""
    steps = settle(links.select("number", F.col("form").alias("root")))
    while True:
        further = steps.select(F.col("number").alias("root"), F.col("root").alias("_next"))
        joined = settle(steps.join(further, "root", "left"))
        if joined.filter("_next is not null").isEmpty():
            return steps
        steps = settle(joined.select("number", F.coalesce("_next", "root").alias("root")))


def variant_groups(counts: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words (word, n)."""
    words = settle(trie_paths(settle(counts.select("word", "n"))))
    near = settle(near_words(words))
    plain = words.select("number", "word", "n")
    judged = plain.join(near, "number", "left")
    fit = -F.col("best.fewer") >= ratio * F.col("n")
    judged = settle(
        judged.select(
            "number",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(fit, F.col("best.number")).alias("form_number"),
            F.when(fit, -F.col("best.fewer")).alias("form_n"),
        )
    )
    links = judged.filter("form_number is not null").select("number", F.col("form_number").alias("form"))
    roots = _roots(links)
    named = links.join(roots, "number")
    for column, name in (("form", "form_word"), ("root", "root_word")):
        other = plain.select(F.col("number").alias(column), F.col("word").alias(name))
        named = named.join(other, column)
    named = named.select("number", F.col("form_word").alias("form"), F.col("root_word").alias("root"))
    return judged.join(named, "number", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, slips: int | None = 31) -> DataFrame:
    """The groups of the words of 7 code points or more that occur twice or more."""
    return variant_groups(word_counts(docs, shortest=7, least=2, slips=slips), ratio=10)
