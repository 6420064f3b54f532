"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

A document's set is its distinct ``n``-word shingles, as 64-bit hashes; with
fewer words, its whole word sequence is its one shingle. Documents with equal
sets form a class, and only classes are compared.

Classes are found by marks. From 67 percent on, a set's marks are the pairs of
shingles next to each other in order of the hash: every shingle that only one of
two sets has parts at most one pair of their ``i`` shared ones, so sets that link
share at least ``i - 1`` pairs less one for each such shingle, half of a set at 75
percent, while texts with some phrases in common share next to none, however
many there are. Below, where that says nothing, the shingles are the marks.

The global order puts common marks last (those counted in many texts of a
chunk, summed over all chunks; at most ``COMMON`` of them are known to the
tasks, which steers the order and never the result). Two sets that share at least
``g`` of their marks share ``s`` of the first ``marks - g + s`` of each; ``s`` is one and
``SPARE`` percent of the smaller set. That part of the order is cut into
fragments by hash, one a task: each counts the shared marks of its pairs, the
partial overlaps are summed by pair, and a pair goes on only if its sum reaches
``s`` and, with all that may follow, what sets of their sizes share. A mark that more
than ``CROWD`` classes share makes no pairs. It counts as shared in those sums where
both classes have so many; classes with ``s`` of them or more, which alone can
link through nothing else, hang on one class of each. On its way a class is a
number of 64 bits and a mark has 40 bits besides its fragment: marks taken for
one another add a pair to look at, never a link.

Classes that pairs or crowds connect form a group, cut into blocks of about
``BLOCK`` classes and ``BLOCK_GRAMS`` shingles. A task takes two blocks, cuts their
shingles into fragments of the order, counts the overlaps of all their pairs
fragment by fragment in one matrix (shingles of up to ``RARE`` classes pair by pair),
sums them to the exact intersections, and returns a spanning forest of the links: no component loses a link it needs,
every set moves once for each block it meets, and no pair of a group becomes a row.

Defined cases: null and empty texts have no shingle and link with nothing;
repeated rows are copies; a null id takes part but names no component (a
component of null ids has a null name).
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialens.llm.bytewords import (
    LOWER,
    Chunk,
    bounds,
    inside,
    mix,
    ragged,
    span_hashes,
    text_chunks,
    window_hashes,
    word_spans,
)
from vialens.llm.components import components
from vialens.llm.shared import partitions, settle

COMMON = 200_000
CROWD = 16
SPARE = 20
BLOCK = 1024
BLOCK_GRAMS = 4_000_000
FRAGMENT = 2048
RARE = 64
_PAIRS = 4 << 20
_LOCAL = 8
_CHUNK = 8 << 20

_PACKED = pa.schema(
    [("bucket", pa.int32())] + [(f, pa.binary()) for f in ("ids", "counts", "low", "high")]
)
_FOUND = pa.schema([("crowd", pa.bool_())] + [(f, pa.int64()) for f in ("a", "b", "shared")])


def shingle_sets(chunk: Chunk, n: int):
    """(shingles of all documents, distinct, in order of the hash; their bounds by document)."""
    starts, lengths, document = word_spans(chunk)
    words = span_hashes(chunk.data, starts, lengths)
    hashes, ok = window_hashes(words, n), inside(document, n)
    found, owner = hashes[ok], document[: len(ok)][ok]
    counts = np.bincount(document, minlength=chunk.n)
    first = bounds(counts)
    few = np.flatnonzero((counts > 0) & (counts < n))
    for size in np.unique(counts[few]).tolist():
        of = few[counts[few] == size]
        whole = words[first[of]]
        for k in range(1, size):
            whole = mix(whole, words[first[of] + k])
        found = np.concatenate([found, mix(whole, np.full(len(of), size, np.uint64))])
        owner = np.concatenate([owner, of])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[new], owner[new]
    return found, bounds(np.bincount(owner, minlength=chunk.n))


def _width(percent: int) -> int:
    """Shingles of a mark."""
    return 2 if percent >= 67 else 1


def marks(found: np.ndarray, at: np.ndarray, width: int):
    """(marks of all documents, their bounds); ``found`` is in order of the hash."""
    if width == 1:
        return found, at
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    pairs = mix(found[:-1], found[1:])
    return pairs[owner[:-1] == owner[1:]], bounds(np.maximum(np.diff(at) - 1, 0))


def in_global_order(found: np.ndarray, at: np.ndarray, common) -> np.ndarray:
    """The marks of every document with the common ones last, from the rarest of these on."""
    hashes, rank = common
    place, late = found, np.zeros(len(found), bool)
    if len(hashes):
        at_most = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
        late = hashes[at_most] == found
        place = np.where(late, rank[at_most], found)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    return found[np.lexsort((place, owner * 2 + late))]


def _set_keys(found: np.ndarray, at: np.ndarray) -> list[bytes]:
    """16 bytes that name each document's set; ``found`` is in order of the hash."""
    raw, places = memoryview(np.ascontiguousarray(found)).cast("B"), (at * 8).tolist()
    return [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(places, places[1:])]


def _numbers(keys: np.ndarray) -> np.ndarray:
    """Half of each key, as what a class is called on its way."""
    return np.frombuffer(keys.tobytes(), "<i8")[::2]


def _sets(batches: Iterator[pa.RecordBatch], n: int):
    """Chunks as (batch, chunk, keys, distinct documents, shingles in order of the hash, bounds)."""
    for batch in batches:
        for chunk in text_chunks(batch.column(batch.num_columns - 1), LOWER, _CHUNK):
            found, at = shingle_sets(chunk, n)
            keys = np.array(_set_keys(found, at), "V16")
            _, first = np.unique(keys, return_index=True)
            first = np.sort(first)
            yield batch, chunk, keys, first[np.diff(at)[first] > 0], found, at


def _scan(rows: DataFrame, n: int, width: int) -> DataFrame:
    """Members (doc_id, n_shingles, key, id) and, with a null key, marks frequent in a chunk."""

    def scan(batches: Iterator[pa.RecordBatch]):
        for batch, chunk, keys, first, found, at in _sets(batches, n):
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(chunk.first, chunk.n),
                    pa.array(np.diff(at), pa.int64()),
                    pa.array([k.tobytes() for k in keys], pa.binary()),
                    pa.array(_numbers(keys)),
                ],
                ["doc_id", "n_shingles", "key", "id"],
            )
            own, of = marks(found, at, width)
            distinct, times = np.unique(own[ragged(of[first], np.diff(of)[first])], return_counts=True)
            often = times >= _LOCAL
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(distinct[often].view(np.int64)),
                    pa.array(times[often], pa.int64()),
                    pa.nulls(int(often.sum()), pa.binary()),
                    pa.nulls(int(often.sum()), pa.int64()),
                ],
                ["doc_id", "n_shingles", "key", "id"],
            )

    return rows.mapInArrow(scan, "doc_id long, n_shingles long, key binary, id long")


def _common(scanned: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, place of each in the order) of the commonest marks, ``COMMON`` at most."""
    counted = scanned.filter("key IS NULL").groupBy("doc_id").agg(F.sum("n_shingles").alias("n"))
    top = counted.orderBy(F.desc("n"), "doc_id").limit(COMMON).toPandas()
    hashes = top["doc_id"].to_numpy(np.int64).view(np.uint64)
    rank = np.empty(len(hashes), np.uint64)
    rank[np.lexsort((hashes, top["n"].to_numpy()))] = np.arange(len(hashes), dtype=np.uint64)
    order = np.argsort(hashes)
    return hashes[order], rank[order]


def _needed(size: np.ndarray, percent: int) -> np.ndarray:
    """How many of its marks a set of so many shingles shares with any that links."""
    shared = -(-size * percent // 100)  # ceil(t n)
    if _width(percent) == 1:
        return shared
    return shared - 1 - shared * (100 - percent) // percent


def _sure(size: np.ndarray) -> np.ndarray:
    """How many of its first marks a set shares with any that links and is no smaller."""
    return 1 + size * SPARE // 100


def _prefixes(rows: DataFrame, n: int, percent: int, common, n_buckets: int) -> DataFrame:
    """The first marks of every class of a chunk, packed by fragment of the order."""
    width = _width(percent)

    def pack(batches: Iterator[pa.RecordBatch]):
        for _, _, keys, first, found, at in _sets(batches, n):
            own, of = marks(found, at, width)
            own, n_marks = in_global_order(own, of, common.value), np.diff(of)[first]
            size = np.diff(at)[first]
            length = np.minimum(n_marks, n_marks - _needed(size, percent) + _sure(size))
            hashes = own[ragged(of[first], length)]
            doc = np.repeat(np.arange(len(first)), length)
            bucket = ((hashes >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(int)
            order = np.argsort(bucket, kind="stable")
            limits = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            ids, out = _numbers(keys[first]), []
            for b in np.flatnonzero(np.diff(limits)).tolist():
                i = order[limits[b] : limits[b + 1]]
                used, counts = np.unique(doc[i], return_counts=True)
                out.append(
                    {
                        "bucket": b,
                        "ids": ids[used].tobytes(),
                        "counts": counts.astype("<u4").tobytes(),
                        "low": hashes[i].astype("<u4").tobytes(),
                        "high": (hashes[i] >> np.uint64(32)).astype("u1").tobytes(),
                    }
                )
            if out:
                yield pa.RecordBatch.from_pylist(out, _PACKED)

    return rows.mapInArrow(pack, "bucket int, ids binary, counts binary, low binary, high binary")


def _partial_overlaps(table: pa.Table) -> pa.Table:
    """Pairs of a fragment with their shared marks, and what hangs together in crowds."""
    ids, counts, low, high = (
        np.frombuffer(b"".join(table[c].to_pylist()), kind)
        for c, kind in (("ids", "<i8"), ("counts", "<u4"), ("low", "<u4"), ("high", "u1"))
    )
    ids, first, number = np.unique(ids, return_index=True, return_inverse=True)
    # of a class that several chunks have, one copy's marks
    one = first[number] == np.arange(len(number))
    hashes = (high.astype(np.uint64) << np.uint64(32) | low)[np.repeat(one, counts)]
    doc = np.repeat(number[one], counts[one])
    order = np.lexsort((doc, hashes))
    hashes, doc = hashes[order], doc[order]
    begin = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    count = np.diff(np.r_[begin, len(hashes)])
    pairs = [np.zeros(0, np.int64)]
    n = len(ids)
    for m in range(2, CROWD + 1):
        of = begin[count == m]
        members = doc[of[:, None] + np.arange(m)]
        i, j = np.triu_indices(m, 1)
        a, b = members[:, i].reshape(-1), members[:, j].reshape(-1)
        pairs.append((a * n + b)[a != b])
    pair, shared = np.unique(np.concatenate(pairs), return_counts=True)
    crowd = count > CROWD
    member = doc[ragged(begin[crowd], count[crowd])]
    pivot = np.repeat(doc[begin[crowd]], count[crowd])
    hang, times = np.unique(pivot * n + member, return_counts=True)
    both = np.concatenate([pair, hang])
    columns = [
        pa.array(np.arange(len(both)) >= len(pair)),
        pa.array(ids[both // max(n, 1)]),
        pa.array(ids[both % max(n, 1)]),
        pa.array(np.concatenate([shared, times])),
    ]
    return pa.Table.from_arrays(columns, schema=_FOUND)


def _bitmap(wanted: DataFrame) -> np.ndarray:
    """A bit for every id by its highest 24 bits; other ids may share it."""
    bit = F.shiftrightunsigned("id", 40)
    words = wanted.select(
        F.shiftright(bit, 5).cast("int").alias("word"),
        F.pow(F.lit(2), bit % 32).cast("long").alias("bits"),
    )
    rows = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros((1 << 24) // 32, np.uint32)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return out


def _chosen_sets(rows: DataFrame, n: int, wanted: DataFrame) -> DataFrame:
    """(id, grams): the sets of the wanted classes and of a few others, one a chunk.

    Texts are read again rather than moved: a bitmap of fixed size leaves out
    nearly all that are not wanted.
    """
    bits = rows.sparkSession.sparkContext.broadcast(_bitmap(wanted))

    def pick(batches: Iterator[pa.RecordBatch]):
        for _, _, keys, first, found, at in _sets(batches, n):
            ids = _numbers(keys[first])
            bit = (ids.view(np.uint64) >> np.uint64(40)).astype(np.uint32)
            chosen = (bits.value[bit >> 5] >> (bit & 31) & 1).astype(bool)
            first = first[chosen]
            raw = memoryview(np.ascontiguousarray(found)).cast("B")
            spans = zip((at[first] * 8).tolist(), (at[first + 1] * 8).tolist(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[chosen]), pa.array([bytes(raw[x:y]) for x, y in spans], pa.binary())],
                ["id", "grams"],
            )

    return rows.mapInArrow(pick, "id long, grams binary")


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """A spanning forest of the links among the classes of one or two blocks.

    The columns are the shared shingles in hash order. Those of up to ``RARE``
    classes count for their own pairs; every ``FRAGMENT`` of the others is a
    fragment whose overlaps are counted for all pairs at once. The counts add up
    to the intersections.
    """
    found = dict(zip(table["id"].to_pylist(), table["grams"].to_pylist(), strict=True))
    names = list(found)
    sets = [np.frombuffer(g, "<u8") for g in found.values()]
    m = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    who, hashes = np.repeat(np.arange(m), size), np.concatenate(sets)
    _, column, times = np.unique(hashes, return_inverse=True, return_counts=True)
    kept = times[column] > 1
    who, column = who[kept], column[kept]
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    begin = np.flatnonzero(np.r_[True, column[1:] != column[:-1]][: len(column)])
    count = np.diff(np.r_[begin, len(column)])
    overlap = np.zeros((m, m), np.float32)
    for k in np.unique(count[count <= RARE]).tolist():
        i, j = np.triu_indices(k, 1)
        of = begin[count == k]
        step = max(1, _PAIRS // len(i))
        for left in range(0, len(of), step):
            members = who[of[left : left + step, None] + np.arange(k)]
            pair = members[:, i] * m + members[:, j]
            overlap += np.bincount(pair.reshape(-1), minlength=m * m).reshape(m, m)
    overlap += overlap.T
    begin, count = begin[count > RARE], count[count > RARE]
    for left in range(0, len(begin), FRAGMENT):
        each = count[left : left + FRAGMENT]
        held = np.zeros((m, len(each)), np.float32)
        held[who[ragged(begin[left : left + FRAGMENT], each)], np.repeat(np.arange(len(each)), each)] = 1
        overlap += held @ held.T
    linked = 100 * overlap >= percent * (size[:, None] + size[None, :] - overlap)
    free, edges = np.ones(m, bool), []
    for start in range(m):
        if not free[start]:
            continue
        free[start] = False
        waiting = [start]
        while waiting:
            i = waiting.pop()
            found = np.flatnonzero(linked[i] & free)
            free[found] = False
            waiting += found.tolist()
            edges += [(i, j) for j in found.tolist()]
    return pa.table(
        {
            "a": pa.array([names[i] for i, _ in edges], pa.int64()),
            "b": pa.array([names[j] for _, j in edges], pa.int64()),
        }
    )


def links(rows: DataFrame, scanned: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b): links of classes, by id, that connect all that any links connect."""
    spark, pairwise = rows.sparkSession, _width(percent) == 2
    common = spark.sparkContext.broadcast(_common(scanned))
    packed = _prefixes(rows, n, percent, common, partitions(spark))
    schema = "crowd boolean, a long, b long, shared long"
    found = settle(packed.groupBy("bucket").applyInArrow(_partial_overlaps, schema))
    sizes = scanned.filter("n_shingles > 0 AND key IS NOT NULL")
    sizes = sizes.groupBy("id").agg(F.first("n_shingles").alias("n"))
    hung = found.filter("crowd")
    crowded = hung.groupBy(F.col("b").alias("id")).agg(F.sum("shared").alias("k"))
    crowded = settle(crowded.join(sizes, "id"))
    pairs = found.filter("NOT crowd").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    for side in ("a", "b"):
        k = crowded.select(F.col("id").alias(side), F.col("k").alias(f"k_{side}"))
        pairs = pairs.join(k, side, "left").fillna(0, [f"k_{side}"])
        pairs = pairs.join(sizes.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}")), side)
    least, largest, all = F.least("n_a", "n_b"), F.greatest("n_a", "n_b"), F.col("n_a") + F.col("n_b")
    needed = F.ceil(largest * percent / 100)
    need = F.ceil(all * percent / (100 + percent) - 1e-9)
    if pairwise:
        needed = needed - 1 - F.floor(needed * (100 - percent) / percent)
        need = 3 * need - 1 - all
    sure = 1 + F.floor(least * SPARE / 100)
    most = F.col("shared") + F.least("k_a", "k_b")
    # ``needed - sure``: what both sets can still share beyond the first marks of either
    pairs = pairs.filter((100 * least >= percent * largest) & (most >= sure) & (most + needed - sure >= need))
    # who shares nothing but crowded marks with a set that links has at least so many of them
    smallest = F.ceil(F.col("n") * percent / 100)
    deep = crowded.filter(F.col("k") >= 1 + F.floor(smallest * SPARE / 100))
    deep = deep.select(F.col("id").alias("b"))
    edges = hung.filter("a <> b").join(deep, "b", "left_semi").select("a", "b")
    edges = edges.union(pairs.select("a", "b"))
    groups = components(edges).withColumnsRenamed({"node": "id", "root": "group"})
    groups = settle(groups.join(sizes, "id"))
    blocks = groups.groupBy("group").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_GRAMS)).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("id"), "blocks").cast("int")
    dealt = groups.join(blocks, "group").withColumn("block", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = settle(
        dealt.select(
            "id", "group", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
        )
    )
    sets = _chosen_sets(rows, n, groups.select("id"))
    return (
        sets.join(dealt, "id")
        .groupBy("group", "lo", "hi")
        .applyInArrow(lambda t: _block_links(t, percent), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 75, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Documents link when 100 * shared >= percent * all of their shingles;
    ``component_id`` is the smallest id that links reach, its own included.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent lies in 1 to 100")
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scanned = settle(_scan(rows, n, _width(percent)))
    members = scanned.filter("key IS NOT NULL")
    roots = components(links(rows, scanned, n, percent))
    roots = roots.withColumnRenamed("node", "id")
    # sets without shingles are no copies of each other
    filled = members.filter("n_shingles > 0")
    classes = filled.groupBy("key", "id").agg(F.min("doc_id").alias("least"))
    classes = classes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(names, "root").select("key", "component_id")
    linked = filled.join(named, "key").select("doc_id", "n_shingles", "component_id")
    empty = members.filter("n_shingles = 0")
    return linked.union(empty.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
