"""Approximate top-k by cosine over neighbour graphs, with an optional filter.

Vectors are dealt by id into shards of about ``SHARD_BYTES`` and ``SHARD_ROWS`` at
most, the one time they move; a task builds a shard's graph. Every
vector is linked to its nearest ones: first to those beside it on a few random
lines, then round after round to the neighbours of its neighbours (each vector
compares the neighbours it has among each other, ``CANDIDATES`` at most). Links are
numbers in arrays and never leave the task; those that a round finds are cut to the
best of each vector ``HELD`` at a time. The next vector on each line stays linked
too, so no group is cut off. At last each shard becomes one row, in a file of its
own, with its vectors and links.

A search visits every shard where it lies: the queries go to the shards, in slices
if they are many. It starts from some vectors spread over the shard
(``ENTRIES`` times the square root of their number), follows the links of the best one not yet followed, and ends when that
one is worse than the ``effort`` best found. With a filter the walk passes through
all vectors and keeps those that match; where few of a shard's vectors match,
they are simply scored, which is exact. Hits bring how many vectors were scored.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vialens.operators.retrieval import QUERY_LIMIT, SCORE_DIGITS, _ids, _matrix, _unit
from vialens.operators.scale import settle

SHARD_BYTES = 32 << 20
SHARD_ROWS = 1 << 16
# Links a vector has to its nearest; as many more may lead to it and are followed back.
DEGREE = 16
# Neighbours of one vector that are compared among each other in a round.
CANDIDATES = 32
# Vectors whose neighbours are compared before their links leave the worker.
GROUPS = 256
# Vectors whose neighbours are gathered at once, and links found that are held before a cut.
GATHERED = 1024
HELD = 1 << 19
ROUNDS = 8
# A round that raises the mean score of the links by less ends the building.
GAIN = 1e-3
_LINES = 4
# Vectors searched for at least; more find more and visit more.
EFFORT = 100
# A walk starts from this many times the square root of the shard's vectors.
ENTRIES = 4
# A filter that leaves a shard fewer vectors than this times the effort is answered by scoring them.
FEW = 8
# Queries that are sent to the shards at once, in query limits.
SENT_LIMITS = 32


@dataclass(frozen=True)
class VectorGraph:
    """The shards: one row each, with ids, vectors, links and labels."""

    shards: DataFrame
    n_vectors: int


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs, one after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _xxhash64(column: np.ndarray, seed) -> np.ndarray:
    """Spark's hash of a column of longs; ``seed`` is 42 or the hash of the columns before."""
    p1, p2, p3 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    p4, p5 = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5)
    turned = lambda x, n: x << np.uint64(n) | x >> np.uint64(64 - n)
    h = np.full(len(column), 42, np.uint64) if seed is None else seed
    h = h + p5 + np.uint64(8)
    h = h ^ turned(column.astype(np.int64).view(np.uint64) * p2, 31) * p1
    h = turned(h, 27) * p1 + p4
    h = (h ^ h >> np.uint64(33)) * p2
    h = (h ^ h >> np.uint64(29)) * p3
    return h ^ h >> np.uint64(32)


class _Links:
    """Links (u, w, score) of a shard, by the places of its vectors; of an id that repeats, the last."""

    def __init__(self, ids: pa.Array, vectors: pa.Array):
        self.n, self.vectors = len(ids), vectors
        self.node = _places(ids, pa.chunked_array([ids])).astype(np.int64)
        order = pc.sort_indices(ids).to_numpy()
        self.rank = np.empty(self.n, np.int64)
        self.rank[order] = np.arange(self.n)
        # what orders links of one score
        self.name = ids.to_numpy() if pa.types.is_int64(ids.type) else np.arange(self.n)
        self.rows = np.argsort(self.node, kind="stable")
        self.first = np.searchsorted(self.node[self.rows], np.arange(self.n + 1))
        units = _unit(_matrix(vectors))
        self.places = units @ np.random.default_rng(7).normal(size=(units.shape[1], _LINES))

    def on_lines(self, near: int) -> tuple[np.ndarray, np.ndarray]:
        """(u, w): every vector and the ``near`` ones behind it on each line."""
        found = [np.zeros(0, np.int64)]
        for i in range(_LINES):
            line = self.node[np.lexsort((self.rank, self.places[:, i]))]
            found += [line[:-n] * self.n + line[n:] for n in range(1, near + 1)]
        return np.divmod(np.unique(np.concatenate(found)), self.n)

    def closest(self, links, most: int):
        """The best links of every vector, ``most`` at most; of one that is there twice the better."""
        u, w, score = links
        order = np.argsort(u * self.n + w, kind="stable")
        u, w, score = u[order], w[order], score[order]
        begin = np.flatnonzero(np.r_[True, (u[1:] != u[:-1]) | (w[1:] != w[:-1])][: len(u)])
        score = np.maximum.reduceat(score, begin) if len(u) else score
        u, w = u[begin], w[begin]
        tie = _xxhash64(self.name[w], _xxhash64(self.name[u], None)).view(np.int64)
        order = np.lexsort((tie, -score, u))
        u, w, score = u[order], w[order], score[order]
        kept = np.arange(len(u)) - np.searchsorted(u, u) < most
        return u[kept], w[kept], score[kept]

    def both_ways(self, links, most: int):
        u, w, score = links
        return self.closest((np.r_[u, w], np.r_[w, u], np.r_[score, score]), most)

    def joined(self, links) -> Iterator[tuple]:
        """Links of every vector to its best among the vectors that share a neighbour with it."""
        u, w, _ = self.both_ways(links, CANDIDATES)
        u, w = np.r_[u, self.node], np.r_[w, self.node]
        order = np.argsort(u, kind="stable")
        u, w = u[order], w[order]
        times = np.diff(self.first)[w]
        out = pa.schema([("u", pa.int64()), ("w", pa.int64()), ("score", pa.float64())])
        nodes = np.unique(self.node)
        for left in range(0, len(nodes), GATHERED):
            of = nodes[left : left + GATHERED]
            a, b = np.searchsorted(u, [of[0], of[-1] + 1])
            rows = self.rows[_ragged(self.first[w[a:b]], times[a:b])]
            at = np.searchsorted(np.repeat(u[a:b], times[a:b]), np.append(of, of[-1] + 1))
            members = [pa.array(self.node[rows]), self.vectors.take(pa.array(rows))]
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(members, ["w", "v"]))
            for batch in _compared(iter([pa.RecordBatch.from_arrays([lists], ["m"])]), out):
                yield tuple(c.to_numpy() for c in batch.columns)

    def cut(self, links, found: list):
        """``links`` and ``found`` cut to each vector's best; as a table by vector, and its least score."""
        links = self.closest(tuple(np.concatenate(c) for c in zip(links, *found)), DEGREE)
        u, w, score = links
        table, least = np.full((self.n, DEGREE), -1), np.full(self.n, -np.inf)
        place = np.arange(len(u)) - np.searchsorted(u, u)
        table[u, place] = w
        last = place == DEGREE - 1
        least[u[last]] = score[last]
        return links, table, least

    def nearest(self):
        """Each vector's nearest, nearly all of them. Rounds end when they no longer help."""
        u, w = self.on_lines(DEGREE // _LINES)
        links, before = (u, w, np.zeros(len(u))), None
        for _ in range(ROUNDS):
            known = links[2] != 0
            kept, table, least = self.cut(tuple(c[known] for c in links), [])
            found, held = [], 0
            for u, w, score in self.joined(links):
                new = score >= least[u]
                new[new] = ~(table[u[new]] == w[new, None]).any(axis=1)
                found.append((u[new], w[new], score[new]))
                held += int(new.sum())
                if held > HELD:
                    kept, table, least = self.cut(kept, found)
                    found, held = [], 0
            links = self.cut(kept, found)[0]
            if not len(links[2]):
                break
            now = links[2].mean()
            if before is not None and now - before < GAIN:
                break
            before = now
        return links


def _compared(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Links within each row's list of (w, v); those of ``GROUPS`` rows at a time are held."""
    for batch in batches:
        members = batch.column(0)
        all_ids, vs = members.values.field(0), members.values.field(1)
        for first in range(0, len(members), GROUPS):
            us, ws, scores = [], [], []
            starts = members.slice(first, GROUPS).offsets.to_numpy()
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                n = b - a
                if n < 2:
                    continue
                m = _unit(_matrix(vs.slice(a, n)))
                s = m @ m.T
                np.fill_diagonal(s, -np.inf)
                k = min(DEGREE, n - 1)
                best = np.argpartition(-s, k - 1, axis=1)[:, :k]
                row = np.repeat(np.arange(n), k)
                us.append(a + row)
                ws.append(a + best.reshape(-1))
                scores.append(s[row, best.reshape(-1)])
            if us:
                columns = [all_ids.take(pa.array(np.concatenate(x))) for x in (us, ws)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(scores))], schema=out)


def _places(ids: pa.Array, links: pa.ChunkedArray) -> np.ndarray:
    """Where in ``ids`` each link's id stands (the last place), without a Python object a link."""
    back = pc.index_in(links, value_set=ids[::-1])
    if back.null_count:
        raise ValueError("a link leads out of its shard")
    return (len(ids) - 1 - back.to_numpy()).astype(np.int32)


def _shard_type(ids: T.DataType, number: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("shard", T.LongType()),
            T.StructField("ids", T.ArrayType(ids)),
            T.StructField("vectors", T.ArrayType(number)),
            T.StructField("first", T.ArrayType(T.IntegerType())),
            T.StructField("links", T.ArrayType(T.IntegerType())),
            T.StructField("labels", T.ArrayType(T.StringType())),
        ]
    )


def build_graph(
    vectors: DataFrame, folder: str, label: str | None = None, shard_bytes: int = SHARD_BYTES
) -> VectorGraph:
    """Writes the graph of ``vectors`` (id unique, embedding) to ``folder`` and opens it.

    NULL vectors are left out. ``label`` names a column that searches may filter by.
    """
    spark = vectors.sparkSession
    named = F.lit(None) if label is None else F.col(label)
    rows = vectors.where(F.col("embedding").isNotNull() & F.col("id").isNotNull())
    rows = rows.select("id", F.col("embedding").alias("v"), named.cast("string").alias("label"))
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    n_shards = max(1, -(-n * (width or 1) * 8 // shard_bytes), -(-n // SHARD_ROWS))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(n_shards)).cast("long"))
    number = rows.schema["v"].dataType.elementType
    number = number if isinstance(number, T.FloatType) else T.DoubleType()
    schema = _shard_type(rows.schema["id"].dataType, number)
    out = to_arrow_schema(schema)

    def pack(key, own):
        ids, v = own.column("id").combine_chunks(), own.column("v").combine_chunks()
        shard = _Links(ids, v)
        u, w, _ = shard.both_ways(shard.nearest(), 2 * DEGREE)
        # nearest ones alone would leave groups that nothing leads to; a line leads everywhere
        a, b = shard.on_lines(1)
        u, w = np.divmod(np.unique(np.r_[u * len(ids) + w, a * len(ids) + b, b * len(ids) + a]), len(ids))
        # an id that repeats has each link as often
        times = np.diff(shard.first)[u]
        u, w = np.repeat(u, times), np.repeat(w, times)
        first = np.searchsorted(u, np.arange(len(ids) + 1)).astype(np.int32)
        flat = _matrix(v).reshape(-1).astype(out.field("vectors").type.value_type.to_pandas_dtype())
        row = [
            pa.array([key[0].as_py()], pa.int64()),
            pa.array([ids.to_pylist()], out.field("ids").type),
            pa.array([flat], out.field("vectors").type),
            pa.array([first], out.field("first").type),
            pa.array([w.astype(np.int32)], out.field("links").type),
            pa.array([own.column("label").to_pylist()], out.field("labels").type),
        ]
        return pa.Table.from_arrays(row, schema=out)

    shards = rows.repartition(n_shards, "shard").groupBy("shard").applyInArrow(pack, schema)
    # one row a file: writers and readers hold one shard
    shards.write.mode("overwrite").option("maxRecordsPerFile", 1).parquet(folder)
    return open_graph(spark, folder)


def open_graph(spark: SparkSession, folder: str) -> VectorGraph:
    shards = spark.read.parquet(folder)
    return VectorGraph(shards, shards.agg(F.sum(F.size("ids"))).first()[0] or 0)


class _Shard:
    """A shard's row in memory."""

    def __init__(self, row: pa.RecordBatch):
        cell = lambda c: row.column(row.schema.names.index(c))[0].values
        self.ids = _ids(cell("ids"))
        self.units = _unit(cell("vectors").to_numpy().astype(np.float64).reshape(len(self.ids), -1))
        self.first, self.links = cell("first").to_numpy(), cell("links").to_numpy()
        self.labels = np.array(cell("labels").to_pylist(), object)
        n = len(self.ids)
        self.entries = np.unique(np.linspace(0, n - 1, max(1, int(np.ceil(ENTRIES * np.sqrt(n))))).astype(int))

    def search(self, query: np.ndarray, k: int, effort: int, wanted: str | None):
        """(places, scores, vectors scored)."""
        match = None if wanted is None else self.labels == wanted
        effort = max(effort, k)
        if match is not None and match.sum() <= FEW * effort:
            places = np.flatnonzero(match)
            return places, self.units[places] @ query, len(places)
        seen = np.zeros(len(self.ids), bool)
        best: list[tuple[float, int]] = []  # of those that match, the worst first
        ahead: list[tuple[float, int]] = []
        scored, new = 0, self.entries
        while True:
            seen[new] = True
            scores = self.units[new] @ query
            scored += len(new)
            for s, i in zip(scores.tolist(), new.tolist(), strict=True):
                full = len(best) >= effort
                if not full or s > best[0][0]:
                    heapq.heappush(ahead, (-s, i))
                    if match is None or match[i]:
                        (heapq.heappushpop if full else heapq.heappush)(best, (s, i))
            new = self.links[:0]
            while ahead and not len(new):
                s, i = heapq.heappop(ahead)
                if len(best) >= effort and -s < best[0][0]:
                    break
                linked = self.links[self.first[i] : self.first[i + 1]]
                new = linked[~seen[linked]]
            if not len(new):
                places = np.array([i for _, i in best], np.int64)
                return places, np.array([s for s, _ in best]), scored


def _hit_type(ids: T.DataType, queries: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries),
            T.StructField("id", ids),
            T.StructField("score", T.DoubleType()),
            T.StructField("n_scored", T.LongType()),
        ]
    )


def _walked(
    graph: VectorGraph, asked: DataFrame, n_parts: int, k: int, effort: int, schema: T.StructType
) -> DataFrame:
    """Each shard's hits of the queries ``asked``, and a row without a hit for what was scored."""
    out = to_arrow_schema(schema)
    table = asked.toArrow()
    query_ids, wanted = table.column("query_id").to_pylist(), table.column("wanted").to_pylist()
    units = _unit(_matrix(table.column("embedding")))
    sent = asked.sparkSession.sparkContext.broadcast((query_ids, units, wanted))

    def walk(part: int):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, units, wanted = (x[part::n_parts] for x in sent.value)
            for batch in batches:
                for at in range(batch.num_rows if query_ids else 0):
                    shard = _Shard(batch.slice(at, 1))
                    if units.shape[1] != shard.units.shape[1]:
                        raise ValueError("query and document vectors differ in length")
                    for first in range(0, len(query_ids), QUERY_LIMIT):
                        some = slice(first, first + QUERY_LIMIT)
                        yield _shard_hits(shard, query_ids[some], units[some], wanted[some], k, effort, out)

        return search

    return reduce(DataFrame.union, [graph.shards.mapInArrow(walk(part), schema) for part in range(n_parts)])


def _shard_hits(shard: _Shard, query_ids, units, wanted, k: int, effort: int, out: pa.Schema) -> pa.RecordBatch:
    rows = [[], [], [], []]
    for q, unit, w in zip(query_ids, units, wanted, strict=True):
        places, scores, n = shard.search(unit, k, effort, w)
        scores = np.round(scores, SCORE_DIGITS)
        top = np.lexsort((shard.ids[places], -scores))[:k]
        # and a row without a hit for the count
        rows[0] += [q] * (len(top) + 1)
        rows[1] += [*shard.ids[places[top]].tolist(), None]
        rows[2] += [*scores[top].tolist(), None]
        rows[3] += [0] * len(top) + [n]
    return pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, out, strict=True)], schema=out)


def graph_top_k(
    graph: VectorGraph,
    queries: DataFrame,
    k: int = 10,
    effort: int = EFFORT,
    query_limit: int = QUERY_LIMIT,
) -> DataFrame:
    """About the k vectors of highest cosine for each query: query_id, rank, id, score, n_scored.

    ``queries``: query_id (unique), embedding, and ``wanted`` to keep vectors with
    that label only (NULL: all). Ties go to the lower id. ``n_scored`` counts
    the vectors the query was compared with, over all shards. Shards are read where
    they lie, not moved; a task takes a shard and a part of the queries, at most
    ``SENT_LIMITS`` times ``query_limit`` of which are sent at once.
    """
    spark = queries.sparkSession
    asked = queries if "wanted" in queries.columns else queries.withColumn("wanted", F.lit(None))
    asked = asked.where(F.col("embedding").isNotNull())
    asked = settle(asked.select("query_id", "embedding", F.col("wanted").cast("string").alias("wanted")))
    n, width = asked.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    n_slices = max(1, -(-n // min(SENT_LIMITS * query_limit, max(1, SHARD_BYTES // (8 * max(1, width or 1))))))
    n_shards = max(1, graph.shards.count())
    # as many parts as keep all cores busy
    n_parts = min(-(-n // (n_slices * query_limit)), -(-2 * spark.sparkContext.defaultParallelism // n_shards))
    ids = graph.shards.schema["ids"].dataType.elementType
    schema = _hit_type(ids, queries.schema["query_id"].dataType)
    own = F.pmod(F.xxhash64("query_id"), F.lit(n_slices))
    slices = []
    for i in range(n_slices):
        hits = _walked(graph, asked.where(own == i), max(1, n_parts), k, effort, schema)
        query = Window.partitionBy("query_id")
        counted = hits.withColumn("n_scored", F.sum("n_scored").over(query))
        order = query.orderBy(F.desc("score"), F.asc("id"))
        ranked = counted.where(F.col("id").isNotNull()).withColumn("rank", F.row_number().over(order))
        ranked = ranked.where(F.col("rank") <= k).select("query_id", "rank", "id", "score", "n_scored")
        slices.append(settle(ranked) if n_slices > 1 else ranked)
    return reduce(DataFrame.union, slices)


def recall(hits: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: hits of the exact search, how many of them were found, and their share."""
    wanted = exact.select("query_id", "id")
    found = hits.select("query_id", "id", F.lit(1).alias("_found"))
    both = wanted.join(found, ["query_id", "id"], "left")
    return both.agg(F.count(F.lit(1)).alias("n_hits"), F.count("_found").alias("n_found")).withColumn(
        "recall", F.when(F.col("n_hits") > 0, F.col("n_found") / F.col("n_hits")).otherwise(1.0)
    )
