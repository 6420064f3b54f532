"""Approximate nearest neighbours by multiprobe p-stable hashing, for inner products.

Index. Vectors are scaled by the largest norm and given one more coordinate
that makes them unit vectors; queries are scaled to norm one with a last
coordinate of 0. Euclidean order is then the order of the inner products. Each
of ``tables`` hash tables takes ``hashes`` functions floor((a x + b) / width)
with Gaussian a; a bucket is their values.

Search. From a query's place inside its bucket follows how likely each
neighbouring bucket (one step up or down in any functions) holds near vectors:
the sum of the squared distances to the borders crossed. The ``probes``
likeliest buckets of every table are visited; all vectors met are ranked by the
exact measure, and the tables' results merged. A query that meets fewer than k
vectors visits all buckets of a table.

Copies of a vector are one entry that keeps its k + 1 smallest ids, all that a
list of k can show. Buckets of more than ``CELL_ROWS`` entries are split, and
probes go to every part; nothing is capped. The query set is stated (every
twentieth id), and only buckets it probes meet it.

Vectors that are null, zero, or hold null or non-finite components take no
part, as query or as candidate. Vectors meet only those of their own length.
Repeated rows of an id and vector count once.
"""

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialens.llm.shared import partitions, settle

CELL_ROWS = 20_000
#: Buckets come in random order of the vectors; queries are compared in blocks.
_BLOCK = 512


@dataclass(frozen=True)
class Config:
    tables: int = 4
    hashes: int = 4
    width: float = 1.2
    probes: int = 60
    seed: int = 0


def usable(vector: Column) -> Column:
    finite = F.forall(
        vector,
        lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)),
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def entries(vectors: DataFrame, id: str, vector: str, k: int) -> DataFrame:
    """(entry, dim, vector, ids): distinct vectors with their k + 1 smallest ids.

    The limit applies before the shuffle too, so copies beyond it never move.
    """
    rows = vectors.select(
        F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    ).dropna()
    rows = rows.filter(usable(F.col("vector")))
    # -0.0 and 0.0 are one value
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    first = F.dense_rank().over(Window.partitionBy("vector").orderBy("id"))
    kept = rows.withColumn("n", first).filter(F.col("n") <= k + 1)
    grouped = kept.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    return grouped.select(
        F.col("ids")[0].alias("entry"), F.size("vector").alias("dim"), "vector", "ids"
    )


class _Hashes:
    """The functions of all tables for vectors of one length."""

    def __init__(self, dim: int, config: Config):
        random = np.random.default_rng([config.seed, dim])
        n = config.tables * config.hashes
        self.a, self.b = random.normal(size=(dim + 1, n)), random.uniform(0, config.width, n)
        self.config = config
        steps = list(itertools.product((0, -1, 1), repeat=config.hashes))
        self.steps = np.array(steps, np.int64)

    def places(self, vectors: np.ndarray) -> np.ndarray:
        flat = (vectors @ self.a + self.b) / self.config.width
        return flat.reshape(len(vectors), self.config.tables, self.config.hashes)

    def probes(self, places: np.ndarray) -> np.ndarray:
        """Buckets (query, table, probe, hash) in the order of estimated success."""
        home = np.floor(places)
        up = 1 - (places - home)
        down = places - home
        cost = down**2 @ (self.steps.T == -1) + up**2 @ (self.steps.T == 1)
        order = np.argsort(cost, axis=2, kind="stable")[:, :, : self.config.probes]
        return home.astype(np.int64)[:, :, None, :] + self.steps[order]


def _codes(buckets: np.ndarray) -> np.ndarray:
    """A number for each bucket: its values in 16 bits each (they are small)."""
    code = np.zeros(buckets.shape[:-1], np.int64)
    for i in range(buckets.shape[-1]):
        code = code * 65599 + (buckets[..., i] + 32768)
    return code


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, batch.filter(pa.array(dims == dim))


def _cells(rows: DataFrame, config: Config, largest: float, probing: bool) -> DataFrame:
    """(entry, dim, vector, table, code): a row for every bucket of each entry or query."""

    def hashed(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for dim, part in _by_length(batch):
                vectors = _matrix(part.column("vector"))
                norms = np.linalg.norm(vectors, axis=1)
                if probing:
                    unit = np.c_[vectors / norms[:, None], np.zeros(len(vectors))]
                else:
                    rest = np.sqrt(np.maximum(0, 1 - (norms / largest) ** 2))
                    unit = np.c_[vectors / largest, rest]
                functions = _Hashes(dim, config)
                places = functions.places(unit)
                if probing:
                    codes = _codes(functions.probes(places))
                else:
                    codes = _codes(np.floor(places).astype(np.int64))[:, :, None]
                n, tables, each = codes.shape
                which = pa.array(np.repeat(np.arange(n), tables * each))
                table = np.tile(np.repeat(np.arange(tables), each), n)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(which) for c in ("entry", "dim", "vector")),
                        pa.array(table, pa.int32()),
                        pa.array(codes.reshape(-1), pa.int64()),
                    ],
                    ["entry", "dim", "vector", "table", "code"],
                )

    schema = "entry long, dim int, vector array<double>, table int, code long"
    return rows.select("entry", "dim", "vector").mapInArrow(hashed, schema)


_CELL = ["dim", "table", "code"]


def _met(index: DataFrame, probes: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """(query, entry): the k + 1 nearest entries that each query meets in each group of buckets."""
    groups = 4 * partitions(index.sparkSession)
    parts = F.ceil(F.col("n") / CELL_ROWS).cast("int")
    sizes = sizes.withColumn("parts", parts)
    group = F.pmod(F.xxhash64(*_CELL, "part"), F.lit(groups)).alias("group")
    rows = index.join(sizes, _CELL).withColumn("part", F.pmod(F.xxhash64("entry"), F.col("parts")))
    rows = rows.withColumn("part", F.col("part").cast("int"))
    asked = probes.join(sizes, _CELL)
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    columns = ["entry", "dim", "table", "code", "part", "vector"]

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        theirs = _cell_rows(left)
        for cell, q in _cell_rows(right).items():
            mine = theirs.get(cell)
            if mine is None:
                continue
            data, query = left.take(mine), right.take(q)
            vectors, ids = _matrix(_one(data, "vector")), data["entry"].to_numpy()
            asking, names = _matrix(_one(query, "vector")), query["entry"].to_numpy()
            for at in range(0, len(names), _BLOCK):
                scores = asking[at : at + _BLOCK] @ vectors.T
                if scores.shape[1] > k + 1:
                    top = np.argpartition(-scores, k, axis=1)[:, : k + 1]
                else:
                    top = np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
                for i, name in enumerate(names[at : at + _BLOCK].tolist()):
                    s, e = scores[i, top[i]], ids[top[i]]
                    if name in best:
                        s, e = np.r_[best[name][0], s], np.r_[best[name][1], e]
                        e, first = np.unique(e, return_index=True)
                        s = s[first]
                    order = np.lexsort((e, -s))[: k + 1]
                    best[name] = s[order], e[order]
        found = {
            "query": np.repeat(np.array(list(best), np.int64), [len(e) for _, e in best.values()]),
            "entry": np.concatenate([np.zeros(0, np.int64), *(e for _, e in best.values())]),
            "near": np.concatenate([np.zeros(0), *(s for s, _ in best.values())]),
        }
        return pa.table(found)

    return (
        rows.select(*columns, group)
        .groupBy("group")
        .cogroup(asked.select(*columns, group).groupBy("group"))
        .applyInArrow(nearest, "query long, entry long, near double")
    )


def _one(table: pa.Table, name: str) -> pa.Array:
    return table[name].combine_chunks()


def _cell_rows(table: pa.Table) -> dict[tuple, np.ndarray]:
    keys = np.stack([table[c].to_numpy() for c in (*_CELL, "part")], axis=1)
    if not len(keys):
        return {}
    distinct, which = np.unique(keys, axis=0, return_inverse=True)
    order = np.argsort(which.reshape(-1), kind="stable")
    limits = np.searchsorted(which.reshape(-1)[order], np.arange(len(distinct) + 1))
    return {tuple(c): order[a:b] for c, a, b in zip(distinct.tolist(), limits, limits[1:])}


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    config: Config = Config(),
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row that ``queries`` marks.

    Nearest by inner product in double precision, ties to the smaller id; a
    row is no neighbour of itself.
    """
    vectors = vectors.withColumn("_asks", queries).select(
        F.col(id).cast("long").alias("_id"), F.col(vector).alias("_vector"), "_asks"
    )
    index = settle(entries(vectors, "_id", "_vector", k))
    asking = vectors.filter("_asks").dropna().filter(usable(F.col("_vector"))).select(
        F.col("_id").alias("query_id"),
        F.transform(F.col("_vector").cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vector"),
    ).distinct()
    # which entry each asking row is; an entry is searched once for all its rows
    asking = settle(asking.join(index, "vector").select("query_id", "entry"))
    asked = index.join(asking.select("entry").distinct(), "entry", "left_semi")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    largest = index.agg(F.max(norm)).first()[0] or 1.0
    cells = settle(_cells(index, config, largest, probing=False))
    sizes = settle(cells.groupBy(*_CELL).agg(F.count("*").alias("n")))
    probes = _cells(asked, config, largest, probing=True)
    found = settle(_merged(_met(cells, probes, sizes, k), k))
    enough = found.groupBy("query").agg(F.count("*").alias("n")).filter(F.col("n") > k)
    short = asked.join(enough, asked["entry"] == enough["query"], "left_anti")
    more = short.join(sizes.filter("table = 0").drop("n"), "dim")
    more = more.select("entry", "dim", "vector", "table", "code")
    if not short.isEmpty():
        found = settle(_merged(found.unionByName(_met(cells, more, sizes, k)), k))
    return _ranked(index, asking, found, k)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k + 1 nearest distinct entries of each query."""
    once = found.groupBy("query", "entry").agg(F.max("near").alias("near"))
    order = Window.partitionBy("query").orderBy(F.desc("near"), "entry")
    return once.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).drop("n")


def _ranked(index: DataFrame, asking: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The lists of all asking rows, scored anew on the vectors themselves."""
    mine = index.select(F.col("entry").alias("query"), F.col("vector").alias("_q"))
    pairs = found.join(mine, "query").join(index, "entry")
    product = F.zip_with("_q", "vector", lambda a, b: a * b)
    scored = pairs.select(
        "query",
        F.explode("ids").alias("vec_id"),
        F.aggregate(product, F.lit(0.0), lambda s, x: s + x).alias("score"),
    )
    asking = asking.select("query_id", F.col("entry").alias("query"))
    rows = asking.join(scored, "query").filter(F.col("query_id") != F.col("vec_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
