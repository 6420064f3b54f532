"""Retrieval corpora and exact top-k search over them."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vialens.functions.text import city_of, text_slices
from vialens.operators.scale import number_rows, settle

# Query vectors handed to every task at once; larger query sets are split.
QUERY_LIMIT = 1024
# Vectors of one task when both sides are split, and their bytes; its queries are as many limits.
CELL_ROWS = 50_000
CELL_BYTES = 32 << 20
CELL_LIMITS = 32
# Scores of a tile, that a task holds at once.
TILE_SCORES = 1 << 20

# Scores closer than this count as equal and are ordered by id.
SCORE_DIGITS = 9


def shaped_documents(
    corpus: DataFrame,
    order: str,
    source: Column,
    passage: str = "passage",
    text: str = "text",
) -> DataFrame:
    """id (``doc_<position>``), content and source of every corpus record.

    Content is the passage, else the text, else the whole record as JSON.
    Positions follow ``order``, which must be unique. Only the ``order`` column
    is numbered; the records meet their numbers in a join by it, whose
    partitioning a later join by the same column (with_embeddings) reuses.
    """
    have = [F.col(c) for c in (passage, text) if c in corpus.columns]
    content = F.coalesce(*have, F.to_json(F.struct("*")))
    shaped = corpus.select(order, content.alias("content"), source.alias("source"))
    positions = number_rows(corpus.select(order), [order], name="_i")
    return shaped.join(positions, order).select(
        order, F.concat(F.lit("doc_"), F.col("_i").cast("string")).alias("id"), "content", "source"
    )


def with_embeddings(documents: DataFrame, embeddings: DataFrame, key: str) -> DataFrame:
    """Documents with their vector, joined by ``key``; documents without one drop out."""
    return documents.join(embeddings.select(key, "embedding"), key)


def qa_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.coalesce("question", F.lit("")).alias("question"),
        F.coalesce("answer", F.lit("")).alias("answer"),
    )


def chunk_table(
    documents: DataFrame, filename: str = "filename", text: str = "text", size: int = 1500
) -> DataFrame:
    """One row per text slice, with city and an id that is the same on every run."""
    return documents.select(
        F.col(filename).alias("filename"),
        city_of(F.col(filename)).alias("city"),
        F.posexplode(text_slices(F.col(text), size)).alias("chunk_no", "content"),
    ).select(
        F.sha2(F.concat_ws("\u0001", "filename", F.col("chunk_no").cast("string")), 256).alias("id"),
        "city",
        "filename",
        "chunk_no",
        "content",
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """An Arrow list column as a float64 matrix, without a Python object per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros((0, 0))
    lengths = pc.min_max(pc.list_value_length(column))
    if lengths["min"] != lengths["max"]:
        raise ValueError("vectors of one column must have the same length")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1)


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best, by score then id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


class _Running:
    """The k best documents seen so far, per query; vectors meet the queries in tiles."""

    def __init__(self, query_ids, query_matrix: np.ndarray, k: int):
        self.query_ids, self.queries, self.k = query_ids, _unit(query_matrix), k
        self.kept: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(query_ids)
        # the k-th score of each query; what is below is no hit
        self.least = np.full(len(query_ids), -np.inf)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        if not len(ids):
            return
        if vectors.shape[1] != self.queries.shape[1]:
            raise ValueError("query and document vectors differ in length")
        units, width = _unit(vectors), max(1, min(len(self.query_ids), QUERY_LIMIT))
        height = max(1, TILE_SCORES // width)
        for first in range(0, len(self.query_ids), width):
            queries = self.queries[first : first + width]
            for at in range(0, len(ids), height):
                self._add_tile(first, queries @ units[at : at + height].T, ids[at : at + height])

    def _add_tile(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` of some queries from ``first`` on with the vectors ``ids``."""
        scores = np.round(scores, SCORE_DIGITS, out=scores)
        query, place = np.nonzero(scores >= self.least[first : first + len(scores), None])
        limits = np.searchsorted(query, np.arange(len(scores) + 1)).tolist()
        for q, (a, b) in enumerate(zip(limits, limits[1:])):
            if a == b:
                continue
            s, i = scores[q, place[a:b]], ids[place[a:b]]
            kept = self.kept[first + q]
            if kept is not None:
                s, i = np.concatenate([kept[0], s]), np.concatenate([kept[1], i])
            top = _best(s, i, self.k)
            self.kept[first + q] = (s[top], i[top])
            if len(top) == self.k:
                self.least[first + q] = s[top[-1]]

    def rows(self, schema: pa.Schema) -> pa.RecordBatch:
        q, i, s = [], [], []
        for query, kept in zip(self.query_ids, self.kept):
            if kept is not None:
                q += [query] * len(kept[0])
                i += kept[1].tolist()
                s += kept[0].tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip((q, i, s), schema)], schema=schema
        )


def _ids(column) -> np.ndarray:
    return np.array(column.to_pylist()) if pa.types.is_string(column.type) else column.to_numpy()


def _hit_schema(queries: DataFrame, documents: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("id", documents.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _arrow(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def top_k(
    queries: DataFrame, documents: DataFrame, k: int = 3, query_limit: int = QUERY_LIMIT
) -> DataFrame:
    """The k documents of highest cosine for each query: query_id, rank, id, score.

    ``queries``: query_id, embedding. ``documents``: id (unique), embedding.
    Exact. Ties go to the lower id. Up to ``query_limit`` queries travel to the
    documents, which are read once, not shuffled, and leave k rows per query
    and task. A larger query set is split against a split corpus instead.
    """
    documents = documents.select("id", "embedding").where(F.col("embedding").isNotNull())
    queries = queries.select("query_id", "embedding").where(F.col("embedding").isNotNull())
    schema = _hit_schema(queries, documents)
    head = queries.limit(query_limit + 1).toArrow()
    if head.num_rows <= query_limit:
        hits = _scan_hits(head, documents, k, schema)
    else:
        hits = _split_hits(settle(queries), documents, k, schema, query_limit)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def _scan_hits(head: pa.Table, documents: DataFrame, k: int, schema: T.StructType) -> DataFrame:
    if head.num_rows == 0:
        return documents.sparkSession.createDataFrame([], schema)
    query_ids = head.column("query_id").to_pylist()
    matrix = _matrix(head.column("embedding"))
    out = _arrow(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = _Running(query_ids, matrix, k)
        for b in batches:
            running.add(_ids(b.column("id")), _matrix(b.column("embedding")))
        yield running.rows(out)

    return documents.mapInArrow(scan, schema)


def _split_hits(
    queries: DataFrame, documents: DataFrame, k: int, schema: T.StructType, query_limit: int
) -> DataFrame:
    """Both sides cut into slices; a task gets one slice of each.

    Every pair of slices meets once, so the result is exact. A task holds about
    CELL_ROWS documents of CELL_BYTES and CELL_LIMITS times ``query_limit`` queries
    at most, and their scores tile by tile; a side moves once for each slice of the other.
    """
    n, width = documents.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    room = max(1, CELL_BYTES // (8 * max(1, width or 1)))
    n_q = -(-queries.count() // min(CELL_LIMITS * query_limit, room))
    n_d = max(1, -(-n // min(CELL_ROWS, room)))

    def slices(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int):
        return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own))).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        )

    q = slices(queries, "query_id", "_q", n_q, "_d", n_d)
    d = slices(documents, "id", "_d", n_d, "_q", n_q)
    out = _arrow(schema)

    def meet(qs: pa.Table, ds: pa.Table) -> pa.Table:
        if qs.num_rows == 0 or ds.num_rows == 0:
            return out.empty_table()
        running = _Running(qs.column("query_id").to_pylist(), _matrix(qs.column("embedding")), k)
        running.add(_ids(ds.column("id").combine_chunks()), _matrix(ds.column("embedding")))
        return pa.Table.from_batches([running.rows(out)])

    cell = [F.col("_q").cast("bigint"), F.col("_d").cast("bigint")]
    return q.groupBy(*cell).cogroup(d.groupBy(*cell)).applyInArrow(meet, schema)


def hits_with_content(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """Hits with the content and source of their document.

    Settled first: hits are few, and once Spark knows that it need not shuffle
    the documents to meet them.
    """
    return settle(hits).join(documents.select("id", "content", "source"), "id").select(
        "query_id", "rank", "content", "source"
    )


# The system text around the retrieved documents.
CONTEXT_HEAD = (
    "You are a helpful assistant that answers questions using Wikipedia knowledge.\n"
    "Answer user questions using ONLY the text from these docs.\n"
    "Docs:\n"
)
CONTEXT_TAIL = "\nIf unsure, say 'I'm not sure based on the provided information'.\n"


def context_texts(hits: DataFrame) -> DataFrame:
    """One system text per query, its documents in rank order (at most k lines)."""
    line = F.format_string("Source: %s => %s", F.col("source"), F.col("content"))
    ranked = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    body = F.array_join(F.transform(ranked, lambda x: x["line"]), "\n")
    return hits.groupBy("query_id").agg(
        F.concat(F.lit(CONTEXT_HEAD), body, F.lit(CONTEXT_TAIL)).alias("system_text")
    )


def transcripts(turns: DataFrame, part_turns: int = 64) -> DataFrame:
    """User and assistant turns of each thread, in order, as text.

    A part covers ``part_turns`` turn numbers, so a thread of any length comes
    out whole as several rows, none of which gathers more than that many turns.
    Turn numbers are unique within a thread.
    """
    line = F.concat(F.col("role"), F.lit(": "), F.col("text"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", line.alias("line"))))
    part = F.floor(F.col("turn") / part_turns).cast("bigint")
    return (
        turns.where(F.col("role").isin("user", "assistant"))
        .groupBy("conv_id", part.alias("part"))
        .agg(
            F.count(F.lit(1)).alias("n_turns"),
            F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("transcript"),
        )
    )


def last_assistant(turns: DataFrame) -> DataFrame:
    """The newest assistant text of each thread."""
    return (
        turns.where(F.col("role") == "assistant")
        .groupBy("conv_id")
        .agg(F.max("turn").alias("turn"), F.max_by("text", "turn").alias("text"))
    )
