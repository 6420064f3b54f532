"""Keyword search: an inverted index in blocks, BM25 scores, and a top-k that skips blocks.

The index has a row for every term and block of ``BLOCK_DOCUMENTS`` documents that
hold it: the documents with the term's count and their lengths, and the largest
weight the term has in the block. Blocks are ranges of document numbers, the
same for all terms, so the weights of a query's terms add up to a bound of every
score in a block. A search reads the bounds first, scores the most promising
blocks of each query, and then only those whose bound reaches the k-th best score
found. Nothing else can hold a hit, so the result is that of scoring everything.

A term in a third of all documents is many rows, one a block; no row holds more
than a block. A file holds all terms of some blocks, in order of term and block, so
a search for few terms reads few pages of each.

What moves between tasks is the text, twice, when an index is built, and the rows
of the asked terms, by block, in a search: a block's terms meet in one task, as a
matrix of terms and documents that is multiplied by the one of queries and terms.
Only scores that reach a query's k-th best so far leave it.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vialens.operators.scale import number_rows, settle

K1 = 1.2
B = 0.75
BLOCK_DOCUMENTS = 128
# Terms of all queries that are named in the scan's filter; more are joined only.
FILTER_TERMS = 1000
# Scores closer than this count as equal and are ordered by id.
SCORE_DIGITS = 9
# Words of a task that writes the index, and scores (of a query and document) of one that searches.
TASK_WORDS = 2_000_000
TASK_SCORES = 1_000_000
# With so many pairs of query and block, every task is sent the blocks; more are shuffled.
BROADCAST_PAIRS = 4_000_000
# Terms of queries that every task is sent at once; more queries are scored in slices.
SENT_TERMS = 1_000_000
# Cells of the matrix of queries and terms that a task fills at once.
CELLS = 2_000_000
# Ranks are damped by this when two result lists are fused.
FUSION = 60

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes of words as ``WORD`` has them, in lower case; all others as a space.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


@dataclass(frozen=True)
class KeywordIndex:
    """Tables of an index, and what BM25 needs to know of the whole corpus."""

    postings: DataFrame
    terms: DataFrame
    n_documents: int
    mean_length: float
    block_documents: int


def words_of(text: Column) -> Column:
    """Letters and digits, and everything outside ASCII; A-Z in lower case. NULL has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(f"({WORD})"), F.lit(1))


def _words(texts: pa.Array) -> Iterator[list[bytes]]:
    """``words_of`` every text, as bytes."""
    for text in texts.cast(pa.large_binary()).to_pylist():
        yield (text or b"").translate(_BYTES).split()


def _weight(tf: np.ndarray, length: np.ndarray, mean_length: float) -> np.ndarray:
    """What a term counts in a document, before its rarity."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))


def _rarity(df: Column, n_documents: int) -> Column:
    return F.log1p((n_documents - df + 0.5) / (df + 0.5))


def _tasks(n: int, each: int) -> int:
    return max(1, -(-n // each))


def _lengths(texts: DataFrame) -> DataFrame:
    """(id, length): the words of all rows of an id."""
    schema = T.StructType([texts.schema["id"], T.StructField("length", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pa.array([len(w) for w in _words(batch.column(1))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n], ["id", "length"])

    return texts.mapInArrow(count, schema).groupBy("id").agg(F.sum("length").alias("length"))


def _postings(placed: DataFrame, mean: float) -> DataFrame:
    """(term, block, bound, documents) of the rows (block, id, length, text); a block stays in one task."""
    posting = T.StructType(
        [T.StructField("id", placed.schema["id"].dataType)] + [T.StructField(c, T.LongType()) for c in ("tf", "length")]
    )
    schema = T.StructType(
        [
            T.StructField("term", T.StringType()),
            T.StructField("block", T.LongType()),
            T.StructField("bound", T.DoubleType()),
            T.StructField("documents", T.ArrayType(posting)),
        ]
    )
    out = to_arrow_schema(schema)

    def invert(key, rows):
        own = rows.column("id").combine_chunks()
        ids = own.unique()
        ids = ids.take(pc.sort_indices(ids))
        number = pc.index_in(own, value_set=ids).to_numpy()
        length = np.zeros(len(ids), np.int64)
        length[number] = rows.column("length").to_numpy()
        words, document = [], []
        for n, found in zip(number.tolist(), _words(rows.column("text").combine_chunks()), strict=True):
            words += found
            document.append(np.full(len(found), n))
        coded = pa.array(words, pa.binary()).dictionary_encode()
        pairs = coded.indices.to_numpy().astype(np.int64) * len(ids) + np.concatenate(document)
        pairs, tf = np.unique(pairs, return_counts=True)
        term, document = pairs // len(ids), pairs % len(ids)
        at = np.searchsorted(term, np.arange(len(coded.dictionary) + 1))
        bound = np.maximum.reduceat(_weight(tf, length[document], mean), at[:-1]) if len(tf) else []
        documents = pa.StructArray.from_arrays(
            [ids.take(pa.array(document)), pa.array(tf), pa.array(length[document])],
            fields=list(out.field("documents").type.value_type),
        )
        columns = [
            coded.dictionary.cast(pa.string()),
            pa.array(np.full(len(coded.dictionary), key[0].as_py())),
            pa.array(bound, pa.float64()),
            pa.ListArray.from_arrays(pa.array(at, pa.int32()), documents, type=out.field("documents").type),
        ]
        return pa.Table.from_arrays(columns, schema=out)

    return placed.groupBy("block").applyInArrow(invert, schema)


def build_index(
    documents: DataFrame,
    folder: str,
    id: str = "id",
    text: str = "content",
    block_documents: int = BLOCK_DOCUMENTS,
) -> KeywordIndex:
    """Writes the index of ``documents`` below ``folder`` and opens it.

    Rows that share an id are one document. Documents without a word are not in
    the index; neither are rows without an id.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(id).alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull())
    lengths = settle(_lengths(texts).where(F.col("length") > 0))
    whole = lengths.agg(
        F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"), F.sum("length").alias("words")
    ).first()
    n, mean = whole["n"], whole["mean"] or 1.0
    numbered = number_rows(lengths, ["id"], name="_no")
    block = F.floor(F.col("_no") / block_documents).cast("bigint")
    placed = texts.join(numbered.select("id", "length", block.alias("block")), "id")
    # all that is counted and collected below stays in a block
    placed = placed.repartition(_tasks(whole["words"] or 0, TASK_WORDS), "block")
    postings = _postings(placed, mean)
    postings.sortWithinPartitions("term", "block").write.mode("overwrite").parquet(f"{folder}/postings")
    written = spark.read.parquet(f"{folder}/postings")
    terms = written.groupBy("term").agg(F.sum(F.size("documents").cast("bigint")).alias("df"))
    terms.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(
        f"{folder}/terms"
    )
    stats = spark.createDataFrame(
        [(n, mean, block_documents)], "n_documents long, mean_length double, block_documents long"
    )
    stats.coalesce(1).write.mode("overwrite").parquet(f"{folder}/stats")
    return open_index(spark, folder)


def open_index(spark: SparkSession, folder: str) -> KeywordIndex:
    stats = spark.read.parquet(f"{folder}/stats").first()
    return KeywordIndex(
        spark.read.parquet(f"{folder}/postings"),
        spark.read.parquet(f"{folder}/terms"),
        stats["n_documents"],
        stats["mean_length"],
        stats["block_documents"],
    )


def _query_terms(index: KeywordIndex, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(query_id, term, weight) of the indexed terms, and the postings cut to them where they are few.

    A term that a query repeats counts as often.
    """
    said = queries.select("query_id", F.explode(words_of(F.col("text"))).alias("term"))
    said = said.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("_times"))
    weight = F.col("_times") * _rarity(F.col("df"), index.n_documents)
    wanted = settle(said.join(index.terms, "term").select("query_id", "term", weight.alias("weight")))
    distinct = [r.term for r in wanted.select("term").distinct().limit(FILTER_TERMS + 1).collect()]
    postings = index.postings
    if len(distinct) <= FILTER_TERMS:
        postings = postings.where(F.col("term").isin(distinct))
    return wanted, postings


def block_bounds(index: KeywordIndex, queries: DataFrame) -> DataFrame:
    """(query_id, block, bound): no document of the block scores higher."""
    wanted, postings = _query_terms(index, queries)
    return _bounds(wanted, postings)


def _bounds(wanted: DataFrame, postings: DataFrame) -> DataFrame:
    if wanted.count() <= SENT_TERMS:  # else both sides are shuffled
        wanted = wanted.hint("broadcast")
    met = postings.select("term", "block", F.col("bound").alias("_max")).join(wanted, "term")
    return met.groupBy("query_id", "block").agg(F.sum(F.col("weight") * F.col("_max")).alias("bound"))


def _sent(wanted: DataFrame) -> tuple:
    """``wanted`` as arrays: the terms, the queries, and by term where its queries and weights lie."""
    table = wanted.toArrow().combine_chunks()
    terms, queries = (table.column(c).combine_chunks().unique() for c in ("term", "query_id"))
    term = pc.index_in(table.column("term"), value_set=terms).to_numpy()
    order = np.argsort(term, kind="stable")
    at = np.searchsorted(term[order], np.arange(len(terms) + 1))
    query = pc.index_in(table.column("query_id"), value_set=queries).to_numpy()[order]
    return terms, queries, at, query, table.column("weight").to_numpy()[order]


def _block_scores(used: pa.Table, asked: pa.Table, sent: tuple, mean: float, out: pa.Schema) -> pa.Table:
    """Scores of a block's documents for the queries that ask for it, from their floors on."""
    if not used.num_rows or not asked.num_rows:
        return out.empty_table()
    terms, queries, at, of, weights = sent
    asking = asked.column("asking").combine_chunks().flatten()
    own, floor = asking.flatten()
    floor = floor.fill_null(-np.inf).to_numpy(zero_copy_only=False)
    place = np.full(len(queries), -1)
    place[pc.index_in(own, value_set=queries).to_numpy(zero_copy_only=False)] = np.arange(len(own))
    found = used.column("documents").combine_chunks()
    n_found = pc.list_value_length(found).to_numpy()
    ids, tf, length = found.flatten().flatten()
    coded = ids.dictionary_encode()
    held = np.zeros((used.num_rows, len(coded.dictionary)))
    row = np.repeat(np.arange(used.num_rows), n_found)
    held[row, coded.indices.to_numpy()] = _weight(tf.to_numpy(), length.to_numpy(), mean)
    # the queries of every row's term, by their place among those that ask
    term = pc.index_in(used.column("term"), value_set=terms).to_numpy()
    times = at[term + 1] - at[term]
    entry = np.repeat(at[term] - (np.cumsum(times) - times), times) + np.arange(times.sum())
    row, query, weight = np.repeat(np.arange(used.num_rows), times), place[of[entry]], weights[entry]
    order = np.argsort(query, kind="stable")
    row, query, weight = row[order], query[order], weight[order]
    tables, step = [out.empty_table()], max(1, CELLS // used.num_rows)
    for first in range(0, len(own), step):
        a, b = np.searchsorted(query, [first, first + step])
        says = np.zeros((min(step, len(own) - first), used.num_rows))
        says[query[a:b] - first, row[a:b]] = weight[a:b]
        scores = says @ held
        q, d = np.nonzero((scores > 0) & (scores >= floor[first : first + step, None]))
        columns = [own.take(pa.array(q + first)), coded.dictionary.take(pa.array(d)), pa.array(scores[q, d])]
        tables.append(pa.Table.from_arrays(columns, schema=out))
    return pa.concat_tables(tables)


def _scored(
    index: KeywordIndex, wanted: DataFrame, postings: DataFrame, chosen: DataFrame
) -> DataFrame:
    """(query_id, id, score) of all documents in the chosen (query_id, block).

    Scores below ``floor``, where ``chosen`` has it, are left out. A block's rows
    of the wanted terms meet in one task, so its documents' scores add up there.
    """
    if "floor" not in chosen.columns:
        chosen = chosen.withColumn("floor", F.lit(None).cast("double"))
    chosen = settle(chosen.select("query_id", "block", "floor").where(F.col("query_id").isNotNull()))
    wanted = wanted.where(F.col("query_id").isNotNull())
    n_slices = _tasks(wanted.count(), SENT_TERMS)
    own = F.pmod(F.xxhash64("query_id"), F.lit(n_slices))
    parts = [
        _slice_scores(index, wanted.where(own == i), postings, chosen.where(own == i)) for i in range(n_slices)
    ]
    return reduce(DataFrame.union, parts)


def _slice_scores(
    index: KeywordIndex, wanted: DataFrame, postings: DataFrame, chosen: DataFrame
) -> DataFrame:
    """``_scored`` of so few queries that their terms can be sent to every task."""
    sized = chosen.agg(
        F.count(F.lit(1)).alias("pairs"), F.count_distinct("block").alias("blocks")
    ).first()
    by_block = chosen.groupBy("block").agg(F.collect_list(F.struct("query_id", "floor")).alias("asking"))
    small = sized["pairs"] <= BROADCAST_PAIRS
    blocks = chosen.select("block").distinct().hint("broadcast" if small else "merge")
    used = postings.join(wanted.select("term").distinct().hint("broadcast"), "term", "left_semi")
    used = used.join(blocks, "block", "left_semi").select("term", "block", "documents")
    n_tasks = min(_tasks(sized["pairs"] * index.block_documents, TASK_SCORES), max(1, sized["blocks"]))
    used, by_block = used.repartition(n_tasks, "block"), by_block.repartition(n_tasks, "block")
    ids = postings.schema["documents"].dataType.elementType["id"].dataType
    schema = T.StructType(
        [wanted.schema["query_id"], T.StructField("id", ids), T.StructField("score", T.DoubleType())]
    )
    sent = wanted.sparkSession.sparkContext.broadcast(_sent(wanted))
    out, mean = to_arrow_schema(schema), index.mean_length

    def score(used: pa.Table, asked: pa.Table) -> pa.Table:
        return _block_scores(used, asked, sent.value, mean, out)

    met = used.groupBy("block").cogroup(by_block.groupBy("block")).applyInArrow(score, schema)
    return met.select("query_id", "id", F.round("score", SCORE_DIGITS).alias("score"))


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _waves(
    index: KeywordIndex, wanted: DataFrame, postings: DataFrame, k: int
) -> tuple[DataFrame, DataFrame]:
    """(hits of the first wave, blocks of the second with the least score that may count).

    The first takes every query's blocks of highest bound, as many as could hold
    2k documents. A block goes into the second if its bound reaches the k-th
    score of the first; a query with fewer hits so far takes all its blocks.
    """
    order = Window.partitionBy("query_id").orderBy(F.desc("bound"), F.asc("block"))
    bounds = settle(_bounds(wanted, postings).withColumn("_place", F.row_number().over(order)))
    n_first = -(-2 * k // index.block_documents)
    first = bounds.where(F.col("_place") <= n_first)
    hits = settle(_best(_scored(index, wanted, postings, first), k))
    least = hits.where(F.col("rank") == k).select("query_id", F.col("score").alias("_least"))
    slack = 2 * 10**-SCORE_DIGITS
    rest = bounds.where(F.col("_place") > n_first).join(least, "query_id", "left")
    floor = F.col("_least") - slack
    more = rest.where(F.col("_least").isNull() | (F.col("bound") >= floor))
    return hits, more.select("query_id", "block", floor.alias("floor"))


def keyword_top_k(index: KeywordIndex, queries: DataFrame, k: int = 10) -> DataFrame:
    """The k documents of highest BM25 score for each query: query_id, rank, id, score.

    ``queries``: query_id, text. Documents that share no term with a query are
    no hits of it. Ties go to the lower id.
    """
    wanted, postings = _query_terms(index, queries)
    hits, more = _waves(index, wanted, postings, k)
    later = _scored(index, wanted, postings, more)
    return _best(hits.drop("rank").union(later), k).select("query_id", "rank", "id", "score")


def all_scores(index: KeywordIndex, queries: DataFrame) -> DataFrame:
    """(query_id, id, score) of every document that shares a term, nothing skipped."""
    wanted, postings = _query_terms(index, queries)
    return _scored(index, wanted, postings, _bounds(wanted, postings))


def pruning(index: KeywordIndex, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, n_blocks, n_scored): how many of a query's blocks its search scores."""
    wanted, postings = _query_terms(index, queries)
    hits, more = _waves(index, wanted, postings, k)
    n_blocks = _bounds(wanted, postings).groupBy("query_id").agg(F.count(F.lit(1)).alias("n_blocks"))
    n_more = more.groupBy("query_id").agg(F.count(F.lit(1)).alias("_more"))
    first = F.least(F.col("n_blocks"), F.lit(-(-2 * k // index.block_documents)).cast("bigint"))
    return n_blocks.join(n_more, "query_id", "left").select(
        "query_id", "n_blocks", (first + F.coalesce("_more", F.lit(0))).alias("n_scored")
    )


def fused(results: list[DataFrame], k: int = 10, damping: int = FUSION) -> DataFrame:
    """Result lists (query_id, rank, id) as one, by the sum of 1 / (damping + rank).

    Ties go to the lower id. A document counts in every list that has it.
    """
    parts = [r.select("query_id", "id", (1 / (damping + F.col("rank"))).alias("_part")) for r in results]
    both = reduce(DataFrame.unionByName, parts).groupBy("query_id", "id")
    scored = both.agg(F.round(F.sum("_part"), SCORE_DIGITS).alias("score"))
    return _best(scored, k).select("query_id", "rank", "id", "score")
