"""Benchmark decontamination: size-partitioned MinHash containment search, natively.

Finds the short items that long documents contain: pairs with at least
``threshold`` of an item's distinct word shingles in the document.

Items fall into partitions by size, powers of two. In each, an item's sketch is
its ``floor((1 - t) * u) + 1`` least shingle hashes, u being the largest size
of the partition: a bottom-k MinHash. A document that holds a share t of an
item lacks at most (1 - t) of it, so it holds a hash of the sketch: the search
has no false negatives, at any document length. Candidates are documents that
hold a hash of a sketch; the exact share over all distinct shingles of the item
decides. Shingles are compared by 64-bit hash.

Documents enter the search reduced to the shingles that any item has (that
leaves containment as it is): a join that broadcasts the distinct shingles when
there are at most ``BROADCAST_GRAMS`` of them, and shuffles otherwise. So does
the join with the items' shingles, which are counted with their items.

Defined cases: words are runs of letters and digits, lower-cased, as in the
license scan; an item or text under ``n`` words has its whole word sequence as
its one shingle, so an item of fewer words is found only in a text equal to it,
unless ``short_runs`` also compares the text's runs of as many words as such
items have; items and texts without words meet nothing; repeated rows of a
document are one document under its id, and so are repeated items.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialens.llm.licenses import words

BROADCAST_GRAMS = 2_000_000


def shingles(w: Column, n: int) -> Column:
    """Hashes of all runs of ``n`` words; of the whole sequence if there are fewer, but some."""
    last = F.size(w) - n
    heads = F.slice(w, F.lit(1), F.greatest(last + 1, F.lit(1)))
    hashes = F.transform(
        heads, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, n)])
    )
    return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(hashes)


def item_shingles(items: DataFrame, n: int, id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, hash, size): the distinct shingles of every item and their number."""
    rows = items.select(F.col(id).cast("long").alias("item_id"), words(F.col(text)).alias("w"))
    grams = rows.select("item_id", F.explode(shingles(F.col("w"), n)).alias("hash")).distinct()
    sizes = grams.groupBy("item_id").agg(F.count("*").alias("size"))
    return grams.join(sizes, "item_id")


def sketches(grams: DataFrame, threshold: float) -> DataFrame:
    """(item_id, hash): the bottom-k sketch of every item, k by its size partition."""
    largest = F.pow(F.lit(2), F.ceil(F.log2("size"))).cast("bigint")
    k = F.floor((1 - F.lit(threshold)) * largest + 1e-9) + 1
    by_item = grams.groupBy("item_id").agg(
        F.array_sort(F.collect_set("hash")).alias("hashes"), F.first(k).cast("int").alias("k")
    )
    return by_item.select("item_id", F.explode(F.slice("hashes", F.lit(1), F.col("k"))).alias("hash"))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    n: int = 5,
    threshold: float = 0.75,
    id: str = "doc_id",
    text: str = "text",
    short_runs: bool = False,
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of all pairs at the threshold or above."""
    grams = item_shingles(items, n)
    sizes = [n]
    if short_runs:
        n_words = items.select(F.size(words(F.col("text"))).alias("n")).distinct()
        short = n_words.filter((F.col("n") > 0) & (F.col("n") < n)).collect()  # under n rows
        sizes += sorted(r["n"] for r in short)
    universe = grams.select("hash").distinct()
    n_grams = grams.count()
    if n_grams <= BROADCAST_GRAMS or universe.count() <= BROADCAST_GRAMS:
        universe = F.broadcast(universe)
    if n_grams <= BROADCAST_GRAMS:
        grams = F.broadcast(grams)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), words(F.col(text)).alias("w"))
    hashes = F.concat(*[shingles(F.col("w"), size) for size in sizes])
    reduced = (
        rows.select("doc_id", F.explode(hashes).alias("hash"))
        .join(universe, "hash", "left_semi")
        .distinct()
    )
    sketch = sketches(grams, threshold)
    candidates = reduced.join(sketch, "hash").select("doc_id", "item_id").distinct()
    exact = (
        candidates.join(grams, "item_id")
        .join(reduced, ["doc_id", "hash"])
        .groupBy("doc_id", "item_id")
        .agg(F.count("*").alias("n_shared"), F.first("size").alias("n_item"))
    )
    share = F.col("n_shared") / F.col("n_item")
    return exact.withColumn("containment", share).filter(share >= threshold)
