"""A corpus clean-up in stages; each stage reads what the one before it wrote.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. Rows with a null id cannot be named by
a decision: the stages that decide by id let them through. Rows that share an id
share their document's fate.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialens.llm import decontamination, ngram_join, pieces, substring_dedup, toxicity
from vialens.llm.queries import vocabulary
from vialens.llm.shared import settle, source

# Training and joins by their nature see the whole corpus, so a stage has no SQL of its own;
# tests/llm/test_pipeline.py holds every stage against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labels, does not reject."""
    model = toxicity.train(docs, source(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, name="_toxic")
    return scored.filter("_toxic < 0.5").drop("_toxic")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    near = ngram_join.near_duplicates(docs, n=5, percent=75)
    copies = near.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 35 words and more that stand anywhere else too."""
    kept = substring_dedup.keep_unrepeated(docs, size=35, untouched=True)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, however short."""
    held = decontamination.contained_items(
        docs, source(spark, sf_dir, "benchmark"), short_runs=True
    )
    held = held.select("doc_id").distinct()
    return docs.join(held, "doc_id", "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, begins, ends, decoded_sha256) of every document that is left.

    ``begins`` and ``ends`` are each piece's span of bytes; the digest is that
    of the text the ids decode to.
    """
    read = pieces.encode_documents(docs, vocabulary("piece_bpe_32k.model"), digest=True)
    n_tokens = F.size("ids").cast("long").alias("n_tokens")
    return read.select("doc_id", n_tokens, "ids", "begins", "ends", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each_group),
    ("repeated_passages", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a written table between them."""
    docs = source(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
