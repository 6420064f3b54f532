"""The batch functions on streams of files."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vialens.operators.documents import items, label_documents
from vialens.operators.scoring import scene_attributes, scene_comparison, scene_counts
from vialens.operators.transform import labels_table
from vialens.operators.validate import validated
from vialens.sources.writers import route_validated


# Files taken into one micro-batch: a backlog is worked off in bounded steps.
BATCH_FILES = 10_000


def route_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    batch_files: int = BATCH_FILES,
    **trigger,
) -> StreamingQuery:
    """Validates arriving documents and appends them, by verdict, under ``target``.

    Each micro-batch writes its own folder and overwrites it when replayed, so a
    restarted query neither loses nor doubles documents.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", batch_files)
    arriving = reader.text(source, wholetext=True).select(
        F.col("_metadata.file_name").alias("file_name"), "value"
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        route_validated(validated(batch), f"{target}/batch={batch_id}")

    return (
        arriving.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def document_stream(
    spark: SparkSession, source: str, batch_files: int = BATCH_FILES
) -> DataFrame:
    """Arriving files as text; documents are taken from them as in the batch."""
    return (
        spark.readStream.option("maxFilesPerTrigger", batch_files)
        .text(source, wholetext=True)
        .select(F.col("_metadata.file_name").alias("file_name"), "value")
    )


def compare_documents(documents: DataFrame, mapping: DataFrame, gold: DataFrame) -> DataFrame:
    """scene_comparison straight from label documents."""
    counts = scene_counts(labels_table(documents), mapping)
    return scene_comparison(scene_attributes(documents).distinct(), counts, gold)


def score_stream(
    spark: SparkSession,
    source: str,
    mapping: DataFrame,
    gold: Callable[[], DataFrame],
    target: str,
    checkpoint: str,
    batch_files: int = BATCH_FILES,
    **trigger,
) -> StreamingQuery:
    """Scores arriving documents against the statistics table, micro-batch by micro-batch.

    A document arrives whole, so its counts are complete within its batch and no
    state is kept between batches. ``gold`` is called for every batch, so a table
    that was rewritten meanwhile is read anew. Files that qualify are scored, as
    in the batch job.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        qualified = validated(batch).where("is_valid").select("file_name", "value")
        documents = label_documents(items(qualified))
        compare_documents(documents, mapping, gold()).write.mode("overwrite").parquet(
            f"{target}/batch={batch_id}"
        )

    return (
        document_stream(spark, source, batch_files)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
