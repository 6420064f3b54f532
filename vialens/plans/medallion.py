"""Files of label documents to scored scenes, table by table.

Every step reads the table the step before it wrote. A run that breaks off
repeats only the step it was in, and each table's size is known to the next.
"""

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialens.operators import documents as documents_ops
from vialens.operators import gold as gold_ops
from vialens.operators import scoring, transform, validate
from vialens.operators.scale import settle
from vialens.sources import ledger, readers, writers


@dataclass(frozen=True)
class Lake:
    """Where the tables are."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.path(table))

    def read_or_empty(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        """The columns of ``schema``, or no rows while the table does not exist."""
        try:
            found = self.read(spark, table)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)
        return found.select(*spark.createDataFrame([], schema).columns)


def land(
    spark: SparkSession, lake: Lake, source: str, on_date: Column | None = None
) -> DataFrame:
    """Raw files into the landing table of a day; returns the report of this day's files."""
    day = spark.range(1).select(F.current_date() if on_date is None else on_date).first()[0]
    began = time.monotonic()
    files = readers.readable_contents(readers.file_listing(spark, source))
    writers.land_files(files, lake.path("landing"), F.lit(day))
    seconds = time.monotonic() - began
    landed = lake.read(spark, "landing").where(F.col("ingestion_date") == F.lit(day))
    return writers.landing_report(landed, seconds)


def land_changed(
    spark: SparkSession, lake: Lake, source: str, on_date: Column | None = None, at: Column | None = None
) -> DataFrame:
    """Lands the new and changed files of ``source``; returns this run's ledger entries.

    Unchanged, touched and renamed files are not written again, and unchanged
    ones not even opened. The landing comes first: a run that breaks off before
    its ledger lands those files once more, with the same path and digest. A file
    that cannot be read is in no ledger, so every run tries it again.
    """
    known = lake.read_or_empty(spark, "ledger", ledger.LEDGER)
    files = readers.file_listing(spark, source)
    entries = settle(ledger.changes(files, known, F.current_timestamp() if at is None else at))
    fresh = entries.where(F.col("change").isin("new", "changed"))
    landed = writers.landing_rows(readers.readable_contents(fresh), on_date)
    landed = landed.join(fresh.select("path", "digest"), "path")
    landed.write.mode("append").partitionBy("ingestion_date").parquet(lake.path("landed_changes"))
    entries.where(F.col("digest").isNotNull()).write.mode("append").parquet(lake.path("ledger"))
    return entries


def cleanse(spark: SparkSession, lake: Lake, source: str) -> DataFrame:
    """Validates documents and routes them; returns the counts of both sides."""
    checked = validate.validated(readers.raw_documents(spark, source))
    writers.route_validated(checked, lake.path("validated"))
    return validate.validation_summary(lake.read(spark, "validated"))


def refine(
    spark: SparkSession, lake: Lake, on_date: Column | None = None, at_time: Column | None = None
) -> None:
    """Images and labels tables from the qualified documents, each replaced as a whole.

    The text is parsed once, into a table; the images then read little of it.
    What does not reach silver is in ``silver_rejects`` with the reason. The
    tables hold the documents there are, so a run on another day replaces them.
    """
    qualified = lake.read(spark, "validated").where("verdict = 'qualified'")
    found = documents_ops.items(qualified.select("file_name", "value"))
    writers.write_table(documents_ops.rejects(found), lake.path("silver_rejects"), partition_by=None)
    whole = documents_ops.label_documents(found)
    writers.write_table(
        whole.where(F.col("video_name").isNotNull() & F.col("frame_index").isNotNull()),
        lake.path("documents"),
        partition_by=None,
    )
    documents = lake.read(spark, "documents")
    images = transform.images_table(documents, on_date, at_time)
    labels = transform.labels_table(documents, on_date, at_time)
    writers.write_table(images, lake.path("std_images_table"), replace=True)
    writers.write_table(labels, lake.path("std_labels_table"), replace=True)


def aggregate(spark: SparkSession, lake: Lake, mapping: DataFrame | None = None) -> None:
    """The statistics table."""
    mapping = transform.category_mapping(spark) if mapping is None else mapping
    statistics = gold_ops.attribute_distribution(
        lake.read(spark, "std_labels_table"), lake.read(spark, "std_images_table"), mapping
    )
    writers.write_table(statistics, lake.path("srv_attribute_analysis"), partition_by=None)


def score(spark: SparkSession, lake: Lake, mapping: DataFrame | None = None) -> None:
    """Comparison and reminder of every scene."""
    mapping = transform.category_mapping(spark) if mapping is None else mapping
    images = scoring.scene_attributes(lake.read(spark, "documents")).distinct()
    counts = scoring.scene_counts(lake.read(spark, "std_labels_table"), mapping)
    baseline = lake.read(spark, "srv_attribute_analysis")
    comparison = scoring.scene_comparison(images, counts, baseline)
    reminders = scoring.scene_reminders(images, counts, baseline)
    writers.write_table(comparison, lake.path("scene_comparison"), partition_by=None)
    writers.write_table(reminders, lake.path("scene_reminders"), partition_by=None)


# day by day


def cleanse_day(spark: SparkSession, lake: Lake, day: str) -> None:
    """Validates the files that landed on ``day``; their verdicts replace those of that day."""
    landed = lake.read(spark, "landing").where(
        (F.col("ingestion_date") == F.lit(day).cast("date")) & (F.col("status") == "completed")
    )
    texts = landed.select(F.col("filename").alias("file_name"), F.col("content").cast("string").alias("value"))
    checked = validate.validated(texts)
    verdict = F.when(F.col("is_valid"), "qualified").otherwise("unqualified")
    writers.replace_partition(
        checked.withColumn("verdict", verdict), lake.path("validated_by_day"), "ingestion_date", day
    )


def refine_day(spark: SparkSession, lake: Lake, day: str, at_time: Column | None = None) -> None:
    """The images and labels of one day; the partitions of other days stay as they are."""
    on_day = F.col("ingestion_date") == F.lit(day).cast("date")
    validated = lake.read(spark, "validated_by_day").where(on_day & (F.col("verdict") == "qualified"))
    found = documents_ops.items(validated.select("file_name", "value"))
    writers.replace_partition(
        documents_ops.rejects(found), lake.path("rejects_by_day"), "ingestion_date", day
    )
    whole = documents_ops.label_documents(found).where(
        F.col("video_name").isNotNull() & F.col("frame_index").isNotNull()
    )
    writers.replace_partition(whole, lake.path("documents_by_day"), "ingestion_date", day)
    documents = lake.read(spark, "documents_by_day").where(on_day).drop("ingestion_date")
    date = F.lit(day).cast("date")
    for table, rows in (
        ("images_by_day", transform.images_table(documents, date, at_time)),
        ("labels_by_day", transform.labels_table(documents, date, at_time)),
    ):
        writers.replace_partition(rows, lake.path(table), "ingestion_date", day)


def aggregate_days(
    spark: SparkSession, lake: Lake, days: Sequence[str], mapping: DataFrame | None = None
) -> None:
    """Brings the statistics table up to date after ``days`` changed: came, were replaced or went.

    Images and labels of these days are read, and of the others only their
    counts of counts. An image's labels carry its own date.
    """
    mapping = transform.category_mapping(spark) if mapping is None else mapping
    update_states(
        lake.read(spark, "labels_by_day"), lake.read(spark, "images_by_day"), mapping, lake.path("count_state"), days
    )
    statistics = gold_ops.distribution_of(gold_ops.merged_states(lake.read(spark, "count_state")))
    writers.write_table(statistics, lake.path("srv_attribute_analysis"), partition_by=None)


def update_states(
    labels: DataFrame, images: DataFrame, mapping: DataFrame, path: str, days: Sequence[str]
) -> None:
    """Counts the given days anew; the filter reaches the scan, so other days are not read."""
    for day in days:
        on_day = F.col("ingestion_date") == F.lit(day).cast("date")
        state = gold_ops.count_state(labels.where(on_day), images.where(on_day), mapping)
        writers.replace_partition(state, path, "ingestion_date", day)


def run_day(spark: SparkSession, source: str, root: str, day: str) -> Lake:
    """Lands, validates, refines and counts one day; a repeated day replaces itself everywhere."""
    lake = Lake(root)
    land(spark, lake, source, F.lit(day).cast("date"))
    cleanse_day(spark, lake, day)
    refine_day(spark, lake, day)
    aggregate_days(spark, lake, [day])
    return lake


def run(spark: SparkSession, source: str, root: str) -> Lake:
    """All steps over the JSON files of ``source``."""
    lake = Lake(root)
    land(spark, lake, source)
    cleanse(spark, lake, source)
    refine(spark, lake)
    aggregate(spark, lake)
    score(spark, lake)
    return lake
