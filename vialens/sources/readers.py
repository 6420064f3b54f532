"""Reads. Every schema is declared; file names come from the file metadata."""

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vialens import schemas


def label_documents(spark: SparkSession, path: str) -> DataFrame:
    """Label documents, one per file or one per element of a top-level array.

    A file that does not parse gives one row holding its text in ``_corrupt_record``.
    """
    return (
        spark.read.schema(schemas.LABEL_DOCUMENT)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(path)
        .withColumn("file_name", F.col("_metadata.file_name"))
    )


def raw_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as text, for validation."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file_name"), "value"
    )


def label_lists(spark: SparkSession, path: str) -> DataFrame:
    """Frames of ``det_<split>.json`` lists, with their split."""
    return label_documents(spark, path).withColumn(
        "split", F.regexp_extract("file_name", r"det_(.*)\.json", 1)
    )


def scene_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schemas.SCENE_CSV)


def gold_csv(spark: SparkSession, path: str) -> DataFrame:
    """The statistics table as CSV; the text ``null`` reads as NULL."""
    return spark.read.csv(path, header=True, schema=schemas.GOLD, nullValue="null")


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """Annotation documents, generated or true."""
    corrupt = T.StructField(schemas.CORRUPT, T.StringType())
    schema = T.StructType([*schemas.GENERATED_ANNOTATION.fields, corrupt])
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(path)
        .withColumn("file_name", F.col("_metadata.file_name"))
    )


def file_listing(
    spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = True
) -> DataFrame:
    """Files as rows: path, filename, length, modificationTime. Contents are not read.

    Spark's file sources pass over empty files, so these are not listed.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("filename"), "length",
        "modificationTime",
    )


def readable_contents(files: DataFrame) -> DataFrame:
    """``files`` (from file_listing) with ``content``, or NULL and the ``error`` met.

    Every task opens its own files, so one that cannot be read costs only itself.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, path in enumerate(batch.column(0).to_pylist()):
                content = error = None
                try:
                    content = read_bytes(path)
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
                row = batch.slice(i, 1)
                added = [pa.array([content], pa.binary()), pa.array([error], pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [*row.columns, *added], [*row.schema.names, "content", "error"]
                )

    fields = "path string, filename string, length long, modificationTime timestamp"
    return files.select("path", "filename", "length", "modificationTime").mapInArrow(
        read, f"{fields}, content binary, error string"
    )


def read_bytes(path: str) -> bytes:
    """A whole file, from any store pyarrow can name by URI. ``path`` as Spark lists it."""
    uri = quote(path.replace("s3a://", "s3://", 1), safe="/:@")
    store, inner = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(inner) as stream:
        return stream.read()


def file_contents(
    spark: SparkSession, path: str, pattern: str | None = None, since: str | None = None
) -> DataFrame:
    """Files with their bytes, for scorers and landing.

    ``since`` keeps files changed at or after that time; it reaches the source,
    so older files are not opened at all.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path)
    if since:
        files = files.where(F.col("modificationTime") >= F.lit(since).cast("timestamp"))
    return files.withColumn("filename", F.element_at(F.split("path", "/"), -1))
