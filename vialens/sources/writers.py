"""Writes."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialens.operators.scale import settle


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = "ingestion_date",
    fmt: str = "parquet",
    table: str | None = None,
    replace: bool = False,
) -> None:
    """Overwrite a table; with ``partition_by`` only the partitions present in ``df``.

    A named ``table``, and any with ``replace``, is replaced as a whole.
    """
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        mode = "static" if replace else "dynamic"
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", mode)
    if table:
        writer.option("path", path).saveAsTable(table)
    else:
        writer.save(path)


def replace_partition(df: DataFrame, path: str, column: str, value: str) -> None:
    """Puts ``df`` in the place of one partition of a table, and touches no other.

    A partition that has no rows any more is left empty, where a dynamic
    overwrite would keep the old ones.
    """
    df.drop(column).write.mode("overwrite").parquet(f"{path}/{column}={value}")


def landing_rows(files: DataFrame, on_date: Column | None = None) -> DataFrame:
    """Raw files as rows of a landing table.

    A file whose content is missing or cut has failed; ``error`` tells why it was not read.
    """
    return files.select(
        "path",
        "filename",
        "length",
        "modificationTime",
        "content",
        F.when(F.length("content") == F.col("length"), "completed")
        .otherwise("failed")
        .alias("status"),
        *(["error"] if "error" in files.columns else []),
        (F.current_date() if on_date is None else on_date).alias("ingestion_date"),
    )


def land_files(files: DataFrame, path: str, on_date: Column | None = None) -> None:
    """Raw files into a landing table, by ingest date."""
    write_table(landing_rows(files, on_date), path)


def landing_report(landed: DataFrame, seconds: float | None = None) -> DataFrame:
    """Totals of a landing table, and files per second when the duration is known."""
    report = landed.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("status") == "completed").alias("completed"),
        F.count_if(F.col("status") != "completed").alias("failed"),
    ).withColumn(
        "success_rate",
        F.when(F.col("total_files") > 0, F.col("completed") / F.col("total_files") * 100).otherwise(
            0.0
        ),
    )
    if seconds:
        report = report.withColumn("files_per_second", F.col("total_files") / F.lit(seconds))
    return report


def route_validated(checked: DataFrame, path: str) -> None:
    """Documents with text and errors under ``verdict=qualified`` or ``verdict=unqualified``."""
    verdict = F.when(F.col("is_valid"), "qualified").otherwise("unqualified")
    checked.withColumn("verdict", verdict).write.mode("overwrite").partitionBy("verdict").parquet(
        path
    )


def write_report(rows: DataFrame, path: str) -> None:
    """Report rows (section, name, body) as JSON lines, one folder per section."""
    rows.write.mode("overwrite").partitionBy("section").json(path)


def write_image_documents(documents: DataFrame, path: str, subset: str = "subset") -> None:
    """Per-image documents as JSON lines, one folder per subset."""
    documents.write.mode("overwrite").partitionBy(subset).json(path)


def write_gold_csv(gold: DataFrame, path: str) -> None:
    gold.write.mode("overwrite").csv(path, header=True, nullValue="null")


def upserted(old: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """``old`` with the rows of ``new`` put in by key; the higher ``version`` wins.

    On equal versions the row of ``new`` wins. Only the winner per key leaves
    each map task, so a key written very often costs no more than any other.
    """
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    row = F.struct(*[c for c in old.columns if c != key])
    return (
        both.groupBy(key)
        .agg(F.max_by(row, F.struct(version, "_new")).alias("_row"))
        .select(key, "_row.*")
        .select(*old.columns)
    )


def bucket_of(key: str, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: str, n_buckets: int) -> None:
    """Writes ``df`` as a table in ``n_buckets`` folders by hash of the key."""
    rows = df.withColumn("bucket", bucket_of(key, n_buckets)).repartition("bucket")
    write_table(rows, path, partition_by="bucket", replace=True)


def upsert_buckets(
    spark: SparkSession, path: str, new: DataFrame, key: str, version: str, n_buckets: int
) -> None:
    """Puts the rows of ``new`` into a table of ``write_buckets``, see ``upserted``.

    Only the buckets that ``new`` has keys of are read and rewritten; the files of
    the others stay. ``n_buckets`` is that of the table.
    """
    rows = settle(new.withColumn("bucket", bucket_of(key, n_buckets)))
    touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # n_buckets at most
    old = spark.read.parquet(path).where(F.col("bucket").isin(touched))
    merged = settle(upserted(old, rows, key, version))
    write_table(merged.repartition("bucket"), path, partition_by="bucket")


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def write_mapping(spark: SparkSession, rows: list[tuple], path: str, table: str | None = None):
    from vialens.operators.transform import category_mapping

    write_table(category_mapping(spark, rows), path, partition_by=None, table=table)
