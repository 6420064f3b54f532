"""Helpers shared by the operators whose groups can grow without bound."""

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without: it gets a temporary folder of its own.
    """
    conf = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="vialens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession) -> str:
    """A path of its own in the application's folder; nothing is there yet."""
    return f"{application_folder(spark)}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> str:
    """Writes ``df`` as a table of its own in the shared folder; returns the path.

    The tables of an application share a folder.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return path


def application_folder(spark: SparkSession) -> str:
    """The application's own folder in the shared one; it goes when the application ends."""
    context = spark.sparkContext
    folder = f"{shared_folder(spark)}/settled/{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(context._jsc.hadoopConfiguration())
    if not store.exists(path):
        store.mkdirs(path)
        store.deleteOnExit(path)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage in a way that outlives lost executors, fixes values that
    depend on physical placement, and gives the planner a known size.
    """
    return df.sparkSession.read.schema(df.schema).parquet(written(df))


def number_rows(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "row_no"
) -> DataFrame:
    """Number rows from 0 in ``order``, within each ``by`` group or over the whole table.

    ``order`` must be a total order within a group. Rows are range-partitioned
    and sorted by (by, order), so one huge group spreads over many tasks, and
    written with their place in their slice. A group's rows in a slice are then
    shifted by where the group starts in it and by the group's rows in earlier
    slices; only these shifts, one per group and slice, are computed and joined.
    """
    by, at = list(by), F.col("_at")
    placed = settle(
        df.repartitionByRange(*by, *order)
        .sortWithinPartitions(*by, *order)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_slice", F.shiftright("_at", 33))
    group = [F.col(c) for c in by] or [F.lit(0)]
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    runs = placed.groupBy(*by, "_slice").agg(
        F.min(at).alias("_start"), F.count(F.lit(1)).alias("_n")
    )
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    shifts = settle(runs.select(*by, "_slice", (before - F.col("_start")).alias("_shift")))
    same = F.col("r._slice") == F.col("s._slice")
    for c in by:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}"))
    return placed.alias("r").join(shifts.alias("s"), same).select(
        *[f"r.{c}" for c in df.columns], (F.col("r._at") + F.col("s._shift")).alias(name)
    )


def member_pages(
    df: DataFrame, by: Sequence[str], member: str, page_size: int = 1000
) -> DataFrame:
    """Sorted member lists per group, cut into pages of at most ``page_size``.

    A group of any size comes out whole, as many rows as it needs pages, and
    no task ever holds more than one page of it. Every occurrence of a member is
    listed; copies are counted first and numbered, so that a member repeated
    very often spreads over slices like any other rows.
    """
    counted = df.groupBy(*by, member).agg(F.count(F.lit(1)).alias("_copies"))
    each = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    numbered = number_rows(each.drop("_copies"), [member, "_copy"], by, "_no")
    page = F.floor(F.col("_no") / page_size).cast("bigint")
    return numbered.groupBy(*by, page.alias("page")).agg(
        F.array_sort(F.collect_list(member)).alias("members"),
        F.count(F.lit(1)).alias("n_members"),
    )
