"""Tables and folders in the store that the driver and all executors share."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from vialens.operators.scale import application_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below ``spark.checkpoint.dir``; nothing is there yet."""
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there and its size is known."""
    path = new_folder(df.sparkSession, "table")
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
