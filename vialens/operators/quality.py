"""Counts that describe the silver tables, one job per table."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vialens.schemas import SCENE_ATTRIBUTES


def image_quality(images: DataFrame) -> DataFrame:
    return images.agg(
        F.count(F.lit(1)).alias("n_images"),
        F.count_if(F.col("image_id").isNull()).alias("null_image_ids"),
        *[F.count_distinct(a).alias(f"distinct_{a}") for a in SCENE_ATTRIBUTES],
    )


def label_quality(labels: DataFrame) -> DataFrame:
    return labels.agg(
        F.count(F.lit(1)).alias("n_labels"),
        F.count_if(F.col("label_id").isNull()).alias("null_label_ids"),
        F.count_distinct("category").alias("distinct_category"),
    )


def quality_profile(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Both profiles as (table_name, check, n) rows."""

    def long(df: DataFrame, table: str) -> DataFrame:
        return df.unpivot([], df.columns, "check", "n").select(
            F.lit(table).alias("table_name"), "check", "n"
        )

    return long(image_quality(images), "images").unionByName(long(label_quality(labels), "labels"))


def transformation_summary(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Row count and column count per table."""

    def one(df: DataFrame, table: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(table).alias("table_name"),
            "n_rows",
            F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
            F.lit(df.schema.simpleString()).alias("columns"),
        )

    return one(images, "images").unionByName(one(labels, "labels"))


def sample_rows(tables: dict[str, tuple[DataFrame, list[str]]], n: int = 5) -> DataFrame:
    """(table_name, row_no, row): the first ``n`` rows of each table in the given order, as JSON.

    Only the ``n`` first rows of every task meet; ``order`` makes them the same on every run.
    """
    parts = []
    for name, (df, order) in tables.items():
        first = df.orderBy(*order).limit(n)
        at = Window.orderBy(*order)  # n rows
        row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
        parts.append(first.select(F.lit(name).alias("table_name"), F.row_number().over(at).alias("row_no"), row.alias("row")))
    return reduce(DataFrame.unionByName, parts)
