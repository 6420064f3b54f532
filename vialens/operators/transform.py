"""Silver tables: images and labels from nested label documents."""

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialens.functions.boxes import box_area
from vialens.functions.text import file_stem, is_image_name
from vialens.operators.scale import settle
from vialens.schemas import CATEGORY_MAPPING, CATEGORY_ROWS, SCENE_ATTRIBUTES


def image_key(video: Column, frame: Column) -> Column:
    # concat, not concat_ws: a missing part must make the key NULL
    return F.concat(video, F.lit("-"), frame.cast("string"))


def _lineage(on_date: Column | None, at_time: Column | None) -> list[Column]:
    return [
        (on_date if on_date is not None else F.current_date()).alias("ingestion_date"),
        (at_time if at_time is not None else F.current_timestamp()).alias("processing_date"),
    ]


def images_table(
    documents: DataFrame, on_date: Column | None = None, at_time: Column | None = None
) -> DataFrame:
    """One row per distinct image. The source of each value is chosen per row."""
    key = image_key(F.col("video_name"), F.col("frame_index"))
    return documents.select(
        F.coalesce("name", "image_filename", F.concat(key, F.lit(".jpg"))).alias("filename"),
        key.alias("image_id"),
        "video_name",
        "frame_index",
        F.col("timestamp").cast("bigint").alias("timestamp"),
        *[
            F.coalesce(F.col(f"metadata.{a}"), F.col(f"attributes.{a}")).alias(a)
            for a in SCENE_ATTRIBUTES
        ],
        F.coalesce(F.size("labels"), F.lit(0)).alias("total_labels"),
        *_lineage(on_date, at_time),
    ).distinct()


def labels_table(
    documents: DataFrame, on_date: Column | None = None, at_time: Column | None = None
) -> DataFrame:
    """One row per label item, with box geometry. Corners that do not read as numbers are NULL."""
    items = documents.select(
        image_key(F.col("video_name"), F.col("frame_index")).alias("image_id"),
        F.explode("labels").alias("label"),
    )
    corners = {c: F.col(f"label.box2d.{c}").try_cast("double") for c in ("x1", "y1", "x2", "y2")}
    colour = F.col("label.attributes.trafficLightColor")
    return items.select(
        F.col("label.id").alias("label_id"),
        "image_id",
        F.col("label.category").alias("category"),
        *[v.alias(f"bbox_{c}") for c, v in corners.items()],
        (corners["x2"] - corners["x1"]).alias("bbox_width"),
        (corners["y2"] - corners["y1"]).alias("bbox_height"),
        box_area(*corners.values()).alias("bbox_area"),
        F.col("label.attributes.occluded").try_cast("boolean").alias("is_occluded"),
        F.col("label.attributes.truncated").try_cast("boolean").alias("is_truncated"),
        F.nullif(colour, F.lit("NA")).alias("traffic_light_color"),
        *_lineage(on_date, at_time),
    )


def category_mapping(spark, rows: Iterable[tuple] = CATEGORY_ROWS) -> DataFrame:
    """The category dimension, as a local relation: Spark knows its size and broadcasts it.

    Joining it any other way would shuffle every label by its category.
    """
    table = pa.Table.from_pylist(
        [dict(zip(CATEGORY_MAPPING.names, r)) for r in rows],
        schema=pa.schema([(c, pa.string()) for c in CATEGORY_MAPPING.names]),
    )
    return spark.createDataFrame(table, CATEGORY_MAPPING)


def detected_boxes(
    detections: DataFrame, threshold: float = 0.25, fmt: str = "format"
) -> DataFrame:
    """Detector output in any of three box formats, brought to corners.

    ``fmt`` names the column holding ``corners`` (a..d are x1, y1, x2, y2),
    ``xywh`` (x, y, width, height) or ``normalised`` (corners as shares of
    img_width and img_height). Kept: score (else confidence, else 0) at or
    above ``threshold``, with a label and a full box.
    """
    f = F.col(fmt)
    a, b, c, d, w, h = (F.col(x) for x in ("a", "b", "c", "d", "img_width", "img_height"))
    confidence = F.coalesce("score", "confidence", F.lit(0.0))
    out = {
        "x1": F.when(f == "normalised", a * w).otherwise(a),
        "y1": F.when(f == "normalised", b * h).otherwise(b),
        "x2": F.when(f == "normalised", c * w).when(f == "xywh", a + c).otherwise(c),
        "y2": F.when(f == "normalised", d * h).when(f == "xywh", b + d).otherwise(d),
    }
    has_box = a.isNotNull() & b.isNotNull() & c.isNotNull() & d.isNotNull()
    return (
        detections.where((confidence >= threshold) & has_box & (F.col("category") != ""))
        .withColumns({"confidence_used": confidence, **out})
        .drop("a", "b", "c", "d", "score", "confidence", "img_width", "img_height", fmt)
    )


def image_files(files: DataFrame, name: str = "filename") -> DataFrame:
    return files.where(is_image_name(F.col(name)))


def keys_of(df: DataFrame, key: str) -> DataFrame:
    """The distinct keys of ``df``, for the right side of a semi or anti join.

    Copies of a key fall away, and the keys are settled: adaptive execution
    splits a hot key of the other side only when this side comes straight from
    a scan, and a short list is broadcast.
    """
    return settle(df.select(key).distinct())


def with_presence(
    names: DataFrame, present: DataFrame, key: str = "name", flag: str = "is_present"
) -> DataFrame:
    """``names`` with a flag telling whether ``present`` holds the key; one join for both answers."""
    have = keys_of(present, key).withColumn("_have", F.lit(True))
    return names.join(have, key, "left").withColumn(flag, F.col("_have").isNotNull()).drop("_have")


def not_done(work: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Work items whose output does not exist yet; all of them when forced."""
    return work if force else work.join(keys_of(done, key), key, "left_anti")


def with_label_file(images: DataFrame, label_files: DataFrame) -> DataFrame:
    """Images whose ``<stem>_label.json`` exists, by file name."""
    wanted = F.concat(file_stem(F.col("filename")), F.lit("_label.json"))
    return (
        images.withColumn("label_file", wanted)
        .join(keys_of(label_files, "label_file"), "label_file", "left_semi")
        .orderBy("filename")
    )


def head_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
