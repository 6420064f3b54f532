"""Statistics tables over the silver tables."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialens.functions.text import video_of
from vialens.operators.scale import member_pages, settle
from vialens.schemas import SCENE_ATTRIBUTES

SCENE = list(SCENE_ATTRIBUTES)


def object_context(labels: DataFrame, images: DataFrame, mapping: DataFrame) -> DataFrame:
    """Every label with its scene and mapped category (NULL when unmapped)."""
    return (
        labels.select("label_id", "image_id", F.col("category").alias("original_category"))
        .join(images.select("image_id", *SCENE), "image_id")
        .join(mapping.select("original_category", "mapped_category"), "original_category", "left")
        .select("original_category", "mapped_category", *SCENE, "image_id", "label_id")
    )


def objects_per_image(
    labels: DataFrame, images: DataFrame, mapping: DataFrame, *by: str
) -> DataFrame:
    """Mapped objects per scene, category and image (and ``by``, columns of both tables).

    Equal to counting ``object_context`` rows, but each side is counted before
    the join: what is shuffled by image_id is at most one row per image and
    category, however many labels one image holds. An image listed m times
    counts its labels m times, as the row-wise join would.
    """
    n_labels = (
        labels.select(*by, "image_id", F.col("category").alias("original_category"))
        .join(mapping.select("original_category", "mapped_category"), "original_category")
        .where(F.col("mapped_category").isNotNull() & F.col("image_id").isNotNull())
        .groupBy(*by, "image_id", "mapped_category")
        .agg(F.count(F.lit(1)).alias("_labels"))
    )
    n_images = images.groupBy(*by, "image_id", *SCENE).agg(F.count(F.lit(1)).alias("_copies"))
    return n_labels.join(n_images, [*by, "image_id"]).select(
        *by,
        *SCENE,
        "mapped_category",
        "image_id",
        (F.col("_labels") * F.col("_copies")).alias("objects_per_image"),
    )


KEYS = [*SCENE, "mapped_category"]


def count_state(
    labels: DataFrame, images: DataFrame, mapping: DataFrame, *by: str
) -> DataFrame:
    """How often each number of objects per image occurs, by scene and mapped category.

    Small however many images a scene has, and enough for every statistic. States
    of disjoint sets of images add up, see ``merged_states``. Columns named in
    ``by`` (an ingestion date) are in both tables and kept apart: an image meets
    the labels of its own date.
    """
    counted = objects_per_image(labels, images, mapping, *by)
    return counted.groupBy(*by, *KEYS, "objects_per_image").agg(F.count(F.lit(1)).alias("times"))


def merged_states(states: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """The state of all images together, less those of ``removed``.

    Any columns besides the keys (dates) are summed over.
    """
    columns = [*KEYS, "objects_per_image", "times"]
    rows = states.select(columns)
    if removed is not None:
        rows = rows.union(removed.select(columns).withColumn("times", -F.col("times")))
    summed = rows.groupBy(*columns[:-1]).agg(F.sum("times").alias("times"))
    return summed.where(F.col("times") > 0)


def distribution_of(state: DataFrame, digits: int = 2) -> DataFrame:
    """The statistics of a merged state, exact, for each scene and mapped category."""
    n, times, total = F.col("objects_per_image"), F.col("times"), F.col("_images")
    group = Window.partitionBy(*KEYS)
    upto = group.orderBy("objects_per_image").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = state.withColumns(
        {
            "_images": F.sum("times").over(group),
            "_mean": F.sum(n * times).over(group) / F.sum("times").over(group),
            "_upto": F.sum("times").over(upto),
        }
    )
    squares = F.sum(times * F.pow(n - F.col("_mean"), 2))

    def quartile(k: int) -> Column:
        # the smallest count with at least k quarters of the images at or below it
        return F.min(F.when(4 * F.col("_upto") >= k * total, n))

    images_n = F.sum("times")
    return (
        placed.groupBy(*KEYS)
        .agg(
            F.sum(n * times).alias("total_count"),
            images_n.alias("total_images"),
            F.round(F.sum(n * times) / images_n, digits).alias("avg_count"),
            F.round(F.when(images_n > 1, F.sqrt(squares / (images_n - 1))), digits).alias(
                "std_dev"
            ),
            quartile(1).alias("q1_count"),
            quartile(2).alias("median_count"),
            quartile(3).alias("q3_count"),
            F.min(n).alias("min_count"),
            F.max(n).alias("max_count"),
        )
        .orderBy(*KEYS)
    )


def attribute_distribution(
    labels: DataFrame, images: DataFrame, mapping: DataFrame, digits: int = 2
) -> DataFrame:
    """Statistics of objects per image for each scene and mapped category.

    Images without an object of a category do not enter that category's rows.
    The statistics come from how often each count occurs: that table is small
    however many images a scene has, and gives the quartiles exactly.
    """
    return distribution_of(count_state(labels, images, mapping), digits)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; equal counts by value."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc(column))
    )


def global_averages(scenes: DataFrame) -> DataFrame:
    return scenes.agg(
        F.avg("object_count").alias("avg_objects"),
        F.avg("car_count").alias("avg_cars"),
        F.avg("truck_count").alias("avg_trucks"),
        F.avg("person_count").alias("avg_persons"),
    )


def scene_rollup(scenes: DataFrame, at_time: Column | None = None) -> DataFrame:
    return (
        scenes.groupBy(*SCENE)
        .agg(
            F.count(F.lit(1)).alias("image_count"),
            F.avg("object_count").alias("avg_objects"),
            F.sum("car_count").alias("total_cars"),
            F.sum("truck_count").alias("total_trucks"),
            F.sum("person_count").alias("total_persons"),
        )
        .withColumn("processing_date", F.current_timestamp() if at_time is None else at_time)
    )


def business_metrics(
    scenes: DataFrame, version: str = "1.0", at_time: Column | None = None
) -> DataFrame:
    return scenes.agg(
        F.count(F.lit(1)).alias("total_images"),
        F.avg("object_count").alias("avg_objects_per_image"),
        F.sum("car_count").alias("total_cars_detected"),
        F.sum("truck_count").alias("total_trucks_detected"),
        F.sum("person_count").alias("total_persons_detected"),
        F.count_distinct("weather").alias("unique_weather_conditions"),
        F.count_distinct("scene").alias("unique_scene_types"),
    ).select(
        "*",
        (F.current_timestamp() if at_time is None else at_time).alias("analysis_date"),
        F.lit(version).alias("dataset_version"),
    )


def video_members(frames: DataFrame, page_size: int = 1000) -> DataFrame:
    """Image names of each video, in pages."""
    named = frames.select(video_of(F.col("name")).alias("video_name"), "name")
    return member_pages(named, ["video_name"], "name", page_size)


def scene_members(frames: DataFrame, page_size: int = 1000) -> DataFrame:
    """Image names of each (weather, scene, timeofday), in pages; missing reads ``unknown``."""
    scene = [F.coalesce(F.col(f"attributes.{a}"), F.lit("unknown")).alias(a) for a in SCENE]
    return member_pages(frames.select(*scene, "name"), SCENE, "name", page_size)


def per_image_documents(
    images: DataFrame, frames: DataFrame, members: DataFrame
) -> DataFrame:
    """Each image with its label document, its video and how many frames that has.

    An image without a document keeps NULL attributes and labels. The frame
    list itself is ``members`` (from video_members), by ``video_name``, for every
    video: embedded, it would be repeated for each of the video's images. The
    counts are settled so that the images of one huge video can be split over
    tasks in the join.
    """
    counts = settle(
        members.groupBy("video_name").agg(F.sum("n_members").alias("video_frame_count"))
    )
    return (
        images.join(frames.select("name", "attributes", "labels"), "name", "left")
        .withColumn("video_name", video_of(F.col("name")))
        .join(counts, "video_name", "left")
        .withColumn("video_frame_count", F.coalesce("video_frame_count", F.lit(0)))
    )
