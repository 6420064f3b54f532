"""One key holds a third of all rows: results stay whole and the work is split."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from vialens.operators import gold, scoring, transform
from vialens.operators.scale import settle


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def small_skew_limits(spark):
    """Cluster-sized limits scaled down to test data: only the category mapping is broadcast."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="2KB",
        spark__sql__shuffle__partitions="8",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        yield


@pytest.fixture(scope="module")
def hot(spark):
    n = 60_000
    ids = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("i"), (F.col("id") % 5000).cast("string"))
    )
    labels = spark.range(n, numPartitions=8).select(
        F.concat(F.lit("label"), F.sha2(F.col("id").cast("string"), 256)).alias("label_id"),
        ids.alias("image_id"),
        F.when(F.col("id") % 2 == 0, "car").otherwise("bus").alias("category"),
    )
    images = labels.select("image_id").distinct().select(
        "image_id",
        F.lit("clear").alias("weather"),
        F.lit("night").alias("timeofday"),
        F.lit("city").alias("scene"),
    )
    return settle(labels), settle(images), n


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_wise_join_splits_the_hot_image(spark, hot, small_skew_limits):
    labels, images, n = hot
    context = gold.object_context(labels, images, transform.category_mapping(spark))
    assert len(context.select("label_id", "scene").collect()) == n
    joined = labels.join(images, "image_id")
    joined.collect()
    assert "skew=true" in final_plan(joined)
    context.collect()
    assert "skew=true" in final_plan(context)


def test_statistics_shuffle_one_row_per_image_and_task(spark, hot, small_skew_limits):
    labels, images, n = hot
    mapping = transform.category_mapping(spark)
    per_image = gold.objects_per_image(labels, images, mapping)
    rows = per_image.collect()
    assert sum(r.objects_per_image for r in rows) == n
    assert max(r.objects_per_image for r in rows) == n // 3
    assert "skew=true" not in final_plan(per_image)  # nothing left to split
    stats = gold.attribute_distribution(labels, images, mapping).head()
    assert (stats.total_count, stats.max_count) == (n, n // 3)


def test_semi_and_anti_joins_with_a_hot_right_side(spark, hot, small_skew_limits):
    labels, images, _ = hot
    todo = transform.not_done(images, labels, "image_id")
    assert todo.count() == 0
    flags = transform.with_presence(labels, images, "image_id")
    assert sum(r.is_present for r in flags.collect()) == labels.count()
    flags.collect()
    assert "skew=true" in final_plan(flags)


def test_frames_of_a_hot_video(spark, small_skew_limits):
    frames = settle(
        spark.range(9000).select(
            F.when(F.col("id") % 3 == 0, F.concat(F.lit("hot-"), "id"))
            .otherwise(F.concat(F.lit("v"), (F.col("id") % 900).cast("string"), F.lit("-"), "id"))
            .alias("name"),
            F.lit(None).cast("struct<weather:string>").alias("attributes"),
            F.sha2(F.col("id").cast("string"), 256).alias("labels"),
        )
    )
    members = settle(gold.video_members(frames, page_size=1000))
    documents = gold.per_image_documents(frames.select("name"), frames, members)
    rows = documents.collect()
    assert len(rows) == 9000
    assert {r.video_frame_count for r in rows if r.video_name == "hot"} == {3000}
    assert {r.video_frame_count for r in rows if r.video_name != "hot"} == {10}
    whole = members.where("video_name = 'hot'").selectExpr("sum(size(members)) AS n").head().n
    assert whole == 3000


def test_scores_with_a_hot_image(spark, hot, small_skew_limits):
    labels, images, n = hot
    mapping = transform.category_mapping(spark)
    counts = scoring.scene_counts(labels, mapping)
    stats = gold.attribute_distribution(labels, images, mapping)
    reminders = {
        r.image_id: r.safety_reminder
        for r in scoring.scene_reminders(images, counts, stats).collect()
    }
    assert len(reminders) == images.count()
    assert reminders["hot"].startswith(f"Heavy traffic detected ({n // 3} vs avg")
