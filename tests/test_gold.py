import random
import statistics

import pytest

from vialens.operators import gold, quality, scale, transform

SCENE = "weather string, timeofday string, scene string"


@pytest.fixture(scope="module")
def silver(spark):
    rng = random.Random(2)
    cats = ["car", "bus", "rider", "traffic sign", "Car", "dog", None]
    images = [
        (f"i{k}", rng.choice("ab"), rng.choice("de"), None if k % 17 == 0 else "s")
        for k in range(120)
    ]
    images += images[:10]  # listed twice: their labels count twice
    labels = [
        (str(n), rng.choice(["i0"] * 60 + [f"i{k}" for k in range(130)]), rng.choice(cats))
        for n in range(3000)
    ] + [("x", None, "car")]
    return (
        spark.createDataFrame(labels, "label_id string, image_id string, category string"),
        spark.createDataFrame(images, "image_id string, " + SCENE),
        transform.category_mapping(spark),
    )


def test_counts_before_the_join_equal_counts_after(spark, silver):
    labels, images, mapping = silver
    context = gold.object_context(labels, images, mapping)
    want = (
        context.where("mapped_category is not null")
        .groupBy("weather", "timeofday", "scene", "mapped_category", "image_id")
        .count()
        .withColumnRenamed("count", "objects_per_image")
    )
    got = gold.objects_per_image(labels, images, mapping).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_statistics(spark, silver):
    per_image = {}
    for r in gold.objects_per_image(*silver).collect():
        key = (r.weather, r.timeofday, r.scene, r.mapped_category)
        per_image.setdefault(key, []).append(r.objects_per_image)
    rows = gold.attribute_distribution(*silver).collect()
    assert len(rows) == len(per_image)
    for r in rows:
        n = sorted(per_image[tuple(r[:4])])
        assert (r.total_count, r.total_images) == (sum(n), len(n))
        assert r.avg_count == pytest.approx(sum(n) / len(n), abs=0.00501)
        if len(n) == 1:
            assert r.std_dev is None
        else:
            assert r.std_dev == pytest.approx(statistics.stdev(n), abs=0.00501)
        at = [n[max(0, -(-len(n) * k // 4) - 1)] for k in (1, 2, 3)]
        assert [r.q1_count, r.median_count, r.q3_count] == at
        assert r.min_count <= r.q1_count <= r.median_count <= r.q3_count <= r.max_count
    assert [tuple(r[:4]) for r in rows] == sorted(
        (tuple(r[:4]) for r in rows), key=lambda k: tuple((v is not None, v) for v in k)
    )


def test_quartiles_equal_percentile_approx(spark, silver):
    gold.objects_per_image(*silver).createOrReplaceTempView("per_image_counts")
    want = spark.sql(
        """SELECT weather, timeofday, scene, mapped_category,
            percentile_approx(objects_per_image, 0.25) AS a,
            percentile_approx(objects_per_image, 0.5) AS b,
            percentile_approx(objects_per_image, 0.75) AS c
        FROM per_image_counts GROUP BY ALL"""
    ).collect()
    got = gold.attribute_distribution(*silver).collect()
    assert sorted(map(str, (tuple(r) for r in want))) == sorted(
        str((*r[:4], r.q1_count, r.median_count, r.q3_count)) for r in got
    )


def test_rounds_to_two_digits_half_up(spark):
    labels = spark.createDataFrame(
        [("l", f"i{k}", "car") for k in range(8)] + [("l", "i0", "car")],
        "label_id string, image_id string, category string",
    )
    images = spark.createDataFrame([(f"i{k}", "w", "t", "s") for k in range(8)], "image_id string, " + SCENE)
    row = gold.attribute_distribution(labels, images, transform.category_mapping(spark)).head()
    assert row.avg_count == 1.13  # 9 objects in 8 images: 1.125


def test_mapping_needs_no_shuffle(spark, silver):
    labels, images, mapping = silver
    joined = labels.join(
        mapping.withColumnRenamed("original_category", "category"), "category", "left"
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_numbering_over_slices(spark):
    """One group holds most rows; its numbers are still 0..n-1 in order."""
    rows = [("hot", f"{i:06d}") for i in range(3000)] + [("a", "1"), ("a", "0"), (None, "x")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v string").repartition(7)
    got = scale.number_rows(df, ["v"], ["k"], "no").collect()
    for key in ("hot", "a", None):
        mine = sorted((r.v, r.no) for r in got if r.k == key)
        assert [no for _, no in mine] == list(range(len(mine)))
    everything = scale.number_rows(df, ["v", "k"], name="no").collect()
    assert [r.no for r in sorted(everything, key=lambda r: (r.v, r.k or ""))] == list(range(3003))


def test_pages_hold_the_whole_group(spark):
    frames = spark.createDataFrame(
        [(f"v-{i:05d}.jpg",) for i in range(2500)] + [("v-00001.jpg",), ("solo.jpg",)], "name string"
    )
    pages = gold.video_members(frames, page_size=1000).collect()
    hot = sorted((p for p in pages if p.video_name == "v"), key=lambda p: p.page)
    assert [len(p.members) for p in hot] == [1000, 1000, 501]
    listed = [f"v-{i:05d}.jpg" for i in range(2500)] + ["v-00001.jpg"]
    assert [m for p in hot for m in p.members] == sorted(listed)
    assert [p.n_members for p in hot] == [1000, 1000, 501]
    assert [p.members for p in pages if p.video_name == "solo"] == [["solo.jpg"]]


def test_image_documents(spark):
    frames = spark.createDataFrame(
        [(f"v-{i}.jpg", {"weather": "w"}, [i]) for i in range(4)] + [("u-1.jpg", None, None)],
        "name string, attributes struct<weather:string>, labels array<int>",
    )
    images = spark.createDataFrame([("v-1.jpg",), ("u-1.jpg",), ("n-1.jpg",)], "name string")
    members = gold.video_members(frames, page_size=3)
    got = {r.name: r for r in gold.per_image_documents(images, frames, members).collect()}
    assert {n: r.video_frame_count for n, r in got.items()} == {"v-1.jpg": 4, "u-1.jpg": 1, "n-1.jpg": 0}
    assert got["v-1.jpg"].video_name == "v" and got["v-1.jpg"].labels == [1]
    assert got["n-1.jpg"].labels is None


def test_quality_profile_counts_nulls(spark, silver):
    labels, images, _ = silver
    got = {(r.table_name, r.check): r.n for r in quality.quality_profile(images, labels).collect()}
    assert got[("images", "n_images")] == 130
    assert got[("labels", "distinct_category")] == 6
    summary = {r.table_name: r.n_rows for r in
               quality.transformation_summary(images, labels).collect()}
    assert summary == {"images": 130, "labels": 3001}


def test_scene_metrics_stamp_and_version(spark):
    scenes = spark.createDataFrame(
        [("w", "t", "s", 4, 3, 1, 0), ("w", "t", "s", 2, 1, 0, 1)],
        SCENE + ", object_count int, car_count int, truck_count int, person_count int",
    )
    rollup = gold.scene_rollup(scenes).head()
    assert (rollup.image_count, rollup.avg_objects, rollup.total_cars) == (2, 3.0, 4)
    assert rollup.processing_date is not None
    metrics = gold.business_metrics(scenes).head()
    assert (metrics.dataset_version, metrics.unique_scene_types) == ("1.0", 1)
    assert metrics.analysis_date is not None
    assert gold.value_distribution(scenes, "weather").head()["count"] == 2
    assert gold.global_averages(scenes).head().avg_trucks == 0.5
