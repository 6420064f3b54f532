import pytest
from pyspark.sql import functions as F

from vialens.functions.levels import one_decimal
from vialens.functions.text import language_instruction
from vialens.operators import scoring, transform

GOLD = (
    "weather string, timeofday string, scene string, mapped_category string, avg_count double, "
    "q1_count long, median_count long, q3_count long, min_count long, max_count long"
)


@pytest.fixture(scope="module")
def world(spark):
    def base(weather, time, scene, category):
        return (weather, time, scene, category, 16.25, 3, 5, 8, 1, 20)

    scenes = {
        # image: (scene, vehicles, pedestrians, reminder starts with)
        "rain": (("rainy", "daytime", "highway"), 30, 0, "Rainy conditions"),
        "heavy": (("clear", "night", "highway"), 9, 9, "Heavy traffic detected (9 vs avg 16.2)"),
        "light": (("clear", "night", "highway"), 2, 9, "Light highway traffic (2 vs avg 16.2)"),
        "quiet street": (("clear", "night", "street"), 2, 0, "Night driving"),
        "people": (("clear", "night", "street"), 2, 9, "High pedestrian"),
        "dusk": (("clear", "dawn/dusk", "street"), 5, 5, "Low light"),
        "normal": (("clear", "daytime", "street"), 5, 5, "Normal driving"),
        "no baseline": (("clear", "daytime", "moon"), 50, 50, "Normal driving"),
        "no labels": (("clear", "night", "street"), 0, 0, "Night driving"),
        "null scene": ((None, "night", None), 9, 0, "Night driving"),
    }
    images = [(k, *v[0]) for k, v in scenes.items()]
    labels = [
        (k, c) for k, v in scenes.items() for c, n in (("car", v[1]), ("rider", v[2]))
        for _ in range(n)
    ]
    gold = {
        base(*v[0], c) for k, v in scenes.items() if "moon" not in v[0] and None not in v[0]
        for c in ("vehicle", "pedestrian")
    }
    return (
        scenes,
        spark.createDataFrame(images, "image_id string, weather string, timeofday string, scene string"),
        spark.createDataFrame(labels, "image_id string, category string"),
        spark.createDataFrame(sorted(gold), GOLD),
    )


def test_reminder_cascade(spark, world):
    scenes, images, labels, gold = world
    counts = scoring.scene_counts(labels, transform.category_mapping(spark))
    got = {r.image_id: r.safety_reminder for r in
           scoring.scene_reminders(images, counts, gold).collect()}
    assert set(got) == set(scenes)
    for name, (*_, starts) in scenes.items():
        assert got[name].startswith(starts), name


def test_levels_and_bands(spark, world):
    _, images, labels, gold = world
    counts = scoring.scene_counts(labels, transform.category_mapping(spark))
    rows = {
        (r.image_id, r.mapped_category): r
        for r in scoring.scene_comparison(images, counts, gold).collect()
    }
    r = rows[("heavy", "vehicle")]
    assert (r.level, r.level_description) == ("above_normal", "above normal (Q3: 8)")
    assert r.percentile_position == "top 25%"
    assert (r.quartile_range, r.full_range) == ("Q1: 3, Q3: 8", "Min: 1, Max: 20")
    r = rows[("light", "vehicle")]
    assert (r.level_description, r.percentile_position) == ("below normal (Q1: 3)", "bottom 25%")
    assert rows[("dusk", "vehicle")].percentile_position == "25th-50th percentile"
    assert not any(k[0] in ("no baseline", "null scene") for k in rows)


def test_unmapped_categories_keep_their_names(spark):
    labels = spark.createDataFrame(
        [("i", "Car"), ("i", "car"), ("i", None), ("i", "bus")], "image_id string, category string"
    )
    got = {r.mapped_category: r.current_count for r in
           scoring.scene_counts(labels, transform.category_mapping(spark)).collect()}
    assert got == {"Car": 1, "vehicle": 2, "": 1}
    shown = {r.category: r.shown_as for r in scoring.category_counts(labels).collect()}
    assert shown["bus"] == "Bus" and shown["unknown"] == "Unknown"


def test_prompt(spark, world):
    _, images, labels, gold = world
    counts = scoring.scene_counts(labels, transform.category_mapping(spark))
    rows = {r.image_id: r for r in
            scoring.prompt_contexts(images, counts, gold, "Japanese").collect()}
    assert rows["heavy"].context == (
        "pedestrian: 9 detected (historical avg: 16.2, level: above normal (Q3: 8), "
        "percentile: top 25%)\n"
        "vehicle: 9 detected (historical avg: 16.2, level: above normal (Q3: 8), "
        "percentile: top 25%)"
    )
    assert rows["no labels"].context == ""
    assert "- Response in Japanese\n" in rows["heavy"].prompt
    assert "- Weather: clear\n- Time: night\n- Scene: highway\n" in rows["heavy"].prompt


def test_one_decimal_rounds_the_binary_value(spark):
    values = [16.25, 16.75, 1.15, 0.05, 2.0, 1234.56, 0.25, 0.35, 7.449999]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(one_decimal(F.col("x"))).collect()] == [
        f"{v:.1f}" for v in values
    ]


def test_language_default(spark):
    df = spark.createDataFrame([("Korean",), ("Klingon",), (None,)], "l string")
    got = [r[0] for r in df.select(language_instruction(F.col("l"))).collect()]
    assert got == ["Response in Korean", "Response in English", "Response in English"]
