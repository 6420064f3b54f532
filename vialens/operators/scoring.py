"""Scenes compared with the statistics table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialens.functions.levels import level, level_text, one_decimal, percentile_band
from vialens.functions.text import first_filled, language_instruction
from vialens.operators.transform import image_key
from vialens.schemas import SCENE_ATTRIBUTES

SCENE = list(SCENE_ATTRIBUTES)

# Reminder texts, in order of precedence.
WEATHER_REMINDERS = {
    "rainy": "Rainy conditions - reduce speed, increase following distance, and use caution",
    "snowy": "Snow on roadway - drive slowly and carefully, allow extra stopping distance",
    "foggy": "Foggy conditions - use fog lights, reduce speed, and stay alert",
}
HEAVY_TRAFFIC = (
    "Heavy traffic detected (%d vs avg %s) - maintain safe following distance and stay patient"
)
LIGHT_HIGHWAY = (
    "Light highway traffic (%d vs avg %s) - maintain appropriate speeds and stay focused"
)
MANY_PEDESTRIANS = (
    "High pedestrian activity detected - reduce speed and watch for foot traffic"
)
TIME_REMINDERS = {
    "night": "Night driving - use headlights and exercise extra caution",
    "dawn/dusk": "Low light conditions - turn on headlights and drive carefully",
}
DEFAULT_REMINDER = (
    "Normal driving conditions based on historical data - maintain safe speeds and stay alert"
)
PROMPT_HEAD = "Generate a precise traffic safety reminder (25-40 words) based on this analysis:"
PROMPT_RULES = (
    '- Use the statistical comparison to assess risk level\n'
    '- If any category is "above_normal" or "below_normal", mention it specifically\n'
    "- Prioritize weather conditions if hazardous\n"
    "- Provide actionable driving advice\n"
    "- Keep response short, concise and professional (10-20 words)\n"
)
PROMPT_TAIL = "- Don't include statistics result in the message\n\nRespond with safety reminder only."


def category_counts(labels: DataFrame) -> DataFrame:
    """Objects per image and raw category, with the display name."""
    return (
        labels.groupBy("image_id", F.coalesce("category", F.lit("unknown")).alias("category"))
        .agg(F.count(F.lit(1)).alias("n_objects"))
        .withColumn("shown_as", F.initcap("category"))
    )


def scene_attributes(documents: DataFrame) -> DataFrame:
    """image_id and scene of label documents; an empty metadata value falls through."""
    return documents.select(
        image_key(F.col("video_name"), F.col("frame_index")).alias("image_id"),
        *[first_filled(F.col(f"metadata.{a}"), F.col(f"attributes.{a}")).alias(a) for a in SCENE],
    )


def scene_counts(labels: DataFrame, mapping: DataFrame) -> DataFrame:
    """Objects per image and category; an unmapped category keeps its own name."""
    raw = F.col("category")
    return (
        labels.select("image_id", "category")
        .join(
            mapping.select(F.col("original_category").alias("category"), "mapped_category"),
            "category",
            "left",
        )
        .groupBy(
            "image_id", F.coalesce("mapped_category", raw, F.lit("")).alias("mapped_category")
        )
        .agg(F.count(F.lit(1)).alias("current_count"))
    )


def _against_gold(scenes: DataFrame, gold: DataFrame, how: str) -> DataFrame:
    """``scenes`` (scene keys, mapped_category, current_count) beside their baseline.

    The statistics table has one row per (scene, category) key, so it is small;
    whether it is broadcast is left to Spark, which knows its size.
    """
    n = F.col("current_count")
    q1, q2, q3 = F.col("q1_count"), F.col("median_count"), F.col("q3_count")
    known = q1.isNotNull()
    return (
        scenes.join(gold, [*SCENE, "mapped_category"], how)
        .withColumns(
            {
                "level": F.when(known, level(n, q1, q3)),
                "level_description": F.when(known, level_text(n, q1, q3)),
                "percentile_position": F.when(known, percentile_band(n, q1, q2, q3)),
                "quartile_range": F.format_string("Q1: %d, Q3: %d", q1, q3),
                "full_range": F.format_string(
                    "Min: %d, Max: %d", F.col("min_count"), F.col("max_count")
                ),
            }
        )
        .withColumnRenamed("avg_count", "historical_avg")
    )


def scene_comparison(images: DataFrame, counts: DataFrame, gold: DataFrame) -> DataFrame:
    """One row per image and category that has a baseline."""
    scenes = counts.join(images.select("image_id", *SCENE), "image_id")
    return _against_gold(scenes, gold, "inner").select(
        "image_id",
        *SCENE,
        "mapped_category",
        "current_count",
        "historical_avg",
        "level",
        "level_description",
        "quartile_range",
        "full_range",
        "percentile_position",
    )


def _of(category: str, value: Column) -> Column:
    return F.max(F.when(F.col("mapped_category") == category, value))


def _side() -> Column:
    """The level as a number; text would make the grouping sort its rows."""
    return F.when(F.col("level") == "above_normal", 1).when(
        F.col("level") == "below_normal", -1
    ).when(F.col("level") == "normal", 0)


def _per_scene(images: DataFrame, counts: DataFrame, gold: DataFrame) -> DataFrame:
    scenes = images.select("image_id", *SCENE).join(counts, "image_id", "left")
    return _against_gold(scenes, gold, "left")


def scene_reminders(images: DataFrame, counts: DataFrame, gold: DataFrame) -> DataFrame:
    """One reminder per image: weather, then traffic, pedestrians, time of day, default.

    Images without labels or without a baseline still get theirs. The join and
    the grouping share the image_id partitioning.
    """
    per_image = _per_scene(images, counts, gold).groupBy("image_id", *SCENE).agg(
        _of("vehicle", _side()).alias("_vl"),
        _of("vehicle", F.col("current_count")).alias("_vn"),
        _of("vehicle", F.col("historical_avg")).alias("_va"),
        _of("pedestrian", _side()).alias("_pl"),
    )
    weather, time, scene = (F.col(c) for c in SCENE)
    vl, vn, va = F.col("_vl"), F.col("_vn"), one_decimal(F.col("_va"))
    reminder = F
    for value, text in WEATHER_REMINDERS.items():
        reminder = reminder.when(weather == value, text)
    reminder = (
        reminder.when(vl > 0, F.format_string(HEAVY_TRAFFIC, vn, va))
        .when(
            (vl < 0) & (scene == "highway"),
            F.format_string(LIGHT_HIGHWAY, vn, va),
        )
        .when(F.col("_pl") > 0, MANY_PEDESTRIANS)
    )
    for value, text in TIME_REMINDERS.items():
        reminder = reminder.when(time == value, text)
    return per_image.select(
        "image_id", *SCENE, reminder.otherwise(DEFAULT_REMINDER).alias("safety_reminder")
    )


def prompt_contexts(
    images: DataFrame, counts: DataFrame, gold: DataFrame, language: str = "English"
) -> DataFrame:
    """The statistical lines of each image, by category, and the full prompt around them.

    An image has at most one line per category of the statistics table.
    """
    line = F.format_string(
        "%s: %d detected (historical avg: %s, level: %s, percentile: %s)",
        F.col("mapped_category"),
        F.col("current_count"),
        one_decimal(F.col("historical_avg")),
        F.col("level_description"),
        F.col("percentile_position"),
    )
    lines = F.collect_list(
        F.when(F.col("level").isNotNull(), F.struct(F.col("mapped_category"), line.alias("line")))
    )
    joined = F.array_join(F.transform(F.array_sort(lines), lambda x: x["line"]), "\n")
    weather, time, scene = (F.coalesce(F.col(c), F.lit("None")) for c in SCENE)
    prompt = F.concat(
        F.lit(f"\n{PROMPT_HEAD}\n\nENVIRONMENT:\n- Weather: "),
        weather,
        F.lit("\n- Time: "),
        time,
        F.lit("\n- Scene: "),
        scene,
        F.lit("\n\nSTATISTICAL ANALYSIS:\n"),
        F.col("context"),
        F.lit(f"\n\nINSTRUCTIONS:\n{PROMPT_RULES}- "),
        language_instruction(F.lit(language)),
        F.lit(f"\n{PROMPT_TAIL}\n"),
    )
    return (
        _per_scene(images, counts, gold)
        .groupBy("image_id", *SCENE)
        .agg(joined.alias("context"))
        .withColumn("prompt", prompt)
    )
