"""Statistics and silver by date, after dates came, were replaced or went."""

import json
import os

import pytest
from pyspark.sql import functions as F

from vialens.operators import gold
from vialens.operators.transform import category_mapping
from vialens.plans import medallion

SCENE = "weather string, timeofday string, scene string"


@pytest.fixture(scope="module")
def mapping(spark):
    return category_mapping(spark, [("car", "vehicle", None), ("truck", "vehicle", None), ("person", "pedestrian", None)])


def silver(spark, n, days):
    images = [(i, "rain" if i % 3 else "clear", "day", None if i % 5 == 0 else "street", days[i % len(days)]) for i in range(n)]
    labels = [(f"{i}-{j}", i, "car truck person tree".split()[(i + j) % 4], days[i % len(days)]) for i in range(n) for j in range(i % 7)]
    return (
        spark.createDataFrame(images, f"image_id long, {SCENE}, ingestion_date string").withColumn("ingestion_date", F.col("ingestion_date").cast("date")),
        spark.createDataFrame(labels, "label_id string, image_id long, category string, ingestion_date string").withColumn("ingestion_date", F.col("ingestion_date").cast("date")),
    )


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_states_add_and_subtract(spark, mapping):
    days = ["2026-01-01", "2026-01-02", "2026-01-03"]
    images, labels = silver(spark, 90, days)
    by_day = gold.count_state(labels, images, mapping, "ingestion_date").cache()
    whole = rows(gold.attribute_distribution(labels, images, mapping))
    assert rows(gold.distribution_of(gold.merged_states(by_day))) == whole
    gone = F.col("ingestion_date") == "2026-01-02"
    less = gold.merged_states(by_day, by_day.where(gone))
    want = gold.attribute_distribution(labels.where(~gone), images.where(~gone), mapping)
    assert rows(gold.distribution_of(less)) == rows(want)
    assert rows(gold.merged_states(by_day, by_day)) == []


def test_only_the_named_days_are_read_and_rewritten(spark, mapping, tmp_path):
    days = ["2026-01-01", "2026-01-02", "2026-01-03"]
    images, labels = silver(spark, 90, days)
    for name, df in (("images", images), ("labels", labels)):
        df.write.partitionBy("ingestion_date").parquet(str(tmp_path / name))
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    path = str(tmp_path / "state")
    medallion.update_states(read("labels"), read("images"), mapping, path, days)
    assert rows(gold.distribution_of(gold.merged_states(spark.read.parquet(path)))) == rows(gold.attribute_distribution(labels, images, mapping))
    files = lambda day: sorted(os.listdir(f"{path}/ingestion_date={day}"))
    before = {d: files(d) for d in days}
    # a broken file of another day shows that it is not opened
    for name in ("images", "labels"):
        for f in os.listdir(tmp_path / name / "ingestion_date=2026-01-01"):
            if f.endswith(".parquet"):
                (tmp_path / name / "ingestion_date=2026-01-01" / f).write_bytes(b"broken")
                crc = tmp_path / name / "ingestion_date=2026-01-01" / f".{f}.crc"
                crc.unlink(missing_ok=True)
    schema_images, schema_labels = images.schema, labels.schema
    some = (spark.read.schema(s).parquet(str(tmp_path / n)) for n, s in (("labels", schema_labels), ("images", schema_images)))
    medallion.update_states(*some, mapping, path, ["2026-01-03"])
    after = {d: files(d) for d in days}
    assert [d for d in days if before[d] != after[d]] == ["2026-01-03"]
    assert rows(gold.distribution_of(gold.merged_states(spark.read.parquet(path)))) == rows(gold.attribute_distribution(labels, images, mapping))


def document(i, weather="rain", n=2):
    box = {"x1": 1, "y1": 2, "x2": 3, "y2": 4}
    label = {"id": "7", "category": "car", "box2d": box, "attributes": {}}
    attributes = {"weather": weather, "timeofday": "day", "scene": "street"}
    return {"name": f"n{i}", "video_name": f"v{i}", "frame_index": i, "attributes": attributes, "labels": [label] * n}


def write(folder, documents):
    folder.mkdir(parents=True, exist_ok=True)
    for f in folder.iterdir():
        f.unlink()
    for name, body in documents.items():
        (folder / f"{name}.json").write_text(body if isinstance(body, str) else json.dumps(body))


def test_days_replace_themselves(spark, tmp_path):
    """A day run again without some files, or without any, leaves nothing of them; other days stay."""
    source, root = tmp_path / "in", str(tmp_path / "lake")
    state = lambda lake: sorted((r.weather, r.total_count, r.total_images) for r in lake.read(spark, "srv_attribute_analysis").collect())
    images = lambda lake: sorted((str(r.ingestion_date), r.image_id) for r in lake.read(spark, "images_by_day").collect())
    write(source, {"a": document(1), "b": document(2, "clear"), "broken": "{"})
    lake = medallion.run_day(spark, str(source), root, "2026-01-01")
    write(source, {"c": document(3, "clear", 5)})
    medallion.run_day(spark, str(source), root, "2026-01-02")
    assert state(lake) == [("clear", 7, 2), ("rain", 2, 1)]
    folder = f"{root}/images_by_day/ingestion_date=2026-01-02"
    before = sorted(os.listdir(folder))
    write(source, {"a": document(1, n=4)})
    medallion.run_day(spark, str(source), root, "2026-01-01")
    assert state(lake) == [("clear", 5, 1), ("rain", 4, 1)]
    assert images(lake) == [("2026-01-01", "v1-1"), ("2026-01-02", "v3-3")]
    assert sorted(os.listdir(folder)) == before
    write(source, {"broken": "{"})
    medallion.run_day(spark, str(source), root, "2026-01-01")
    assert images(lake) == [("2026-01-02", "v3-3")]
    assert state(lake) == [("clear", 5, 1)]
    # a late day
    write(source, {"z": document(9, "fog")})
    medallion.run_day(spark, str(source), root, "2025-12-31")
    assert state(lake) == [("clear", 5, 1), ("fog", 2, 1)]
