import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from vialens import schemas
from vialens.operators import documents, gold, scale, transform, validate
from vialens.plans import medallion
from vialens.sources import readers, writers


def label(category="car", **box):
    return {
        "id": "1",
        "category": category,
        "box2d": {"x1": 1.0, "y1": 2.0, "x2": 4.0, "y2": 4.0, **box},
        "attributes": {"occluded": True, "truncated": False, "trafficLightColor": "NA"},
    }


def document(n, **more):
    scene = {"weather": "clear", "timeofday": "night", "scene": "highway"}
    return {
        "video_name": f"v{n}", "frame_index": 0, "attributes": scene,
        "labels": [label(), label("rider"), label("mystery")], **more,
    }


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for n in range(4):
        (source / f"{n}.json").write_text(json.dumps(document(n), indent=2))
    (source / "list.json").write_text(json.dumps([document(8, name="n8.jpg"), document(9)]))
    (source / "cut.json").write_text('{"video_name": "v')
    (source / "short.json").write_text('{"video_name": "v"}')
    return source


def test_label_documents(spark, folder):
    docs = readers.label_documents(spark, f"{folder}/*.json").cache()
    assert docs.where("_corrupt_record is not null").count() == 1
    assert docs.where("file_name = 'list.json'").count() == 2
    images = transform.images_table(docs.where("frame_index is not null"))
    assert images.select("image_id").distinct().count() == 6
    assert {r.filename for r in images.collect()} >= {"n8.jpg", "v1-0.jpg"}


def test_silver_values(spark, folder):
    docs = readers.label_documents(spark, f"{folder}/1.json")
    row = transform.labels_table(docs, F.lit(date(2025, 1, 2))).head()
    assert (row.bbox_width, row.bbox_height, row.bbox_area) == (3.0, 2.0, 6.0)
    assert (row.is_occluded, row.is_truncated, row.traffic_light_color) == (True, False, None)
    assert row.ingestion_date == date(2025, 1, 2) and row.processing_date is not None


def test_corners_that_are_not_numbers(spark):
    df = spark.createDataFrame(
        [("v", 1, [("1", "car", ("x", "2", "3", "4"), ("yes?", "true", "G"))])],
        "video_name string, frame_index int, labels array<struct<id:string,category:string,"
        "box2d:struct<x1:string,y1:string,x2:string,y2:string>,"
        "attributes:struct<occluded:string,truncated:string,trafficLightColor:string>>>",
    )
    row = transform.labels_table(df).head()
    assert (row.bbox_x1, row.bbox_y2, row.bbox_area) == (None, 4.0, None)
    assert (row.is_occluded, row.is_truncated, row.traffic_light_color) == (None, True, "G")


def test_raw_documents(spark, folder):
    raw = readers.raw_documents(spark, f"{folder}/*.json")
    checked = {r.file_name: r for r in validate.validated(raw).collect()}
    assert checked["1.json"].is_valid and checked["list.json"].is_valid
    assert checked["cut.json"].errors == validate.MALFORMED
    assert "attributes; Missing" in checked["short.json"].errors


def test_label_lists(spark, tmp_path):
    for split in ("train", "val"):
        frames = [{"name": f"{split}-{i}.jpg", "labels": None} for i in range(2)]
        (tmp_path / f"det_{split}.json").write_text(json.dumps(frames))
    got = readers.label_lists(spark, f"{tmp_path}/det_*.json").select("name", "split").collect()
    assert sorted(map(tuple, got)) == [
        (f"{s}-{i}.jpg", s) for s in ("train", "val") for i in range(2)
    ]


def test_csv_reads(spark, tmp_path):
    (tmp_path / "scenes.csv").write_text(
        ",".join(schemas.SCENE_CSV.names) + "\na.jpg,clear,daytime,highway,7,5,1,1\n"
    )
    row = readers.scene_csv(spark, str(tmp_path / "scenes.csv")).head()
    assert (row.image_name, row.object_count, row.person_count) == ("a.jpg", 7, 1)
    (tmp_path / "gold.csv").write_text(
        ",".join(schemas.GOLD.names) + "\nclear,night,city,vehicle,3,1,3.0,null,3,3,3,3,3\n"
    )
    table = readers.gold_csv(spark, str(tmp_path / "gold.csv"))
    assert table.head().std_dev is None and table.head().q3_count == 3
    writers.write_gold_csv(table, str(tmp_path / "out"))
    again = readers.gold_csv(spark, str(tmp_path / "out"))
    assert again.collect() == table.collect()


def test_annotations_read(spark, tmp_path):
    (tmp_path / "a.jpg.json").write_text(
        json.dumps({"name": "a.jpg", "labels": [label()], "processing_status": {"x": 1}})
    )
    (tmp_path / "b.jpg.json").write_text("{")
    rows = readers.annotations(spark, f"{tmp_path}/*.json").collect()
    assert {r.file_name: r[schemas.CORRUPT] is None for r in rows} == {
        "a.jpg.json": True, "b.jpg.json": False,
    }


def test_listing_and_landing(spark, tmp_path):
    source = tmp_path / "src"
    (source / "deep").mkdir(parents=True)
    (source / "a.jpg").write_bytes(b"12345")
    (source / "deep" / "b.json").write_bytes(b"{}")
    listing = readers.file_listing(spark, str(source))
    assert sorted((r.filename, r.length) for r in listing.collect()) == [("a.jpg", 5), ("b.json", 2)]
    assert "content" not in listing.columns
    assert readers.file_listing(spark, str(source), "*.json").count() == 1
    lake = medallion.Lake(str(tmp_path / "lake"))
    report = medallion.land(spark, lake, str(source), F.lit(date(2025, 1, 2))).head()
    assert (report.total_files, report.completed, report.success_rate) == (2, 2, 100.0)
    assert (tmp_path / "lake" / "landing" / "ingestion_date=2025-01-02").is_dir()
    (source / "b.gone").write_bytes(b"1")
    listing = readers.file_listing(spark, str(source)).collect()
    (source / "b.gone").unlink()
    gone = readers.readable_contents(spark.createDataFrame(listing)).collect()
    assert {r.filename: (r.content, r.error is None) for r in gone} == {
        "a.jpg": (b"12345", True), "b.json": (b"{}", True), "b.gone": (None, False),
    }
    (source / "c.jpg").write_bytes(b"1")
    report = medallion.land(spark, lake, str(source), F.lit(date(2025, 1, 3))).head()
    assert (report.total_files, report.failed) == (3, 0)  # of this day, not of all
    assert report.files_per_second > 0
    landed = lake.read(spark, "landing").where("ingestion_date = '2025-01-02'")
    timed = writers.landing_report(landed, seconds=4.0).head()
    assert timed.files_per_second == 0.5
    later = readers.file_contents(spark, str(source), since="2100-01-01 00:00:00")
    assert later.count() == 0


def test_partitioned_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda d, n: spark.range(n).withColumn("ingestion_date", F.lit(date(2025, 1, d)))
    writers.write_table(day(1, 3), path)
    writers.write_table(day(2, 4), path)
    writers.write_table(day(1, 5), path)
    got = spark.read.parquet(path).groupBy("ingestion_date").count().collect()
    assert sorted(r["count"] for r in got) == [4, 5]


def test_saved_tables_and_views(spark, tmp_path):
    writers.write_mapping(spark, schemas.CATEGORY_ROWS, str(tmp_path / "m"), "object_category_mapping")
    assert spark.table("object_category_mapping").count() == 13
    writers.register_view(spark.range(3), "three")
    assert spark.sql("SELECT count(*) AS n FROM three").head().n == 3


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (3, "c", 1)], "id int, v string, at int")
    new = spark.createDataFrame([(1, "A", 2), (2, "B", 4), (3, "C", 1), (4, "D", 0)], old.schema)
    got = writers.upserted(old, new, "id", "at").orderBy("id").collect()
    assert [r.v for r in got] == ["A", "b", "C", "D"]


def test_report_and_image_documents(spark, tmp_path):
    rows = spark.createDataFrame([("summary", "all", "{}")], "section string, name string, body string")
    writers.write_report(rows, str(tmp_path / "report"))
    assert (tmp_path / "report" / "section=summary").is_dir()
    docs = spark.createDataFrame([("a", "train"), ("b", "val")], "name string, subset string")
    writers.write_image_documents(docs, str(tmp_path / "docs"))
    assert (tmp_path / "docs" / "subset=val").is_dir()


def test_medallion_run(spark, folder, tmp_path):
    lake = medallion.run(spark, f"{folder}/*.json", str(tmp_path / "lake"))
    sides = lake.read(spark, "validated").groupBy("is_valid").count().collect()
    assert {r.is_valid: r["count"] for r in sides} == {True: 5, False: 2}
    assert lake.read(spark, "std_images_table").count() == 6
    assert lake.read(spark, "std_labels_table").count() == 18
    table = {r.mapped_category: r for r in lake.read(spark, "srv_attribute_analysis").collect()}
    assert set(table) == {"vehicle", "pedestrian"}
    assert (table["vehicle"].total_count, table["vehicle"].std_dev) == (6, 0.0)
    assert lake.read(spark, "scene_comparison").count() == 12
    assert lake.read(spark, "scene_reminders").count() == 6


def test_shared_folder_comes_from_the_session(spark):
    assert scale.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_paging_survives_a_written_table(spark):
    """settle reads back the schema it wrote, nested types included."""
    df = spark.createDataFrame([(1, {"a": [1, 2]})], "k int, s struct<a:array<int>>")
    assert scale.settle(df).schema.simpleString() == df.schema.simpleString()
    assert gold.SCENE == ["weather", "timeofday", "scene"]


def test_detected_boxes(spark):
    rows = [
        ("car", "corners", 1.0, 2.0, 3.0, 4.0, 0.25, None),
        ("car", "xywh", 1.0, 2.0, 3.0, 4.0, None, 0.9),
        ("car", "normalised", 0.5, 0.5, 1.0, 1.0, 0.9, 0.1),
        ("car", "corners", 1.0, 2.0, 3.0, 4.0, 0.2499, 0.9),
        ("car", "corners", 1.0, 2.0, 3.0, 4.0, None, None),
        (None, "corners", 1.0, 2.0, 3.0, 4.0, 0.9, None),
        ("", "corners", 1.0, 2.0, 3.0, 4.0, 0.9, None),
        ("car", "corners", 1.0, None, 3.0, 4.0, 0.9, None),
    ]
    df = spark.createDataFrame(
        rows,
        "category string, format string, a double, b double, c double, d double, "
        "score double, confidence double",
    ).withColumns({"img_width": F.lit(100), "img_height": F.lit(200)})
    got = [tuple(r) for r in
           transform.detected_boxes(df).select("x1", "y1", "x2", "y2").collect()]
    assert got == [(1.0, 2.0, 3.0, 4.0), (1.0, 2.0, 4.0, 6.0), (50.0, 100.0, 100.0, 200.0)]


def test_label_file_and_head(spark):
    images = spark.createDataFrame([("b.jpg",), ("a.jpg",), ("c.jpg",)], "filename string")
    files = spark.createDataFrame([("a_label.json",), ("b_label.json",), ("b_label.json",)], "label_file string")
    got = [r.filename for r in transform.with_label_file(images, files).collect()]
    assert got == ["a.jpg", "b.jpg"]
    assert [r.filename for r in transform.head_rows(images, ["filename"], 2).collect()] == [
        "a.jpg", "b.jpg",
    ]


def test_qualified_names(spark):
    good = document(1, name="n1")
    texts = spark.createDataFrame(
        [(json.dumps(good),), (json.dumps({**good, "name": "n2"}),), ("{",)], "value string"
    )
    images = spark.createDataFrame([("n1",), ("n1",)], "name string")
    got = {r.name: r.is_present for r in validate.qualified_names(texts, images).collect()}
    assert got == {"n1": True, "n2": False}


def test_a_second_day_replaces_the_first(spark, folder, tmp_path):
    lake = medallion.Lake(str(tmp_path / "lake"))

    def run(day):
        medallion.cleanse(spark, lake, f"{folder}/*.json")
        medallion.refine(spark, lake, F.lit(date(2025, 1, day)), F.lit("2025-01-01").cast("timestamp"))
        medallion.aggregate(spark, lake)
        tables = ("std_images_table", "std_labels_table", "srv_attribute_analysis")
        drop = ("ingestion_date", "processing_date")
        return [sorted(map(str, lake.read(spark, t).drop(*drop).collect())) for t in tables]

    first = run(1)
    assert run(2) == first
    (folder / "again.json").write_text(json.dumps(document(1)))
    (folder / "new.json").write_text(json.dumps(document(20)))
    images, labels, gold = run(3)
    assert len(images) == len(first[0]) + 1
    assert len(labels) == len(first[1]) + 6
    days = lake.read(spark, "std_images_table").select("ingestion_date").distinct().collect()
    assert [str(r.ingestion_date) for r in days] == ["2025-01-03"]


def test_text_to_silver_loses_nothing(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    odd = {
        "text_frame": document(1, frame_index="f7"),
        "decimal": document(2, frame_index=1.5),
        "bad_label": document(3, labels=[label(), 5, label("rider")]),
        "text_corner": document(4, labels=[label(x1="1.5")]),
        "pair": [document(5), 5],
        "no_key": document(6, video_name=None),
        "cut": None,
    }
    for name, doc in odd.items():
        (source / f"{name}.json").write_text("{" if doc is None else json.dumps(doc))
    lake = medallion.Lake(str(tmp_path / "lake"))
    raw = readers.raw_documents(spark, f"{source}/*.json")
    found = documents.items(raw).cache()
    rejected = documents.rejects(found).collect()
    whole = documents.label_documents(found).where("video_name IS NOT NULL")
    assert found.count() == whole.count() + sum(r.label is None for r in rejected)
    assert sorted((r.file_name, r.position, r.label, r.reason) for r in rejected if r.label is not None) == [
        ("bad_label.json", 0, 1, documents.LABEL_NOT_OBJECT)
    ]
    assert sorted((r.file_name, r.reason) for r in rejected if r.label is None) == [
        ("cut.json", documents.MALFORMED), ("no_key.json", documents.NO_KEY), ("pair.json", documents.NOT_OBJECT),
    ]
    images = {r.image_id for r in transform.images_table(whole).collect()}
    assert images == {"v1-f7", "v2-1.5", "v3-0", "v4-0", "v5-0"}
    labels = transform.labels_table(whole).collect()
    assert len(labels) == 3 + 3 + 2 + 1 + 3
    assert [r.bbox_x1 for r in labels if r.image_id == "v4-0"] == [1.5]
    medallion.cleanse(spark, lake, f"{source}/*.json")
    medallion.refine(spark, lake)
    assert lake.read(spark, "silver_rejects").count() >= 1


def test_upsert_touches_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "table")
    old = spark.range(400).select("id", F.lit(1).alias("at"), F.concat(F.lit("old"), "id").alias("v"))
    writers.write_buckets(old, path, "id", 16)
    files = lambda: {str(f.relative_to(path)): f.stat().st_mtime_ns for f in (tmp_path / "table").rglob("*.parquet")}
    before = files()
    new = spark.createDataFrame([(5, 2, "new5"), (7, 0, "older"), (5000, 1, "added"), (5, 1, "lost")], old.schema)
    writers.upsert_buckets(spark, path, new, "id", "at", 16)
    got = {r.id: r.v for r in spark.read.parquet(path).collect()}
    want = {i: f"old{i}" for i in range(400)} | {5: "new5", 5000: "added"}
    assert got == want
    plain = writers.upserted(old, new, "id", "at")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, spark.read.parquet(path).select("id", "at", "v").collect()))
    touched = {r.b for r in new.select(writers.bucket_of("id", 16).alias("b")).collect()}
    kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched}
    after = files()
    assert kept and all(after.get(f) == before[f] for f in kept)
    assert all(f not in after for f in set(before) - kept)
    writers.upsert_buckets(spark, path, new.limit(0), "id", "at", 16)
    assert files() == after
